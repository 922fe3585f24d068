"""Small helpers that several of the operators share."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, so that a caller's own columns are never shadowed."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


#: Rows that Spark hands to a Python worker at a time. Texts are long, and its default of 10,000 rows holds many megabytes on both sides.
ARROW_ROWS = 2048


def few_rows_at_a_time(df: DataFrame) -> DataFrame:
    """``df``, once its session is told to hand texts to Python in small batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to few rows, so that a task holds few whole texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def slices_by_size(batches: Iterable[pa.RecordBatch], column: int = 1, size: int = 1 << 23, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of ``column`` come to ``size`` bytes, or are one text."""
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        start, held = 0, 0
        for end, length in enumerate(lengths.tolist()):
            if end > start and (held + length > size or end - start == rows):
                yield batch.slice(start, end - start)
                start, held = end, 0
            held += length
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [text or "" for text in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = 256, by_size: bool = False) -> DataFrame:
    """Apply ``function`` to every few rows, or to every few megabytes of the second column; rows stay where they are."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices_by_size(batches) if by_size else slices(batches, rows):
            yield function(batch)

    return few_rows_at_a_time(df).mapInArrow(run, schema)


#: A key is hot from one row in so many on, so there are never more hot keys than this.
HOT_KEYS = 1000


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, tie: Column) -> DataFrame:
    """Left join of ``rows`` to a stored table with one row per key, in which ``size`` counts the key's rows.

    Keys with a thousandth of all rows or more are at most a thousand, so their
    groups are broadcast. In the shuffled join for the others, rows that have
    their answer are dealt by ``tie`` and meet nothing.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * HOT_KEYS >= total
    values = [name for name in groups.columns if name not in keys]
    found, salt, *hot = fresh(rows, "_found", "_salt", *[f"_hot_{name}" for name in values])
    near = groups.filter(is_hot).select(*keys, F.lit(True).alias(found), *[F.col(a).alias(b) for a, b in zip(values, hot)])
    far = groups.filter(~is_hot).withColumn(salt, F.lit(-1).cast("long"))
    rows = rows.join(F.broadcast(near), keys, "left")
    rows = rows.withColumn(salt, F.when(F.col(found).isNull(), -1).otherwise(F.pmod(F.xxhash64(tie), F.lit(1_000_003))).cast("long"))
    rows = rows.join(far, [*keys, salt], "left")
    for name, other in zip(values, hot):
        rows = rows.withColumn(name, F.coalesce(name, other))
    return rows.drop(found, salt, *hot)
