"""Labelled documents in shards to learn from, sums over shards, bounded samples, and the rows that learning must not see.

Learning reads every labelled row and whole texts. Rows are dealt to shards by a hash of the id; each is learned from in a task
of its own, and what the shards changed is averaged after every round (iterative parameter mixing, McDonald, Hall and
Mann, NAACL 2010), so that neither the driver nor a task holds more than a chunk of rows and a model.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnwatch.llm.common import few_rows_at_a_time, fresh, slices
from txnwatch.session import materialize


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, by ``modulus``; null ids have none."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % modulus


def label_counts(labels: DataFrame, label: str, allowed: Column) -> tuple[DataFrame, dict[int, int]]:
    """One label per document that may be learned from (the larger, if rows disagree), and how many have which."""
    clean = labels.filter(allowed).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")).filter("label in (0, 1)")
    return clean, {row["label"]: row["n"] for row in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}


#: What is fitted to: of one text at most so many characters, of all texts with one label together at most so many. Scores read whole texts.
TEXT_CHARS, LABEL_CHARS = 1 << 17, 1 << 25
#: Tasks that the sample is dealt to.
PARTS = 16


def sample(docs: DataFrame, labels: DataFrame, per_label: tuple[int, int]) -> DataFrame:
    """Texts of at most so many rows of label 0 and of label 1, chosen by a hash of the id, so that their number and size are bounded.

    The chosen ids, bounded by ``per_label``, are broadcast to the scan of the texts; rows are counted again after that,
    as an id may have many, and every task hands on no more than are asked for.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [labels.filter(F.col("label") == label).orderBy(*order).limit(per_label[label]) for label in (0, 1)]
    rows = docs.withColumn("text", F.substring("text", 1, TEXT_CHARS)).join(F.broadcast(chosen[0].unionAll(chosen[1])), "doc_id")
    by_label = Window.partitionBy("label").orderBy(*order, F.xxhash64("text"))
    number, upto = fresh(rows, "_number", "_upto")
    rows = rows.withColumn(number, F.row_number().over(by_label))
    rows = rows.filter(F.col(number) <= per_label[0]) if per_label[0] == per_label[1] else rows.filter(
        F.col(number) <= max(per_label)).filter(F.col(number) <= F.when(F.col("label") == 1, per_label[1]).otherwise(per_label[0]))
    rows = rows.withColumn(upto, F.sum(F.length(F.coalesce("text", F.lit("")))).over(by_label.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.filter(F.coalesce(upto, F.lit(0)) < LABEL_CHARS)
    return rows.drop(number, upto).repartition(PARTS, "doc_id", F.xxhash64("text"))


#: Rows and characters that a shard has about, and that a task holds at most (but for a single longer text).
SHARD_ROWS, SHARD_CHARS = 1 << 13, 1 << 25
#: Rows of a table of weights that travel together.
BLOCK = 1 << 12


def in_shards(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, dict[int, int]]:
    """All ``docs`` that have a label, stored with ``label``, ``shard`` and, from 0, ``place`` in it; shards; rows of each label.

    Texts are moved once: they are dealt to as many tasks as there are shards before they meet their labels.
    """
    labels = materialize(labels, "labels")
    lengths = docs.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("chars"))
    sizes = lengths.join(labels, "doc_id").groupBy("label").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()
    kinds = {row["label"]: row["n"] for row in sizes}
    n = max(1, -(-sum(kinds.values()) // SHARD_ROWS), -(-sum(row["chars"] for row in sizes) // SHARD_CHARS))
    dealt = docs.filter("doc_id IS NOT NULL").repartition(n, "doc_id").join(labels, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    # the upper bits of this id are the task, the lower ones count its rows
    row = F.monotonically_increasing_id()
    placed = dealt.select("*", F.shiftright(row, 33).cast("int").alias("shard"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    return materialize(placed, "labelled", "zstd"), n, kinds


def in_chunks(batches: Iterable[pa.RecordBatch], read: Callable[[str], object]) -> Iterator[tuple[int, list]]:
    """Shard, and what ``read`` makes of texts with their labels, of rows (shard, label, text) that follow one another."""
    held, chars, now = [], 0, None
    for batch in slices(batches):
        sizes = pc.fill_null(pc.utf8_length(batch.column(2)), 0).to_pylist()
        for i, (shard, label, size) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes)):
            if held and (shard != now or len(held) == SHARD_ROWS or chars + size > SHARD_CHARS):
                yield now, held
                held, chars = [], 0
            held.append((read(batch.column(2)[i].as_py() or ""), label))
            now, chars = shard, chars + size
    if held:
        yield now, held


def sums_of(parts: dict[str, np.ndarray], kind: type = np.float64) -> pa.RecordBatch:
    values = [value.ravel().astype(kind) for value in parts.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.string()), pa.array(values, pa.list_(pa.from_numpy_dtype(kind)))], ["part", "values"])


def summed(rows: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], kind: type = np.float64) -> dict[str, np.ndarray]:
    """Sums, over all tasks, of the equally long ``values`` that ``function`` gives for each part; parts are bounded in number and size.

    Rows of a part are added in an order of their own, whatever order they come in, and one at a time. ``kind`` is
    what ``function`` gives; sums are doubles.
    """
    schema = "part string, values array<%s>"

    def add(batches):
        totals = {}
        for batch in slices(batches, 16):
            for i, part in enumerate(batch.column(0).to_pylist()):
                values = batch.column(1)[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
                totals[part] = totals[part] + values if part in totals else values
        if totals:
            yield sums_of(totals)

    parts = few_rows_at_a_time(rows).mapInArrow(function, schema % ("double" if kind is np.float64 else "float"))
    added = parts.repartition("part").sortWithinPartitions("part", F.xxhash64("values")).mapInArrow(add, schema % "double").toArrow()
    column = added["values"].combine_chunks() if added.num_rows else []
    return {part: column[i].values.to_numpy(zero_copy_only=False) for i, part in enumerate(added["part"].to_pylist())}


def mixed(rows: DataFrame, start: list[np.ndarray], read: Callable[[str], object], descend: Callable[[list[np.ndarray], list, int], None], kind: type = np.float32) -> list[np.ndarray]:
    """``start`` after a round: ``descend`` changes a copy of it in place for every shard, and changes are averaged.

    Of the first array, a table of weights, each row's change is averaged over the shards that changed it. Changes
    travel as ``kind``; a single shard's weights come back to the last bit as doubles. As a task adds up its shards, and
    there are as many tasks as cores, what travels in a round doesn't grow with the rows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def fit(batches):
        begin = shared.value
        table, others, touched = np.zeros(begin[0].shape), [np.zeros(array.shape) for array in begin[1:]], np.zeros(len(begin[0]))
        n, now, weights = 0, None, None

        def close():
            moved = weights[0].astype(np.float64) - begin[0]
            table[:] += moved
            touched[:] += moved.any(axis=1)
            for total, array, first in zip(others, weights[1:], begin[1:]):
                total += array.astype(np.float64) - first

        for shard, examples in in_chunks(batches, read):
            if shard != now:
                if weights is not None:
                    close()
                now, weights, n = shard, [array.copy() for array in begin], n + 1
            descend(weights, examples, shard)
        if weights is not None:
            close()
            yield sums_of({"n": np.array([n]), **{f"other {i}": total for i, total in enumerate(others)}}, kind)
            for at in range(0, len(table), BLOCK):
                yield sums_of({f"table {at}": np.column_stack([touched[at: at + BLOCK], table[at: at + BLOCK]])}, kind)

    found = summed(rows.select("shard", "label", "text").coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism)), fit, kind)
    shared.unpersist()
    if not found:
        return start
    blocks = np.concatenate([found[f"table {at}"].reshape(-1, start[0].shape[1] + 1) for at in range(0, len(start[0]), BLOCK)])
    changes = [blocks[:, 1:] / np.maximum(1, blocks[:, :1]), *[found[f"other {i}"].reshape(array.shape) / found["n"] for i, array in enumerate(start[1:])]]
    return [(array + change).astype(array.dtype) for array, change in zip(start, changes)]


def best_cuts(points: DataFrame, weight: float, least: int) -> dict[int, float]:
    """Per ``group`` with ``least`` rows of either label, the middle of the cut through ``logit`` with the fewest errors, the widest such gap.

    Errors are rows of label 1 below, counting ``weight``, and rows of label 0 above. Points are counted per distinct
    logit, and their order is followed within narrow bins; only counts per bin, bounded in number, reach the driver.
    """
    mark = F.floor(F.greatest(F.lit(-512.0), F.least(F.lit(511.0), F.col("logit") * 16))).cast("int")
    counted = materialize(points.groupBy("group", "logit").agg(
        F.sum("label").alias("ones"), F.sum(1 - F.col("label")).alias("zeros")).withColumn("bin", mark), "logits")
    bins = counted.groupBy("group", "bin").agg(
        F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), F.min("logit").alias("low"), F.max("logit").alias("high")).orderBy("group", "bin").collect()
    totals = {}
    for row in bins:
        ones, zeros = totals.get(row["group"], (0, 0))
        totals[row["group"]] = (ones + row["ones"], zeros + row["zeros"])
    enough = {group for group, both in totals.items() if min(both) >= least}
    before, seen, last = [], {}, {}
    for row in bins:
        group = row["group"]
        if group in enough:
            ones, zeros = seen.get(group, (0, 0))
            before.append((group, row["bin"], ones, totals[group][1] - zeros, last.get(group, row["low"] - 1)))
            seen[group], last[group] = (ones + row["ones"], zeros + row["zeros"]), row["high"]
    if not enough:
        return {}
    offsets = counted.sparkSession.createDataFrame(before, "group int, bin int, ones_before long, zeros_after long, last double")
    order = Window.partitionBy("group", "bin").orderBy("logit")
    upto = lambda name: F.coalesce(F.sum(name).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = counted.join(F.broadcast(offsets), ["group", "bin"]).select(
        "group", "logit", ((F.col("ones_before") + upto("ones")) * F.lit(float(weight)) + F.col("zeros_after") - upto("zeros")).alias("errors"),
        F.coalesce(F.lag("logit").over(order), F.col("last")).alias("low"))
    cuts = cuts.withColumn("gap", F.col("logit") - F.col("low"))
    best = cuts.groupBy("group").agg(F.min(F.struct("errors", (-F.col("gap")).alias("narrow"), "low")).alias("best")).collect()
    found = {}
    for row in best:
        errors, narrow, low = row["best"]
        top = (totals[row["group"]][0] * float(weight), -1.0, last[row["group"]])
        errors, narrow, low = min((errors, narrow, low), top)
        found[row["group"]] = low - narrow / 2
    return found
