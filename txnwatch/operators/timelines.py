"""Users' timelines in even slices of rows, in order of user and time.

Spark's range shuffle cuts all rows into slices of about the same number, so a user
with much of the data, at however many rows a second, is many slices. What a row needs
of the rows before it is found within its slice while that is in order, an Arrow batch
at a time; what lies in earlier slices is carried over through one row per slice.
Rows of one user and time share a slice.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from txnwatch.session import materialize

#: What slices add to rows: number of the slice, place in it, and time as microseconds.
SLICE, PLACE, AT = "_slice", "_place", "_at"


def _starts(users: pa.Array, *times: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before in its user (null is a user) or in any of ``times``."""
    coded = np.asarray(pc.fill_null(pc.dictionary_encode(users).indices, -1), np.int64)
    new = np.ones(len(coded), bool)
    new[1:] = coded[1:] != coded[:-1]
    for time in times:
        new[1:] |= time[1:] != time[:-1]
    return new


def sliced(df: DataFrame, columns: list[str], time: str, follow: Callable[[], Callable[[pa.Table, bool], pa.Table | None]], added: str, name: str) -> DataFrame:
    """``columns`` of ``df`` (user_id first) and the columns ``added``, stored in slices.

    ``follow()`` makes a function for one slice. It gets the slice's rows in order, a few thousand at a time, and whether
    these are the last, and returns rows with ``added``, at any later time.
    """
    order = ["user_id", AT, *[column for column in columns if column != "user_id"]]
    rows = df.select(*columns, F.unix_micros(F.col(time)).alias(AT)).repartitionByRange("user_id", AT).sortWithinPartitions(*order)
    rows = rows.withColumn(SLICE, F.spark_partition_id().cast("long"))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{column}` {kinds[column]}" for column in (*columns, AT, SLICE)) + f", {PLACE} long, {added}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, place, before = follow(), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = pa.table({**{column: batch.column(column) for column in batch.schema.names}, PLACE: np.arange(place, place + batch.num_rows)})
            place += batch.num_rows
            if before is not None and (out := step(before, False)) is not None:
                yield from out.combine_chunks().to_batches()
            before = here
        if before is not None and (out := step(before, True)) is not None:
            yield from out.combine_chunks().to_batches()

    return materialize(rows.mapInArrow(run, schema), name)


def look_back(columns: list[str]) -> Callable[[], Callable[[pa.Table, bool], pa.Table]]:
    """Follow a slice so that each row gets ``columns`` of its user's row before it, as ``_before_<column>``, and whether there is one in the slice."""

    def follow() -> Callable[[pa.Table, bool], pa.Table]:
        last: list[pa.Table] = []

        def step(rows: pa.Table, _: bool) -> pa.Table:
            whole = pa.concat_tables([*last, rows.combine_chunks()]).combine_chunks()
            n_known = len(whole) - len(rows)
            new = _starts(whole["user_id"].combine_chunks())[n_known:]
            source = np.arange(n_known, len(whole)) - 1
            at = pa.array(source, mask=new | (source < 0))
            for column in columns:
                rows = rows.append_column(f"_before_{column}", whole[column].take(at))
            last[:] = [whole.slice(len(whole) - 1)]
            return rows.append_column("_has_before", pa.array(~(new | (source < 0))))

        return step

    return follow


def carry_over(stored: DataFrame, columns: list[str]) -> DataFrame:
    """For slices whose first row goes on with the user of the slice before: the slice, the user and that slice's last values.

    One row per slice, so the window over them is small and the table may be broadcast.
    """
    last = F.max(F.struct(PLACE, "user_id", *columns)).alias("last")
    first = F.min(F.struct(PLACE, "user_id"))["user_id"].alias("_first_user")
    per_slice = stored.groupBy(SLICE).agg(last, first)
    before = F.lag("last").over(Window.orderBy(SLICE))
    return per_slice.select(SLICE, "_first_user", before.alias("_last")).filter(
        F.col("_last").isNotNull() & F.col("_last.user_id").eqNullSafe(F.col("_first_user"))).select(
        SLICE, *[F.col(f"_last.{column}").alias(f"_carried_{column}") for column in columns])


def count_back(reach: int) -> Callable[[], Callable[[pa.Table, bool], pa.Table | None]]:
    """Follow a slice so that each row gets ``_n``, its user's rows in the slice up to its time and at most ``reach`` microseconds before, and ``_open``,
    whether rows of earlier slices may be as near."""

    def follow() -> Callable[[pa.Table, bool], pa.Table | None]:
        kept: list[pa.Table] = []  # rows that wait for others of their time, and those that rows to come look back to
        state = {"done": 0, "first": None}  # how many of the kept rows have been handed on; user and time of the slice's first row

        def step(rows: pa.Table, ends: bool) -> pa.Table | None:
            whole = pa.concat_tables([*kept, rows]).combine_chunks()
            users, at = whole["user_id"].combine_chunks(), whole[AT].to_numpy()
            if state["first"] is None:
                state["first"] = users[0].as_py(), int(at[0])
            tie = _starts(users, at)
            closed = len(whole) if ends else int(np.flatnonzero(tie)[-1])  # the last time may go on in the next rows
            segment = np.cumsum(_starts(users))
            # times and looked-for times as ranks, so that (user, time) is one ascending number
            ranks = np.unique(np.concatenate([at, at - reach]), return_inverse=True)[1].reshape(2, -1)
            own, looked = segment * (2 * len(at) + 1) + ranks
            lower = np.searchsorted(own, looked, "left")
            upper = np.searchsorted(own, own, "right")
            state_done, first_user, first_at = state["done"], *state["first"]
            out = None
            if closed > state_done:
                same_as_first = pc.is_null(users) if first_user is None else pc.fill_null(pc.equal(users, first_user), False)
                open_ = np.asarray(same_as_first) & (at - reach < first_at)
                part = slice(state_done, closed)
                out = whole.slice(state_done, closed - state_done)
                out = out.append_column("_n", pa.array((upper - lower)[part])).append_column("_open", pa.array(open_[part]))
            # rows to come are at this user's last time or later
            keep = min(closed, int(lower[-1]))
            kept[:] = [whole.slice(keep)]
            state["done"] = closed - keep
            return out

        return step

    return follow


def per_slice(stored: DataFrame) -> list:
    """slice, rows, first user and time, last user and time, in order: one row per slice, for the driver."""
    ends = [F.min(F.struct(PLACE, "user_id", AT)).alias("first"), F.max(F.struct(PLACE, "user_id", AT)).alias("last")]
    return stored.groupBy(SLICE).agg(F.count("*").alias("n"), *ends).orderBy(SLICE).collect()


def counts_across(stored: DataFrame, slices: list, reach: int) -> DataFrame:
    """``_n`` of the open rows of slices, with the rows of earlier slices added; all other rows as they are.

    A row looks for its time less ``reach`` in the slice where that falls, and counts the rows there that are not earlier;
    slices of its user in between count whole. Only those rows of a slice are read that some row looks for.
    """
    number = {row[SLICE]: i for i, row in enumerate(slices)}
    # per slice, how far back its user's slices go that only that user is known to fill from there on
    begins = np.zeros(len(slices), np.int64)
    for i in range(1, len(slices)):
        goes_on = slices[i]["first"]["user_id"] == slices[i - 1]["last"]["user_id"]
        fills = slices[i - 1]["first"]["user_id"] == slices[i - 1]["last"]["user_id"]
        begins[i] = (begins[i - 1] if fills else i - 1) if goes_on else i
    last_at = np.array([row["last"][AT] for row in slices], np.int64)
    upto = np.concatenate([[0], np.cumsum([row["n"] for row in slices])])
    ids = np.array([row[SLICE] for row in slices], np.int64)

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = np.array([number[value] for value in batch.column(SLICE).to_pylist()], np.int64)
            wanted = batch.column(AT).to_numpy(zero_copy_only=False) - reach
            found = np.empty(len(here), np.int64)
            for i in np.unique(here):
                found[here == i] = begins[i] + np.searchsorted(last_at[begins[i]:i], wanted[here == i], "left")
            none = found >= here  # no earlier row of the user is as near
            between = np.where(none, 0, upto[here] - upto[np.minimum(found + 1, here)])
            target = np.where(none, -1, ids[np.minimum(found, len(ids) - 1)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(between), pa.array(target)], [*batch.schema.names, "_between", "_target"])

    kinds = ", ".join(f"`{name}` {kind}" for name, kind in stored.dtypes)
    probes = materialize(stored.filter("_open").mapInArrow(look, f"{kinds}, _between long, _target long"), "timeline-probes")
    wanted = probes.filter("_target >= 0").groupBy("_target").agg(F.min(AT).alias("_least"))
    users = stored.sparkSession.createDataFrame([(row[SLICE], row["last"]["user_id"]) for row in slices], f"_target long, _last_user {dict(stored.dtypes)['user_id']}")
    wanted = wanted.join(F.broadcast(users), "_target")
    # one row per slice that is looked into
    held = stored.join(F.broadcast(wanted), F.col(SLICE) == F.col("_target")).filter(
        F.col("user_id").eqNullSafe(F.col("_last_user")) & (F.col(AT) >= F.col("_least") - reach))
    marks = held.select(F.col(SLICE).alias("_target"), F.col(AT).alias("_mark"), F.lit(1).alias("_row"), F.lit(None).cast("struct<x:int>").alias("_probe"))
    names = [name for name in stored.columns]
    asked = probes.filter("_target >= 0").select("_target", (F.col(AT) - reach).alias("_mark"), F.lit(0).alias("_row"), F.struct(*names, "_between").alias("_probe"))
    marks = marks.withColumn("_probe", F.lit(None).cast(asked.schema["_probe"].dataType)).unionAll(asked)
    # counted from the latest time down, a row before a probe of its time
    later = Window.partitionBy("_target").orderBy(F.desc("_mark"), F.desc("_row")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answered = marks.withColumn("_later", F.sum("_row").over(later)).filter("_row = 0").select("_probe.*", "_later")
    answered = answered.withColumn("_n", F.col("_n") + F.col("_between") + F.col("_later")).select(*names)
    rest = probes.filter("_target < 0").select(*names)
    return stored.filter("NOT _open").unionAll(rest).unionAll(answered)
