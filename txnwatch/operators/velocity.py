"""Per-user behaviour over time, for tables and (where marked) for streams."""

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas import Timedelta
from pyspark.sql import DataFrame, Window, functions as F, types as T

from txnwatch.operators import timelines
from txnwatch.operators.chunks import in_windows
from txnwatch.schemas import VELOCITY_LIMIT, VELOCITY_SECONDS

HOUR = 3600
MICROS = 1_000_000
#: Spark's own switch: sessions are merged within a task before rows move.
MERGE_BEFORE_SHUFFLE = "spark.sql.sessionWindow.merge.sessions.in.local.partition"


def gap_and_travel(
    df: DataFrame,
    time: str = "event_time",
    key: str = "transaction_id",
    min_gap_seconds: int = 6 * HOUR,
) -> DataFrame:
    """Seconds since the user's previous transaction and whether the country changed.

    A change in less than ``min_gap_seconds`` is impossible travel. Timelines are
    cut into even slices of rows (``timelines``): rows look back within their
    slice, and the first row of a slice takes the last one of the slice before,
    if that is the same user's. One shuffle of the four columns that are needed.
    """
    stored = timelines.sliced(
        df, ["user_id", key, time, "country"], time, timelines.look_back([timelines.AT, "country"]),
        f"_before_{timelines.AT} long, _before_country string, _has_before boolean", "timelines")
    carried = timelines.carry_over(stored, [timelines.AT, "country"])
    linked = stored.join(F.broadcast(carried), timelines.SLICE, "left")
    is_first = F.col(timelines.PLACE) == 0

    def before(column: str):
        return F.when(is_first, F.col(f"_carried_{column}")).when(F.col("_has_before"), F.col(f"_before_{column}"))

    gap = (F.col(timelines.AT) - before(timelines.AT)) / F.lit(float(MICROS))
    changed = F.coalesce(before("country") != F.col("country"), F.lit(False))
    return linked.select(
        key, "user_id", time, "country",
        gap.alias("seconds_since_previous"),
        before("country").alias("previous_country"),
        changed.alias("country_changed"),
        (changed & F.coalesce(gap < min_gap_seconds, F.lit(False))).alias("impossible_travel"),
    )


def velocity(
    df: DataFrame,
    time: str = "event_time",
    limit: int = VELOCITY_LIMIT,
    seconds: int = VELOCITY_SECONDS,
) -> DataFrame:
    """Each row with its user's count over the trailing ``seconds``, and whether it is too many.

    A count is the difference of two places in the user's order, that of the row's
    time and that of its time less ``seconds``, within even slices of rows; what
    falls into an earlier slice is looked up there, and no row is repeated.
    """
    columns = ["user_id", *[name for name in df.columns if name != "user_id"]]
    reach = seconds * MICROS
    stored = timelines.sliced(df, columns, time, timelines.count_back(reach), "_n long, _open boolean", "timelines")
    slices = timelines.per_slice(stored)
    counted = timelines.counts_across(stored, slices, reach) if len(slices) > 1 else stored
    return counted.select(*df.columns, F.col("_n").alias("n_recent"), (F.col("_n") > limit).alias("too_fast"))


def windowed_velocity(
    df: DataFrame,
    time: str = "event_time",
    limit: int = VELOCITY_LIMIT,
    seconds: int = VELOCITY_SECONDS,
    slide_seconds: int = 10,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Sliding counts per user above ``limit``; table or stream.

    Rows are counted once, per slide; the counts of a user are then handed to
    the windows they belong to, on a stream as a second stateful step. Events
    later than the watermark no longer reach the counts.
    """
    counted = in_windows(df.withWatermark(time, watermark), time, seconds, slide_seconds, "user_id", n=F.count("*"))
    return counted.filter(F.col("n") > limit).select(
        F.col("slot.start").alias("window_start"), F.col("slot.end").alias("window_end"), "user_id", "n")


_ACTIVITY = ("n", "total_amount", "first_country", "last_country")


def _bursts(df: DataFrame, time: str, gap: str) -> DataFrame:
    return df.groupBy(F.session_window(time, gap).alias("slot"), "user_id").agg(
        F.count("*").alias("n"),
        F.sum("amount").alias("total_amount"),
        F.min("country").alias("first_country"),
        F.max("country").alias("last_country"),
    ).select("user_id", F.col("slot.start").alias("session_start"), F.col("slot.end").alias("session_end"), *_ACTIVITY)


def _where_they_lie(df: DataFrame, time: str, gap: int) -> DataFrame:
    """Bursts within every few thousand rows of a task: user_id, start and last (microseconds), n, total, lowest and highest country.

    What moves after this is bursts. Money is summed in its smallest unit, so that no order of merging changes a sum.
    """
    kind = df.schema["amount"].dataType
    exact = isinstance(kind, T.DecimalType) and kind.precision <= 18
    amount = (F.col("amount") * F.lit(10**kind.scale)).cast("long") if exact else F.col("amount").cast("double")
    rows = df.filter(F.col(time).isNotNull()).select(
        F.col("user_id").cast("string").alias("user_id"), F.unix_micros(F.col(time)).alias("at"), amount.alias("amount"), F.col("country").cast("string").alias("country"))

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column("at").to_numpy()
            user = np.asarray(pc.fill_null(pc.dictionary_encode(batch.column("user_id")).indices, -1), np.int64)
            order = np.lexsort((at, user))
            at, user = at[order], user[order]
            starts = np.flatnonzero(np.concatenate([[True], (user[1:] != user[:-1]) | (at[1:] - at[:-1] > gap)]))
            lasts = np.concatenate([starts[1:], [len(at)]]) - 1
            money = batch.column("amount").take(pa.array(order))
            known = np.add.reduceat(np.asarray(money.is_valid(), np.int64), starts)
            total = np.add.reduceat(np.asarray(pc.fill_null(money, 0)), starts)
            coded = pc.dictionary_encode(batch.column("country"))
            ranks = np.argsort(np.argsort(np.array(coded.dictionary.to_pylist(), object))) if len(coded.dictionary) else np.empty(0, np.int64)
            names = coded.dictionary.take(pa.array(np.argsort(ranks)))
            place = np.concatenate([ranks, [-1]])[np.asarray(pc.fill_null(coded.indices, -1), np.int64)][order]
            low = np.minimum.reduceat(np.where(place < 0, len(ranks), place), starts)
            high = np.maximum.reduceat(place, starts)
            yield pa.RecordBatch.from_arrays([
                batch.column("user_id").take(pa.array(order[starts])), pa.array(at[starts]), pa.array(at[lasts]), pa.array(lasts - starts + 1),
                pa.array(total, mask=known == 0), names.take(pa.array(low, mask=low >= len(ranks))), names.take(pa.array(high, mask=high < 0)),
            ], ["user_id", "start", "last", "n", "total", "first_country", "last_country"])

    found = rows.mapInArrow(merge, f"user_id string, start long, last long, n long, total {'long' if exact else 'double'}, first_country string, last_country string")
    return found


def _merged(parts: DataFrame, gap: int, *groups: str) -> DataFrame:
    """Bursts that touch as one, per user and ``groups``; columns stay as they are."""
    ordered = Window.partitionBy("user_id", *groups).orderBy("start", "last")
    reached = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("start") > reached + gap, F.lit(True)).cast("int")
    numbered = parts.withColumn("_starts", starts).withColumn("_number", F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy("user_id", *groups, "_number").agg(
        F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("first_country").alias("first_country"), F.max("last_country").alias("last_country")).drop("_number")


def sessions(
    df: DataFrame,
    time: str = "event_time",
    gap: str = "30 minutes",
    watermark: str = "10 minutes",
    chunk_seconds: int = 24 * HOUR,
) -> DataFrame:
    """Bursts of activity per user, ended by more than ``gap`` of silence; table or stream.

    Rows of a table are merged to bursts where they lie, so what is shuffled is
    bursts. These are merged within chunks of time, so that a user with much of
    the data is many groups, and what is left, few rows per user (``gap`` apart,
    or one per chunk), across chunk borders. A stream merges rows within its
    tasks as well before they move.
    """
    if df.isStreaming:
        df.sparkSession.conf.set(MERGE_BEFORE_SHUFFLE, "true")
        found = _bursts(df.withWatermark(time, watermark), time, gap)
    else:
        silence = int(Timedelta(gap).total_seconds() * MICROS)
        parts = _where_they_lie(df, time, silence)
        chunk = F.floor(F.col("start") / F.lit(chunk_seconds * MICROS))
        whole = _merged(_merged(parts.withColumn("_chunk", chunk), silence, "_chunk"), silence)
        kind = df.schema["amount"].dataType
        total = F.col("total")
        if dict(parts.dtypes)["total"] == "bigint":
            total = (total.cast("decimal(38,0)") * F.lit(Decimal(1).scaleb(-kind.scale))).cast(f"decimal({min(38, kind.precision + 10)},{kind.scale})")
        found = whole.select(
            F.col("user_id").cast(df.schema["user_id"].dataType).alias("user_id"), F.timestamp_micros("start").alias("session_start"),
            F.timestamp_micros(F.col("last") + silence).alias("session_end"), "n", total.alias("total_amount"), "first_country", "last_country")
    return found.select(
        "user_id", "session_start", "session_end", "n", "total_amount",
        (F.col("first_country") != F.col("last_country")).alias("spans_countries"),
    )
