"""Operators that remember something per key between micro-batches."""

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from txnwatch.session import ROCKS_DB, STATE_STORE

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAVEL = (
    "user_id string, transaction_id string, event_time timestamp, country string, "
    "seconds_since_previous double, previous_country string, country_changed boolean, impossible_travel boolean"
)


class Traveller(StatefulProcessor):
    """What a user's rows of a micro-batch say, given the last event that is remembered of them.

    A timer on event time is set anew with every row: once the watermark has
    passed the last event by ``forget_after``, the user is forgotten.
    """

    def __init__(self, min_gap_seconds: int, forget_after: int):
        self._min_gap, self._forget_ms = min_gap_seconds, forget_after * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", "at long, country string")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = [chunk.assign(is_new=True) for chunk in rows]
        if self._last.exists():
            micros, place = self._last.get()
            known = {"transaction_id": "", "event_time": pd.Timestamp(micros, unit="us"), "country": place, "is_new": False}
            parts.insert(0, pd.DataFrame([known]))
        rows = pd.concat(parts).sort_values(["event_time", "transaction_id"], ignore_index=True)
        time, country = rows["event_time"], rows["country"].astype(object)
        country = country.where(country.notna(), None)
        micros = int(time.iloc[-1].value // 1000)
        self._last.update((micros, country.iloc[-1]))
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        self._handle.registerTimer(micros // 1000 + self._forget_ms)
        before = country.shift()
        before = before.where(before.notna(), None)
        gap = (time - time.shift()).dt.total_seconds()
        changed = before.notna() & country.notna() & (before != country)
        yield pd.DataFrame({
            "user_id": key[0],
            "transaction_id": rows["transaction_id"],
            "event_time": time,
            "country": country,
            "seconds_since_previous": gap,
            "previous_country": before,
            "country_changed": changed,
            "impossible_travel": changed & (gap < self._min_gap),
        })[rows["is_new"]]

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


def geo_velocity(
    stream: DataFrame, min_gap_seconds: int = 6 * 3600, watermark: str = "7 days", forget_after: str = "30 days",
) -> DataFrame:
    """Streaming twin of the gap-and-travel table operator.

    The state of a user is one (time, country) pair, the latest so far, kept
    across batches until the watermark has passed it by ``forget_after``; a user
    who comes back after that starts anew. Within a batch a user's rows arrive as
    a run of Arrow chunks; they are put in time order together with the
    remembered event, so a row that comes in late is never measured against a
    later one. Rows later than the watermark are left out. Timers are on event
    time, so a finite backfill ends.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    forget = int(pd.Timedelta(forget_after).total_seconds())
    return (
        stream.select("user_id", "transaction_id", "event_time", "country")
        .withWatermark("event_time", watermark)
        .groupBy("user_id")
        .transformWithStateInPandas(Traveller(min_gap_seconds, forget), TRAVEL, "append", "eventTime")
    )


def latest_per_key(messages: DataFrame, key: str = "key", order: str = "offset") -> DataFrame:
    """Newest message per key of a topic read as a table."""
    rest = [name for name in messages.columns if name != key]
    newest = F.max_by(F.struct(*rest), order).alias("row")
    return messages.groupBy(key).agg(newest).select(key, "row.*")


def once_per_key(stream: DataFrame, key: str = "transaction_id", time: str = "event_time", watermark: str = "10 minutes") -> DataFrame:
    """First message per key on a stream; keys are forgotten after the watermark."""
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark([key])
