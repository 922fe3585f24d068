"""Idempotent tables and messages written from micro-batches."""

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from txnwatch.functions.scalar import to_event_time, to_money
from txnwatch.operators import quality
from txnwatch.operators.lookups import BROADCAST_ROWS
from txnwatch.operators.scoring import CurrentModel, Model, flag, score_batch
from txnwatch.schemas import ALERT, ALERT_THRESHOLD, SCORED
from txnwatch.sources.streams import ENVELOPE_ORDER
from txnwatch.sources.tables import create_tables, follow_commits, read_attempts, to_message
from txnwatch.streaming.commits import ATTEMPT, LISTED, KeyIndex, commit, committed_time, keys_of, last_committed

KEY = "transaction_id"
ROWS_PER_FILE = 1_000_000


def first_of_each(batch: DataFrame, key: str = KEY) -> DataFrame:
    """The earliest copy of each key: by ingest time, then by place in the topic.

    Copies that tie on all of that are told apart by content, so that a replay
    keeps the same one. Messages without a key are told apart by their text. The
    minimum is taken map-side first, which shrinks a large group of copies before
    it is shuffled.
    """
    groups = [key] + (["raw_value"] if "raw_value" in batch.columns else [])
    order = [name for name in ("ingest_ts", *ENVELOPE_ORDER) if name in batch.columns]
    rest = [name for name in batch.columns if name not in order and name not in groups]
    earliest = F.min(F.struct(*order, *rest)).alias("row")
    return batch.groupBy(*groups).agg(earliest).select(*groups, "row.*").select(*batch.columns)


def suppress_known(rows: DataFrame, stored: DataFrame, n_rows: int, key: str = KEY) -> DataFrame:
    """Rows whose key is not in a stored table yet, which is scanned for its keys.

    Never shuffles the table when the batch is small. The live sink asks its key index instead.
    """
    known = stored.select(key)
    if n_rows <= BROADCAST_ROWS:
        known = known.join(F.broadcast(rows.select(key)), key, "left_semi")
    return rows.join(known, key, "left_anti")


def as_stored_transactions(scored: DataFrame, processed_at: datetime) -> DataFrame:
    return scored.select(
        KEY, "user_id",
        to_money(F.col("amount")).alias("amount"),
        "merchant_category",
        to_event_time().alias("event_time"),
        "country", "score", "is_flagged",
        F.col("is_anomaly").alias("ground_truth"),
        "anomaly_type",
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
    ).select(*SCORED.names)


def as_alerts(stored: DataFrame) -> DataFrame:
    return stored.filter("is_flagged").withColumnRenamed("processed_at", "alerted_at").select(*ALERT.names)


def as_alert_messages(flagged: DataFrame) -> DataFrame:
    """Key and JSON of the eight alert fields, the time as the text it came in."""
    return to_message(flagged, KEY)


class ScoringSink:
    """``foreachBatch`` function: score, store, then publish.

    A batch writes both tables under an attempt of its own, then its keys to the
    key indexes, then one marker that makes all of it visible (``commits``). A
    replay writes a new attempt, whose marker takes the place of the first one's.
    Keys committed by any other batch are left out, so the first write of a
    transaction stands; they are looked up in the indexes, and the tables are not
    read. Messages go out after the marker, so they never announce a row that is
    not stored, and may repeat after a replay.
    """

    def __init__(
        self,
        model: Model | CurrentModel,
        root: str,
        stream: str,
        threshold: float = ALERT_THRESHOLD,
        publish: Callable[[DataFrame, int], None] | None = None,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    ):
        self._model, self._root, self._stream = model, root, stream
        self._threshold, self._publish, self._clock = threshold, publish, clock
        self._last: int | None = None
        self.last_metrics: dict = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        if self._last is None:
            create_tables(spark, self._root)
            self._last = last_committed(spark, self._root, self._stream)
        model = self._model.get() if isinstance(self._model, CurrentModel) else self._model

        # Rejects are scored along (their score means nothing) so that one cached
        # pass over the batch serves every table below, and the metrics.
        checked = quality.check(first_of_each(batch), quality.stream_rules()).persist()
        n_all = checked.count()
        is_valid = F.size("reject_reasons") == 0
        seen = Observation()
        scored = flag(score_batch(checked, model, n_all <= BROADCAST_ROWS), self._threshold).observe(
            seen,
            F.count_if(is_valid).alias("n_rows"),
            F.count_if(~is_valid).alias("n_rejected"),
            F.count_if(is_valid & F.col("is_flagged")).alias("n_flagged"),
            F.min(F.when(is_valid, F.col("score"))).alias("min_score"),
        ).persist()
        accepted = quality.valid(scored)
        try:
            metrics = self._store(spark, scored, accepted, n_all, seen, batch_id)
            if self._publish and metrics["n_flagged"]:
                self._publish(as_alert_messages(accepted.filter("is_flagged")), batch_id)
            self.last_metrics = {"batch_id": batch_id, **metrics}
        finally:
            scored.unpersist()
            checked.unpersist()

    def _store(self, spark: SparkSession, scored: DataFrame, accepted: DataFrame, n_all: int, seen: Observation, batch_id: int) -> dict:
        attempt = uuid.uuid4().hex
        processed_at, is_replay = self._batch_time(spark, batch_id)
        rows = as_stored_transactions(accepted, processed_at)
        listed = keys_of(accepted, KEY) if n_all <= LISTED else None
        self._write(spark, rows, "transactions", batch_id, attempt, n_all, listed)
        metrics = seen.get  # the write has passed over the whole batch
        if metrics["n_flagged"]:
            self._write(spark, as_alerts(rows), "alerts", batch_id, attempt, metrics["n_flagged"], listed)
        if metrics["n_rejected"]:
            rejected = quality.rejects(scored).drop("score", "is_flagged")
            rejected.write.mode("overwrite").parquet(f"{self._root}/rejects/stream={self._stream}/batch_id={batch_id}")
        if metrics["n_rows"]:
            commit(spark, self._root, self._stream, batch_id, attempt, processed_at, metrics, is_replay)
            self._last = max(self._last, batch_id)
        return metrics

    def _batch_time(self, spark: SparkSession, batch_id: int) -> tuple[datetime, bool]:
        """One time for the whole batch, and whether it is a replay, which keeps the time of the first run."""
        micros = committed_time(spark, self._root, self._stream, batch_id) if batch_id <= self._last else None
        return (self._clock(), False) if micros is None else (datetime.fromtimestamp(micros / 1e6, timezone.utc), True)

    def _write(self, spark: SparkSession, rows: DataFrame, table: str, batch_id: int, attempt: str, n_rows: int, listed: list | None) -> None:
        """Rows with new keys to a table, one file per date or several for a date that may hold many, and their keys to its index."""
        index = KeyIndex(spark, self._root, table, KEY)
        new = index.new(rows, n_rows, self._stream, batch_id, listed)
        part = F.pmod(F.xxhash64(KEY), F.lit(n_rows // ROWS_PER_FILE + 1))
        dated = new.withColumn("event_date", F.to_date("event_time")).repartition("event_date", part)
        path = f"{self._root}/{table}/stream={self._stream}/batch_id={batch_id}/attempt={attempt}"
        dated.write.partitionBy("event_date").parquet(path)
        owner = (self._stream, batch_id, attempt)
        keys = spark.read.schema(f"{KEY} string").option("recursiveFileLookup", "true").parquet(path)
        index.add(self._stream, keys.select(KEY, *[F.lit(value).alias(name) for name, value in zip(ATTEMPT, owner)]), n_rows)


def follow_alerts(
    spark: SparkSession, root: str, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None = None,
) -> StreamingQuery:
    """Hand on the alerts of every batch once, as batches are committed; a replay of a batch is not handed on again.

    ``trigger=None`` hands on what there is and stops. Markers are followed, not files, so alerts of a batch that has
    not ended are never seen.
    """
    create_tables(spark, root)

    def hand_on(commits: DataFrame, batch_id: int) -> None:
        fresh = commits.filter("NOT is_replay AND n_flagged > 0").select(*ATTEMPT)
        if not fresh.isEmpty():
            handle(read_attempts(commits.sparkSession, root, "alerts").join(fresh, ATTEMPT, "left_semi").drop("attempt"), batch_id)

    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    writer = follow_commits(spark, root).writeStream.foreachBatch(hand_on)
    return writer.option("checkpointLocation", checkpoint).trigger(**timing).start()
