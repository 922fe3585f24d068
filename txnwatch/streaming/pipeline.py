"""Running streaming queries."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txnwatch.operators.scoring import CurrentModel, Model
from txnwatch.schemas import ALERT_THRESHOLD
from txnwatch.session import ROCKS_DB, STATE_STORE, scratch_path
from txnwatch.sources.streams import decode, keep_text_of_unreadable
from txnwatch.streaming.sinks import ScoringSink

TRIGGER = "5 seconds"


def _start(writer, checkpoint: str, name: str | None, trigger: str | None) -> StreamingQuery:
    if session := SparkSession.getActiveSession():
        session.conf.set(STATE_STORE, ROCKS_DB)  # also in a session that a caller has made
    if name:
        writer = writer.queryName(name)
    timing = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**timing).start()


def start_scoring(
    messages: DataFrame,
    model: Model | CurrentModel,
    root: str,
    checkpoint: str,
    stream: str = "transactions",
    threshold: float = ALERT_THRESHOLD,
    publish: Callable[[DataFrame, int], None] | None = None,
    trigger: str | None = TRIGGER,
    name: str | None = "anomaly-scorer",
    **sink_options,
) -> StreamingQuery:
    """Decode, score and store a message stream.

    Messages that cannot be read, or break a rule, are stored with the rejects.

    ``stream`` names the checkpoint's lineage in the tables: a fresh checkpoint
    (a backfill from the earliest offset, say) needs a fresh name, because batch
    numbers start again. ``trigger=None`` takes what is there and stops.
    """
    sink = ScoringSink(model, root, stream, threshold, publish, **sink_options)
    writer = keep_text_of_unreadable(decode(messages)).writeStream.outputMode("append").foreachBatch(sink)
    return _start(writer, checkpoint, name, trigger)


def run(query: StreamingQuery) -> None:
    """Wait for a query; an interrupt stops it cleanly."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def drain_to_files(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Process what is available, append the results to files and read them back."""
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    writer = stream.writeStream.format("parquet").option("path", out).outputMode("append")
    _start(writer, checkpoint, None, None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_complete(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Process what is available in complete mode and read the last full result."""
    out, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")

    def replace(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(out)

    writer = stream.writeStream.foreachBatch(replace).outputMode("complete")
    _start(writer, checkpoint, None, None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
