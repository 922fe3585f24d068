"""Streaming sources and message decoding."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.functions.scalar import to_event_time
from txnwatch.schemas import TRANSACTION


def kafka_options(
    brokers: str,
    topic: str = "transactions",
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options. ``earliest`` with a fresh checkpoint replays the topic.

    The per-trigger bound is a total over all topic partitions; by default there is
    none. Lost offsets
    fail the query by default; pass False to skip them silently.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()


def read_files(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


ENVELOPE_ORDER = ("partition", "offset")


def decode(messages: DataFrame) -> DataFrame:
    """JSON ``value`` column to transaction columns.

    Unknown fields are dropped and missing ones are NULL. The broker time, where
    the envelope has one, becomes ``ingest_ts``; partition and offset are kept
    because they say which of two copies came first. The text stays in
    ``raw_value`` until rejects have been split off.
    """
    text = F.col("value").cast("string")
    ingest = F.col("timestamp").cast("timestamp") if "timestamp" in messages.columns else F.lit(None).cast("timestamp")
    order = [name for name in ENVELOPE_ORDER if name in messages.columns]
    return messages.select(
        F.from_json(text, TRANSACTION).alias("tx"),
        ingest.alias("ingest_ts"),
        text.alias("raw_value"),
        *order,
    ).select("tx.*", "ingest_ts", "raw_value", *order)


def with_lag(decoded: DataFrame) -> DataFrame:
    """Adds ``lag_seconds``: how long after the event its message reached the broker; NULL without both times."""
    lag = F.unix_micros("ingest_ts") - F.unix_micros(to_event_time())
    return decoded.withColumn("lag_seconds", lag / F.lit(1e6))


def identified(decoded: DataFrame) -> DataFrame:
    """Rows whose transaction id could be read."""
    return decoded.filter(F.col("transaction_id").isNotNull()).drop("raw_value")


def keep_text_of_unreadable(decoded: DataFrame) -> DataFrame:
    """All rows, with the message text only where no transaction id could be read."""
    return decoded.withColumn("raw_value", F.when(F.col("transaction_id").isNull(), F.col("raw_value")))


def unreadable(decoded: DataFrame) -> DataFrame:
    """The complement of :func:`identified`, kept for inspection."""
    return decoded.filter(F.col("transaction_id").isNull()).select("raw_value", "ingest_ts")
