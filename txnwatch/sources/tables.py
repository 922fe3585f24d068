"""Batch readers and writers."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from txnwatch.functions.scalar import json_message
from txnwatch.schemas import ALERT, ALERT_MESSAGE_FIELDS, METRICS, PROVENANCE, SCORED, TRANSACTION
from txnwatch.streaming.commits import ATTEMPT, COMMIT, visible_attempts


def read_transactions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Transaction files with a given schema; JSON lines unless told otherwise."""
    return spark.read.schema(TRANSACTION).format(fmt).load(path)


def stored_schema(table: T.StructType) -> T.StructType:
    return T.StructType(table.fields + PROVENANCE.fields + [T.StructField("attempt", T.StringType())])


def create_tables(spark: SparkSession, root: str) -> None:
    """Make both stored tables if absent; an existing one must have the columns and types of its schema."""
    for name, schema in (("transactions", SCORED), ("alerts", ALERT)):
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(f"{root}/{name}/stream=none/batch_id=-1/attempt=none/event_date=1970-01-01")
        found = {field.name: field.dataType for field in spark.read.parquet(f"{root}/{name}").schema}
        wrong = [field.name for field in schema if found.get(field.name) != field.dataType]
        if wrong:
            raise ValueError(f"stored table {root}/{name} differs in {', '.join(wrong)}")
    spark.createDataFrame([], COMMIT).coalesce(1).write.mode("ignore").parquet(f"{root}/commits/none/t0-000000000000-000000000000-1-0-none")


def read_attempts(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All rows of a stored table with their attempt, also of batches that have not been committed."""
    schema = {"transactions": SCORED, "alerts": ALERT}[table]
    return spark.read.schema(stored_schema(schema)).parquet(f"{root}/{table}")


def _committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_attempts(spark, root, table).join(visible_attempts(spark, root), ATTEMPT, "left_semi").select(
        *[name for name in stored_schema({"transactions": SCORED, "alerts": ALERT}[table]).names if name != "attempt"])


def read_stored_transactions(spark: SparkSession, root: str) -> DataFrame:
    """Scored transactions of committed batches."""
    return _committed(spark, root, "transactions")


def read_stored_alerts(spark: SparkSession, root: str) -> DataFrame:
    """Alerts of committed batches."""
    return _committed(spark, root, "alerts")


def follow_commits(spark: SparkSession, root: str) -> DataFrame:
    """The markers of batches as a stream, in order of their commits."""
    return spark.readStream.schema(COMMIT).parquet(f"{root}/commits/*/t0-*")


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException:
        return False


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics document, or no rows when it is missing or unreadable."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS)
    return spark.read.schema(METRICS).json(path).filter(F.col("threshold").isNotNull())


def write_document(df: DataFrame, path: str) -> None:
    """A one-row report as JSON, nulls written out."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def to_message(df: DataFrame, key: str, fields=ALERT_MESSAGE_FIELDS) -> DataFrame:
    """``key`` and JSON ``value`` columns, the shape a topic writer takes.

    Equal keys reach the same topic partition, so keying by user keeps a
    user's events in order and keying by transaction keeps its alerts together.
    """
    return df.select(F.col(key).alias("key"), json_message(fields).alias("value"))


def write_messages(messages: DataFrame, fmt: str, **options) -> None:
    """Send key/value messages to ``kafka`` (or to files in ``json``/``parquet``)."""
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save()
