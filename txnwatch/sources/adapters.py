"""Existing tables seen as transactions."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.functions.scalar import to_iso
from txnwatch.session import scratch_path
from txnwatch.sources.streams import read_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _user(column: str):
    return F.concat(F.lit("u_"), F.col(column).cast("string"))


def _with_country(facts: DataFrame, spark: SparkSession, sf_dir: str, owner: str, prefix: str, fact_key: str, how: str) -> DataFrame:
    """Look up the owner of each fact row, then the owner's country.

    Owners get their country before they meet the facts, so the country is looked
    up once per owner and not once per fact. Owner keys are unique, so a hot key
    only makes the fact side large, and adaptive skew handling can split that side.
    All tables are joined by their own sizes.
    """
    key = {"c": "c_custkey", "s": "s_suppkey"}[prefix]
    owners = table(spark, sf_dir, owner).select(key, F.col(f"{prefix}_nationkey").alias("n_nationkey"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    located = owners.join(nation, "n_nationkey", "left").drop("n_nationkey")
    return facts.join(located if how == "left" else located.filter("country IS NOT NULL"), F.col(fact_key) == F.col(key), how)


def events_as_transactions(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """``events`` (the table, or a stream of it) as unlabelled transactions."""
    events = table(spark, sf_dir, "events") if events is None else events
    events = events.select("event_id", "ts", "user_id", "event_type", "value")
    return _with_country(events, spark, sf_dir, "customer", "c", "user_id", "left").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        _user("user_id").alias("user_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("merchant_category"),
        to_iso(F.col("ts").cast("timestamp")).alias("timestamp"),
        "country",
        F.lit(None).cast("boolean").alias("is_anomaly"),
        F.lit(None).cast("string").alias("anomaly_type"),
    )


def purchases_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: buyer, seller country, price. Users span countries."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return _with_country(sold, spark, sf_dir, "supplier", "s", "l_suppkey", "inner").select(
        _user("o_custkey").alias("user_id"),
        "country",
        F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("merchant_category"),
    )


def stream_events(spark: SparkSession, sf_dir: str, files_per_batch: int | None = 1) -> DataFrame:
    """The ``events`` file as a stream, a file per batch; the pattern makes one file a directory listing."""
    schema = table(spark, sf_dir, "events").schema
    return read_files(spark, f"{sf_dir}/event[s].parquet", schema, max_files_per_trigger=files_per_batch)


def stream_closed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``events`` as a stream that an event of no user ends, long after the last.

    It moves the watermark past every window and session of the others, so a
    finished backfill hands out its tail as well; its own never close.
    """
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "closed-events")
    events.write.parquet(path)
    last = events.agg(F.max("ts").alias("ts")).select(
        *[((F.col("ts") + F.expr("INTERVAL 30 DAYS")) if name == "ts" else F.lit(None)).cast(kind).alias(name) for name, kind in events.dtypes])
    last.write.mode("append").parquet(path)
    return read_files(spark, path, events.schema)
