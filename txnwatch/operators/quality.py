"""Validation, data-quality summaries and parameter bounds."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from txnwatch.functions.scalar import label_state, to_event_time, to_iso, to_money
from txnwatch.schemas import DEFAULT_COUNTRY, DEFAULT_USER, ISO_PATTERN, MAX_PAGE, MAX_WINDOW_MINUTES

LABELS = ("is_anomaly", "anomaly_type")
REQUIRED = ("transaction_id", "user_id", "amount", "merchant_category", "timestamp", "country")


def check_page(limit: int, offset: int = 0) -> None:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be 1..{MAX_PAGE}, got {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, got {offset}")


def check_window(minutes: int) -> None:
    if not 1 <= minutes <= MAX_WINDOW_MINUTES:
        raise ValueError(f"window must be 1..{MAX_WINDOW_MINUTES} minutes, got {minutes}")


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(name) == "")


def stream_rules() -> dict[str, Column]:
    """What keeps a decoded event out of scoring and out of the stored tables."""
    return {
        "missing_transaction_id": _blank("transaction_id"),
        "missing_user_id": _blank("user_id"),
        "missing_amount": F.col("amount").isNull() | F.isnan("amount"),
        "amount_not_scorable": F.col("amount") <= -1,  # no log1p
        "amount_too_large": F.col("amount").isNotNull() & to_money(F.col("amount")).isNull(),
        "missing_merchant_category": _blank("merchant_category"),
        "missing_country": F.col("country").isNull(),
        "bad_timestamp": to_event_time().isNull(),
    }


def request_rules(columns: list[str]) -> dict[str, Column]:
    """What a scoring request must satisfy; everything else has a default."""
    rules = {
        "missing_amount": F.col("amount").isNull() | F.isnan("amount"),
        "amount_not_positive": F.col("amount") <= 0,
        "missing_merchant_category": F.col("merchant_category").isNull(),
    }
    if "hour" in columns:
        rules["hour_out_of_range"] = ~F.col("hour").between(0, 23)
    return rules


def check(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``reject_reasons``, the names of all broken rules. A projection."""
    broken = [F.when(condition, F.lit(name)) for name, condition in rules.items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*broken)))


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reasons") == 0).drop("reject_reasons")


def rejects(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("reject_reasons") > 0)


def rejects_by_reason(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule, for the rules that are broken at all.

    One aggregate column per rule: no filter is pushed below the JSON decoding,
    where it would parse every message again for each rule.
    """
    counts = df.agg(*[F.count_if(condition).alias(name) for name, condition in rules.items()])
    return counts.unpivot([], list(rules), "reason", "n_rows").filter("n_rows > 0")


def with_defaults(requests: DataFrame, now) -> DataFrame:
    """Requests with user, country and time filled in where absent."""
    stamp = to_iso(F.lit(now).cast("timestamp"))
    return requests.withColumns({
        "user_id": F.coalesce("user_id", F.lit(DEFAULT_USER)),
        "country": F.coalesce("country", F.lit(DEFAULT_COUNTRY)),
        "timestamp": F.when(F.col("timestamp") != "", F.col("timestamp")).otherwise(stamp),
    })


def normalize_labels(df: DataFrame, label: str = "is_anomaly") -> DataFrame:
    """The label as true, false or unknown, whatever type it came in."""
    return df.withColumn(label, label_state(F.col(label), df.schema[label].dataType))


def strip_labels(df: DataFrame) -> DataFrame:
    """For tables that must not show the ground truth."""
    return df.drop(*LABELS)


def quality_summary(df: DataFrame, categories=None, key: str = "transaction_id") -> DataFrame:
    """One row of rule counts and key uniqueness.

    The rule counts are a scan without a shuffle. Only the key column is shuffled
    to see which keys repeat, with the copies of a key combined before.
    """
    has_all = reduce(Column.__and__, [F.col(name).isNotNull() for name in REQUIRED])
    known = F.col("merchant_category").isin(list(categories)) if categories else F.lit(True)
    per_key = df.groupBy(key).agg(F.count("*").alias("copies")).filter(F.col(key).isNotNull())
    keys = per_key.agg(
        F.struct(F.count("*").alias("distinct"), F.count_if(F.col("copies") > 1).alias("duplicated")).alias("keys")
    )
    counts = df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(has_all).alias("n_complete"),
        F.count_if(F.col("amount") > 0).alias("n_positive_amount"),
        F.count_if(F.col("timestamp").rlike(ISO_PATTERN)).alias("n_iso_timestamp"),
        F.count_if(known).alias("n_known_category"),
        F.count("is_anomaly").alias("n_labelled"),
    )
    return counts.withColumn("_keys", keys.scalar()).select(
        *counts.columns,
        F.col("_keys.distinct").alias("n_distinct_keys"),
        F.col("_keys.duplicated").alias("n_duplicated_keys"),
    )


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
