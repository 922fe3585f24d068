"""Alert listings, rolling statistics and rate series."""

from datetime import datetime
from functools import reduce

from pandas import Timedelta
from pyspark.sql import Column, DataFrame, functions as F

from txnwatch.functions.scalar import (
    currency_text, percent_text, ratio, severity_band, short_id, type_label,
)
from txnwatch.operators.chunks import in_windows, own_rows, trailing, with_halo
from txnwatch.operators.quality import check_page, check_window
from txnwatch.schemas import (
    ALERT, ANOMALY_TYPES, FEED_SIZE, RATE_SAMPLES, RATE_STEP_SECONDS, RATE_WINDOW_SECONDS,
)

DAY = 86_400


# --- listings ----------------------------------------------------------------

def matching(
    alerts: DataFrame,
    since: datetime | None = None,
    anomaly_type: str | None = None,
    max_score: float | None = None,
) -> DataFrame:
    """Alerts that meet every filter given; a blank type is no filter.

    ``since`` is exclusive and ``max_score`` inclusive (lower is more severe).
    """
    conditions = []
    if since is not None:
        conditions.append(F.col("alerted_at") > F.lit(since))
    if anomaly_type:
        conditions.append(F.col("anomaly_type") == anomaly_type)
    if max_score is not None:
        conditions.append(F.col("score") <= max_score)
    return alerts.filter(reduce(Column.__and__, conditions)) if conditions else alerts


def page(df: DataFrame, time: str, limit: int, offset: int = 0) -> DataFrame:
    """Newest first; the id settles ties so that pages neither overlap nor skip.

    Sorted-with-limit keeps only the best ``offset + limit`` rows per task.
    """
    check_page(limit, offset)
    return df.orderBy(F.col(time).desc(), "transaction_id").offset(offset).limit(limit)


def list_alerts(
    alerts: DataFrame, limit: int = 50, offset: int = 0, after: tuple[datetime, str] | None = None, **filters
) -> DataFrame:
    """A page of alerts, newest first.

    ``after`` is the (alerted_at, transaction_id) of the last alert seen. Paging
    by it costs every page the same, while a growing ``offset`` sorts ever more rows.
    """
    if after is not None:
        time, key = F.lit(after[0]), F.lit(after[1])
        alerts = alerts.filter((F.col("alerted_at") < time) | (F.col("alerted_at") == time) & (F.col("transaction_id") > key))
    found = page(matching(alerts, **filters), "alerted_at", limit, offset)
    return found.select(*ALERT.names).withColumn("amount", F.col("amount").cast("double"))


def latest_feed(alerts: DataFrame) -> DataFrame:
    return list_alerts(alerts, FEED_SIZE)


def worst_alerts(alerts: DataFrame, k: int) -> DataFrame:
    return alerts.orderBy("score", "transaction_id").limit(k)


def latest_transactions(transactions: DataFrame, n: int = 50) -> DataFrame:
    return page(transactions, "event_time", n)


def flagged_transactions(transactions: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    return page(transactions.filter("is_flagged"), "event_time", limit, offset)


def new_rows(current: DataFrame, previous: DataFrame, key: str = "transaction_id") -> DataFrame:
    """``current`` with ``is_new`` for ids that the previous poll did not have."""
    known = previous.select(key).distinct().withColumn("_known", F.lit(True))
    return current.join(known, key, "left").withColumn("is_new", F.col("_known").isNull()).drop("_known")


def alert_lines(alerts: DataFrame) -> DataFrame:
    """Alerts as a display shows them: short id, currency, label and severity."""
    return alerts.select(
        short_id().alias("tx"),
        "transaction_id", "user_id", "merchant_category", "country",
        currency_text(F.col("amount")).alias("amount_text"),
        F.format_number("score", 4).alias("score_text"),
        severity_band(F.col("score")).alias("severity"),
        type_label(F.col("anomaly_type")).alias("type_label"),
    )


# --- rolling statistics ------------------------------------------------------

def _marks(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Both tables as narrow rows of one table: when, and which kind of row."""
    seen = transactions.select(
        F.col("processed_at").alias("at"), F.lit(False).alias("is_alert"), F.lit(None).cast("string").alias("anomaly_type")
    )
    raised = alerts.select(F.col("alerted_at").alias("at"), F.lit(True).alias("is_alert"), "anomaly_type")
    return seen.unionAll(raised)


def _totals() -> list[Column]:
    return [
        F.count_if(~F.col("is_alert")).alias("total_transactions"),
        F.count_if("is_alert").alias("total_alerts"),
    ]


def anomaly_rate() -> Column:
    return F.round(ratio(F.col("total_alerts"), F.col("total_transactions")), 6)


def stats_report(
    transactions: DataFrame,
    alerts: DataFrame,
    as_of: datetime,
    window_minutes: int = 10,
    metrics: DataFrame | None = None,
) -> DataFrame:
    """One row for the trailing window: totals, rate, alerts of each known type, model metrics.

    Transactions count by processing time and alerts by alert time. The time
    filter reaches both scans, and one aggregate serves both tables. Alerts
    without a known type are in the total only.
    """
    check_window(window_minutes)
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(window_minutes))
    recent = _marks(transactions, alerts).filter((F.col("at") > start) & (F.col("at") <= F.lit(as_of)))
    by_type = [F.count_if(F.col("is_alert") & (F.col("anomaly_type") == name)).alias(name) for name in ANOMALY_TYPES]
    counted = recent.agg(*_totals(), *by_type)
    if metrics is None:
        model_metrics = F.lit(None)
    else:
        newest = metrics.agg(F.max_by(F.struct(*metrics.columns), "evaluated_at").alias("metrics"))
        model_metrics = newest.scalar()
    return counted.select(
        F.lit(window_minutes).alias("window_minutes"),
        "total_transactions", "total_alerts",
        anomaly_rate().alias("anomaly_rate"),
        F.struct(*ANOMALY_TYPES).alias("by_type"),
        model_metrics.alias("model_metrics"),
    )


def alerts_by_type(alerts: DataFrame, since: datetime | None = None) -> DataFrame:
    """Alert counts per type, untyped alerts left out."""
    typed = matching(alerts, since=since).filter(F.col("anomaly_type").isNotNull())
    return typed.groupBy("anomaly_type").agg(F.count("*").alias("n_alerts"))


def rate_series(
    transactions: DataFrame,
    alerts: DataFrame,
    step: int = RATE_STEP_SECONDS,
    window: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """Trailing anomaly rate at the end of every step in which something happened.

    Rows are counted per step first. The trailing sum then runs over steps, in
    day-long chunks that also see the last ``window`` of the day before.
    """
    end = (F.floor((F.unix_micros("at") / 1_000_000) / step) + 1) * F.lit(step)
    steps = _marks(transactions, alerts).groupBy(end.alias("sampled")).agg(*_totals())
    at = F.col("sampled")
    lately = trailing(at, window - step)
    summed = with_halo(steps, at, DAY, window).withColumns(
        {name: F.sum(name).over(lately) for name in ("total_transactions", "total_alerts")}
    )
    return own_rows(summed).select(
        F.timestamp_seconds("sampled").alias("sampled_at"),
        "total_transactions", "total_alerts",
        anomaly_rate().alias("anomaly_rate"),
    )


def windowed_rates(
    scored: DataFrame,
    time: str = "event_time",
    window: str = "10 minutes",
    slide: str = "1 minute",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Rows, flagged rows and rate per sliding window of one scored table or stream.

    Rows are counted once per slide; the counts are handed to window / slide windows.
    """
    lengths = [int(Timedelta(length).total_seconds()) for length in (window, slide)]
    return in_windows(
        scored.withWatermark(time, watermark), time, *lengths, total_transactions=F.count("*"), total_alerts=F.count_if("is_flagged"),
    ).select(
        F.col("slot.start").alias("window_start"), F.col("slot.end").alias("window_end"),
        "total_transactions", "total_alerts", anomaly_rate().alias("anomaly_rate"),
    )


def latest_rates(
    transactions: DataFrame,
    alerts: DataFrame,
    as_of: datetime,
    samples: int = RATE_SAMPLES,
    step: int = RATE_STEP_SECONDS,
    window: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """The last ``samples`` polls of the trailing rate before ``as_of``, quiet ones included.

    Only the span the polls cover is read; it is counted per step, and those few
    counts are handed to the polls they belong to.
    """
    now = F.unix_micros(F.lit(as_of).cast("timestamp"))
    ago = now - F.unix_micros("at")
    unit = step * 1_000_000
    span = window + (samples - 1) * step
    start = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(span).cast("decimal(18,6)"))
    recent = _marks(transactions, alerts).filter((F.col("at") > start) & (F.col("at") <= F.lit(as_of)))
    per_step = recent.groupBy(F.floor(ago / unit).cast("int").alias("steps_ago")).agg(*_totals())
    first = F.greatest(F.col("steps_ago") - F.lit(window // step - 1), F.lit(0))
    last = F.least(F.col("steps_ago"), F.lit(samples - 1))
    handed = per_step.select(F.explode(F.sequence(first, last)).alias("poll"), "total_transactions", "total_alerts")
    polls = transactions.sparkSession.range(samples).select(F.col("id").cast("int").alias("poll"))
    filled = polls.join(
        handed.groupBy("poll").agg(*[F.sum(n).alias(n) for n in ("total_transactions", "total_alerts")]), "poll", "left"
    ).na.fill(0)
    at = F.timestamp_micros(now - F.col("poll").cast("long") * F.lit(unit))
    return filled.select(
        at.alias("sampled_at"), "total_transactions", "total_alerts", anomaly_rate().alias("anomaly_rate")
    )


def with_rate_text(report: DataFrame) -> DataFrame:
    return report.withColumn("rate_text", percent_text(F.col("anomaly_rate")))
