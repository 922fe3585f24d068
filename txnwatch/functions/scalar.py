"""Column expressions. All of them stay in the JVM."""

import math
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

from txnwatch.schemas import (
    ALERT_MESSAGE_FIELDS, FALLBACK_HOUR, ISO_FORMAT, MONEY, SEVERITY_HIGH, SEVERITY_MEDIUM, TYPE_LABELS,
)


def hour_of(timestamp: str = "timestamp", override: str | None = None) -> Column:
    """Hour digits of an ISO string by position; noon when unreadable.

    A non-null override wins, hour 0 included.
    """
    digits = F.substring(F.col(timestamp), 12, 2).try_cast("int")
    candidates = [F.col(override)] if override else []
    return F.coalesce(*candidates, digits, F.lit(FALLBACK_HOUR))


def hour_angle(hour: Column) -> Column:
    return hour * F.lit(2 * math.pi) / F.lit(24)


def zscore(value: Column, mean: float, std: float) -> Column:
    return (value - F.lit(mean)) / F.lit(std)


def indicator(condition: Column) -> Column:
    """1.0 / 0.0, with unknown counted as 0.0."""
    return F.coalesce(condition, F.lit(False)).cast("float")


def to_event_time(timestamp: str = "timestamp") -> Column:
    return F.try_to_timestamp(F.col(timestamp))


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def to_money(amount: Column) -> Column:
    """Two-place decimal; NULL when it does not fit."""
    return amount.try_cast(MONEY)


def label_state(label: Column, kind: T.DataType) -> Column:
    """Three-valued label from boolean, numeric or text columns; NaN is unknown."""
    if isinstance(kind, T.BooleanType):
        return label
    if isinstance(kind, T.NumericType):
        number = label.cast("double")
        return F.when(~F.isnan(number), number != 0)
    return label.try_cast("boolean")


def clock_at(ts: Column, hour: Column, minute: Column, second: Column) -> Column:
    """The same calendar day with another time of day."""
    return F.date_trunc("day", ts) + F.make_dt_interval(F.lit(0), hour, minute, second.cast("decimal(18,6)"))


def json_message(fields=ALERT_MESSAGE_FIELDS) -> Column:
    """JSON text with explicit nulls."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def short_id(column: str = "transaction_id") -> Column:
    return F.substring(F.col(column), 1, 8)


def severity_band(score: Column) -> Column:
    return (
        F.when(score < SEVERITY_HIGH, "high")
        .when(score < SEVERITY_MEDIUM, "medium")
        .otherwise("low")
    )


def type_label(anomaly_type: Column) -> Column:
    known = reduce(
        lambda chain, pair: chain.when(anomaly_type == pair[0], pair[1]),
        TYPE_LABELS.items(),
        F,
    )
    return known.otherwise(F.when(anomaly_type != "", anomaly_type).otherwise("?"))


def percent_text(rate: Column, places: int = 2) -> Column:
    return F.concat(F.format_number(rate * 100, places), F.lit("%"))


def currency_text(amount: Column) -> Column:
    sign = F.when(amount < 0, "-").otherwise("")
    return F.concat(sign, F.lit("$"), F.format_number(F.abs(amount), 2))


def split_list(text: Column) -> Column:
    """Comma-separated text to an array of trimmed, non-blank items."""
    items = F.transform(F.split(text, ","), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def hashed_uniform(key: str, seed: int):
    """Named uniform draws in [0, 1) that depend on the row key and seed only."""

    def draw(name: str) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(name), F.lit(seed)), 11)
        return bits / F.lit(float(2**53))

    return draw
