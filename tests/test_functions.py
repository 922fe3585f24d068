import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from txnwatch.functions import scalar as fn
from txnwatch.schemas import ALERT_MESSAGE_FIELDS


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_hour_by_position(spark):
    texts = ["2024-01-15T02:00:00Z", "bad", None, "", "2024-01-15T 3", "2024-01-15Txx:00", "2024-01-15T23:59:59+05:00"]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    assert values(df, fn.hour_of()) == [2, 12, 12, 12, 3, 12, 23]


def test_hour_override_wins_even_at_zero(spark):
    df = spark.createDataFrame([("2024-01-15T09:00:00Z", 0), ("2024-01-15T09:00:00Z", None)], "timestamp string, hour int")
    assert values(df, fn.hour_of(override="hour")) == [0, 9]


def test_money_rounds_half_up_and_refuses_overflow(spark):
    df = spark.createDataFrame([(2.345,), (-2.345,), (1e11,)], "amount double")
    assert [str(v) for v in values(df, fn.to_money(F.col("amount")))] == ["2.35", "-2.35", "None"]


def test_bad_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-15T02:00:00Z",), ("soon",), (None,)], "timestamp string")
    assert values(df, fn.to_iso(fn.to_event_time())) == ["2024-01-15T02:00:00Z", None, None]


@pytest.mark.parametrize("kind, rows, expected", [
    ("boolean", [True, False, None], [True, False, None]),
    ("double", [1.0, 0.0, math.nan, None], [True, False, None, None]),
    ("string", ["true", "false", "nan", None], [True, False, None, None]),
])
def test_label_states(spark, kind, rows, expected):
    df = spark.createDataFrame([(r,) for r in rows], f"label {kind}")
    assert values(df, fn.label_state(F.col("label"), df.schema["label"].dataType)) == expected


def test_message_writes_nulls(spark):
    row = ("t1", "u1", 5.0, "atm", "2024-01-15T02:00:00Z", "US", -0.2, None)
    schema = "transaction_id string, user_id string, amount double, merchant_category string, timestamp string, country string, score double, anomaly_type string"
    (text,) = values(spark.createDataFrame([row], schema), fn.json_message(ALERT_MESSAGE_FIELDS))
    assert text.endswith('"score":-0.2,"anomaly_type":null}')


def test_display_texts(spark):
    df = spark.createDataFrame(
        [(-0.31, "amount_spike", 1234.5), (-0.3, "other", -2.0), (-0.2, None, 0.0)], "score double, kind string, amount double")
    assert values(df, fn.severity_band(F.col("score"))) == ["high", "medium", "low"]
    assert values(df, fn.type_label(F.col("kind"))) == ["spike", "other", "?"]
    assert values(df, fn.currency_text(F.col("amount"))) == ["$1,234.50", "-$2.00", "$0.00"]
    assert values(df, fn.percent_text(F.lit(0.028))) == ["2.80%"] * 3


def test_clock_at_keeps_the_day(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 9, 17, 5, 6),)], "at timestamp")
    moved = fn.clock_at(F.col("at"), F.lit(2), F.lit(59), F.lit(7))
    assert values(df, fn.to_iso(moved)) == ["2024-03-09T02:59:07Z"]


def test_split_list_trims_and_drops_blanks(spark):
    df = spark.createDataFrame([(" a, ,b ,",)], "text string")
    assert values(df, fn.split_list(F.col("text"))) == [["a", "b"]]


def test_hashed_draws_are_uniform_and_repeatable(spark):
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    draw = fn.hashed_uniform("key", 7)
    first, again = (ids.repartition(n).select(F.avg(draw("a")), F.min(draw("a")), F.max(draw("a"))).first() for n in (2, 5))
    assert first[1:] == again[1:] and abs(first[0] - again[0]) < 1e-9
    assert abs(first[0] - 0.5) < 0.01 and 0 <= first[1] and first[2] < 1
    assert isinstance(ids.select(draw("a").alias("d")).schema["d"].dataType, T.DoubleType)
