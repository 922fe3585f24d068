import math

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import features as ft, lookups
from txnwatch.schemas import FEATURES, STD_FLOOR

SCHEMA = "transaction_id string, user_id string, amount double, merchant_category string, timestamp string, country string, is_anomaly boolean"
NOON = "2024-01-15T12:00:00Z"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def homes(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, country string, is_anomaly boolean")
    return {r["user_id"]: r["home_country"] for r in ft.home_countries(df).collect()}


def test_statistics_equal_the_plain_aggregates(spark):
    rows = [(str(i), "u", float(1 + i * i % 97), None if i % 7 == 0 else "abc"[i % 3], NOON, "US", None) for i in range(500)]
    df = frame(spark, rows)
    ours = ft.overall_statistics(ft.category_moments(df)).first()
    plain = df.agg(F.avg(F.log1p("amount")), F.stddev_samp(F.log1p("amount")), F.count("merchant_category")).first()
    assert ours["amount_mean"] == pytest.approx(plain[0], abs=1e-12)
    assert ours["amount_std"] == pytest.approx(plain[1], abs=1e-12)
    assert ours["n_rows"] == 500 and ours["n_categorised"] == plain[2] and ours["n_categories"] == 3


@pytest.mark.parametrize("amounts", [[5.0], [5.0, 5.0]])
def test_deviation_has_a_floor(spark, amounts):
    df = frame(spark, [(str(i), "u", a, "x", NOON, "US", None) for i, a in enumerate(amounts)])
    assert ft.fit_features(df).amount_std == STD_FLOOR


def test_category_shares_ignore_nulls(spark):
    cats = ["a", "a", "a", "b", None, None]
    state = ft.fit_features(frame(spark, [(str(i), "u", 1.0 + i, c, NOON, "US", None) for i, c in enumerate(cats)]))
    assert {r[0]: r[1] for r in state.merchant_freq.collect()} == {"a": 0.75, "b": 0.25}
    assert state.merchant_freq_fallback == 0.25


def test_home_country_rules(spark):
    rows = [("tie", "B", None), ("tie", "A", None), ("tie", "B", False), ("tie", "A", False), ("tie", None, None),
            ("nulls", None, None), (None, "A", None),
            ("labels", "X", True), ("labels", "X", True), ("labels", "Y", None)]
    assert homes(spark, rows) == {"tie": "A", "labels": "Y"}


def test_unknowns_in_lookups(spark):
    state = ft.fit_features(frame(spark, [("1", "u", 1.0, "a", NOON, "US", None), ("2", "u", 3.0, "a", NOON, "US", None),
                                          ("3", "v", 3.0, "b", NOON, "CA", None)]))
    asked = frame(spark, [("a", "u", 1.0, "a", NOON, "US", None), ("b", "nobody", 1.0, "zzz", NOON, "", None),
                          ("c", "nobody", 1.0, None, NOON, "US", None), ("d", "u", 1.0, "a", NOON, None, None)])
    got = {r["transaction_id"]: r for r in ft.transform(asked, state).collect()}
    assert [got[k]["is_home_country"] for k in "abcd"] == [1.0, 1.0, 0.0, 0.0]
    assert got["b"]["merchant_freq"] == got["c"]["merchant_freq"] == pytest.approx(1 / 3, abs=1e-7)


def test_columns_order_type_and_hour(spark):
    df = frame(spark, [("1", "u", 1.0, "a", "2024-01-15T06:00:00Z", "US", None), ("2", "u", 9.0, "a", "??", "US", None)])
    out = ft.transform(df, ft.fit_features(df))
    assert tuple(out.columns[-5:]) == FEATURES
    assert {out.schema[name].dataType.simpleString() for name in FEATURES} == {"float"}
    got = {r["transaction_id"]: r for r in out.collect()}
    assert got["1"]["hour_sin"] == pytest.approx(1.0) and got["2"]["hour_cos"] == pytest.approx(-1.0)
    assert got["1"]["amount_log_zscore"] == pytest.approx(-math.sqrt(0.5), abs=1e-6)


def test_fit_without_label_user_or_country(spark):
    df = frame(spark, [("1", "u", 1.0, "a", NOON, "US", None)]).drop("user_id", "country", "is_anomaly")
    assert ft.fit_features(df).user_home.count() == 0


def test_salted_lookup_equals_broadcast(spark, monkeypatch):
    facts = spark.range(3000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("u"), F.col("id") % 40)).alias("user_id"))
    table = spark.createDataFrame([("hot", "A"), ("u1", "B"), ("u2", "C")], "user_id string, home_country string")
    plain = lookups.lookup(facts, table, "user_id", [], 3)
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    counts = facts.groupBy("user_id").agg(F.count("*").alias("n"))
    hot = lookups.hot_keys(counts.filter("user_id IS NOT NULL"), "user_id", 30_000, 3)
    assert "hot" in hot and len(hot) <= 1000
    salted = lookups.lookup(facts, table, "user_id", hot, 3)
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.select(*salted.columns).collect()), key=str)
    assert salted.columns == plain.columns
    few = lookups.lookup(facts, table, "user_id", [], 3, few_facts=True)
    assert sorted(map(tuple, few.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


@pytest.mark.parametrize("kind", ["null", "default", "hot"])
def test_no_partition_of_a_lookup_swamps_the_others(spark, monkeypatch, kind):
    """Rows without a user, of the default user and of a hot user are dealt out evenly."""
    user = {"null": F.lit(None).cast("string"), "default": F.lit("u_0000"), "hot": F.lit("u1")}[kind]
    facts = spark.range(10_000).select(F.col("id").alias("n"), F.when(F.col("id") % 1000 == 0, "u2").otherwise(user).alias("user_id"))
    table = spark.createDataFrame([("u1", "B"), ("u2", "C")], "user_id string, home_country string")
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = lookups.lookup(facts, table, "user_id", ["u1", "u_0000"], 2)
        counts = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(counts) == 10_000 and max(counts) <= 2.5 * 10_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
