from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from txnwatch.operators import evaluation as ev
from txnwatch.operators.ordering import quantile, running_totals, value_at
from txnwatch.plans.training import metrics_document
from txnwatch.schemas import METRICS

SCORED = "score double, is_anomaly boolean, anomaly_type string"
# Most anomalous first: average precision is exactly 0.7.
TIES = [(-0.9, True), (-0.8, False), (-0.7, True), (-0.7, False), (-0.4, True), (-0.1, False)]


def scored(spark, rows):
    return spark.createDataFrame([(s, y, "geo_jump" if y else None) for s, y in rows], SCORED)


def brute_average_precision(rows):
    positives = sum(y for _, y in rows)
    area = before = 0.0
    for cut in sorted({s for s, _ in rows}):
        taken = [y for s, y in rows if s <= cut]
        area += (sum(taken) / positives - before) * sum(taken) / len(taken) if positives else 0.0
        before = sum(taken) / positives if positives else 0.0
    return area


def test_average_precision_with_ties(spark):
    assert ev.average_precision(ev.profile(scored(spark, TIES))).first()["auprc"] == pytest.approx(0.7)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-9, 9).map(lambda v: v / 10), st.booleans()), min_size=1, max_size=60))
def test_average_precision_equals_brute_force(spark, rows):
    counted = ev.profile(scored(spark, rows))
    got = ev.average_precision(counted).first()["auprc"]
    assert got == pytest.approx(brute_average_precision(rows), abs=1e-12)


def test_no_positives_gives_zeros_and_nulls(spark):
    counted = ev.profile(scored(spark, [(-0.5, False), (0.5, False)]))
    row = metrics_document(counted, 0.0, datetime(2024, 1, 1)).first()
    assert (row["precision"], row["recall"], row["f1"], row["auprc"]) == (0.0, 0.0, 0.0, 0.0)
    assert tuple(row["per_type_recall"]) == (None, None, None)
    assert tuple(row["confusion_matrix"]) == (1, 1, 0, 0)


def test_document_shape(spark):
    document = metrics_document(ev.profile(scored(spark, TIES)), -0.5, datetime(2024, 1, 1))
    assert document.schema.simpleString() == METRICS.simpleString()
    row = document.first()
    assert (row["n_holdout"], row["n_anomalies_true"], row["n_anomalies_pred"]) == (6, 3, 4)
    assert (row["precision"], row["recall"], row["f1"], row["auprc"]) == (0.5, 0.6667, 0.5714, 0.7)
    assert tuple(row["per_type_recall"]) == (None, 0.6667, None)


def test_threshold_is_strict(spark):
    row = ev.confusion(ev.profile(scored(spark, [(0.0, True), (-0.1, True)])), 0.0).first()
    assert (row["fn"], row["tp"]) == (1, 1)


def test_unlabelled_rows_are_left_out_and_labels_required(spark):
    df = spark.createDataFrame([(0.1, None, None), (-0.1, True, "geo_jump")], SCORED)
    assert ev.profile(df).agg(F.sum("n")).first()[0] == 1
    with pytest.raises(ValueError):
        ev.profile(df.drop("is_anomaly"))


def test_operating_points(spark):
    curve = ev.pr_curve(ev.profile(scored(spark, TIES)))
    assert ev.best_threshold(curve).first()["threshold"] == -0.4
    assert ev.best_threshold(curve, min_precision=0.9).first()["threshold"] == -0.9


def test_running_totals_over_many_slices(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000).alias("v"), (F.col("id") % 3).alias("w"), (F.col("id") % 2).alias("g"))
    got = {(r["g"], r["v"]): (r["w_upto"], r["w_total"]) for r in running_totals(df, "v", ["w"], ["g"]).collect()}
    totals = {0: 0, 1: 0}
    expected = {}
    for v, w, g in sorted(map(tuple, df.collect())):
        totals[g] += w
        expected[g, v] = totals[g]
    assert {k: t[0] for k, t in got.items()} == expected
    assert {t[1] for k, t in got.items() if k[0] == 0} == {totals[0]}


@pytest.mark.parametrize("q", [0.0, 0.025, 0.5, 0.9, 1.0])
def test_quantile_equals_numpy(spark, q):
    rows = [(i * i % 89 / 7 - 3, 1 + i % 4) for i in range(60)]
    merged = spark.createDataFrame(rows, "v double, n long").groupBy("v").agg(F.sum("n").alias("n"))
    assert quantile(merged, "v", q) == pytest.approx(np.quantile(np.repeat(*zip(*rows)), q), abs=1e-12)


def test_value_at_and_empty_quantile(spark):
    df = spark.createDataFrame([(10.0, 2), (20.0, 1)], "v double, n long")
    assert [value_at(df, "v", place) for place in (0, 1, 2)] == [10.0, 10.0, 20.0]
    assert quantile(df.limit(0), "v", 0.5) is None


def test_precision_at_k_and_drop(spark):
    rows = []
    for day, hits in ((1, 4), (2, 1), (4, 0)):
        rows += [(f"{day}-{i}", datetime(2024, 1, day, 5), -1.0 + i / 100, i < hits) for i in range(8)]
    df = spark.createDataFrame(rows, "transaction_id string, event_time timestamp, score double, is_anomaly boolean")
    got = {r["window_start"].day: r for r in ev.precision_at_k(df, 4, "1 day", 0.5).collect()}
    assert {d: r["precision_at_k"] for d, r in got.items()} == {1: 1.0, 2: 0.25, 4: 0.0}
    assert {d: r["has_dropped"] for d, r in got.items()} == {1: False, 2: True, 4: False}
    assert got[4]["previous"] is None, "day 3 had no rows"


def test_rolling_area_asks_for_retrain(spark):
    base = datetime(2024, 1, 1)
    rows = [(base + timedelta(days=d), s if d else -s, y) for d in (0, 1) for s, y in TIES]
    df = spark.createDataFrame(rows, "event_time timestamp, score double, is_anomaly boolean")
    got = {r["window_start"].day: r for r in ev.rolling_auprc(df, "1 day", 0.6).collect()}
    assert got[2]["auprc"] == pytest.approx(0.7) and not got[2]["needs_retrain"]
    assert got[1]["needs_retrain"]


def test_histogram_catches_everything(spark):
    df = spark.createDataFrame([(-2.0,), (-0.5,), (0.0,), (0.49,), (0.5,), (3.0,)], "score double")
    got = {r["bin"]: r["n_rows"] for r in ev.score_histogram(df, bins=10).collect()}
    assert got == {0: 1, 1: 1, 6: 1, 10: 1, 11: 2}
