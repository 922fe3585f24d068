"""The trained model: quality bars, calibration, storage, requests."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from txnwatch.functions.scalar import hashed_uniform, to_event_time
from txnwatch.operators.inject import assigned_home, inject_anomalies, pick
from txnwatch.operators.scoring import flag, score_batch
from txnwatch.plans import training
from txnwatch.plans.serving import score_requests
from txnwatch.schemas import REQUEST
from txnwatch.session import materialize
from txnwatch.sources.adapters import events_as_transactions
from txnwatch.sources.tables import read_metrics

# Fixed values of the simulated data.
MERCHANT_CATEGORIES = (
    "grocery", "gas", "restaurant", "entertainment",
    "travel", "online", "atm", "pharmacy",
)
AT = datetime(2024, 1, 15, tzinfo=timezone.utc)


def simulated(spark, start, n):
    """Log-normal amounts, 500 users, every normal row in one hour."""
    base = spark.range(start, start + n).select(F.concat(F.lit("g"), "id").alias("transaction_id"), "id")
    draw = hashed_uniform("transaction_id", 11)
    normal = F.sqrt(-2 * F.log(1 - draw("radius"))) * F.cos(2 * 3.141592653589793 * draw("angle"))
    rows = base.select(
        "transaction_id",
        F.format_string("u_%04d", F.floor(draw("user") * 500)).alias("user_id"),
        F.round(F.exp(4.0 + 0.8 * normal), 2).alias("amount"),
        pick(MERCHANT_CATEGORIES, draw("category")).alias("merchant_category"),
        F.lit("2024-01-15T14:05:00Z").alias("timestamp"))
    return inject_anomalies(rows.withColumn("country", assigned_home()), 0.025)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = materialize(simulated(spark, 0, 50_000), "train")
    return (rows, *training.fit(rows))


def test_quality_on_simulated_data(spark, fitted):
    holdout = simulated(spark, 1_000_000, 10_000)
    row = training.evaluate(holdout, fitted[1]).first()
    assert row["f1"] > 0.70 and row["auprc"] > 0.85
    assert row["per_type_recall"]["geo_jump"] > 0.95


def test_flagged_rate_meets_contamination(fitted):
    rows, model, counted = fitted
    row = training.training_summary(rows, model, counted, AT).first()
    assert row["n_records"] == 50_000 and row["n_estimators"] == 100
    assert row["flagged_rate_training"] == pytest.approx(0.025, abs=0.001)
    assert 1000 < row["n_anomalies_in_training"] < 1500


def test_spike_scores_below_normal_and_zero(spark, fitted):
    rows = spark.createDataFrame(
        [("normal", "u_0001", 55.0, "grocery", "2024-01-15T14:00:00Z", None), ("spike", "u_0001", 25_000.0, "atm", "2024-01-15T02:00:00Z", None)],
        "transaction_id string, user_id string, amount double, merchant_category string, timestamp string, country string")
    rows = rows.withColumn("country", assigned_home())
    got = {r["transaction_id"]: r["score"] for r in score_batch(rows, fitted[1]).collect()}
    assert got["spike"] < 0 and got["spike"] < got["normal"] and all(-1 <= v <= 1 for v in got.values())


def test_requests(spark, fitted):
    rows = [(9500.0, "atm", "2024-01-15T03:00:00Z", None, "u_0001", "SG"), (55.0, "grocery", "", 14, None, None),
            (100.0, None, None, None, None, None)]
    answers, refused = score_requests(spark.createDataFrame(rows, REQUEST), fitted[1], 0.0, AT)
    got = {r["features"]["merchant_category"]: r for r in answers.collect()}
    assert got["atm"]["is_anomaly"] and got["atm"]["threshold"] == 0.0
    assert got["grocery"]["features"]["user_id"] == "u_0000" and got["grocery"]["features"]["timestamp"] == "2024-01-15T00:00:00Z"
    assert [r["reject_reasons"] for r in refused.collect()] == [["missing_merchant_category"]]


def test_automatic_contamination_is_the_midpoint(spark, sf_dir):
    model, _ = training.fit(events_as_transactions(spark, sf_dir), "auto", 5)
    assert model.offset == -0.5


def test_same_scores_whatever_the_partitioning(spark, sf_dir):
    rows = events_as_transactions(spark, sf_dir)
    first, second = (training.fit(rows.repartition(n), n_trees=10)[0] for n in (1, 6))
    assert first.offset == pytest.approx(second.offset, abs=1e-9)


def test_train_store_evaluate_retrain(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    rows = inject_anomalies(events_as_transactions(spark, sf_dir)).withColumn("event_time", to_event_time())
    model = training.train(rows, root, n_trees=20, trained_at=AT)
    assert model.version == 1
    assert spark.read.json(f"{root}/training_summary").first()["n_records"] == rows.count()
    training.evaluate(rows, model, path=f"{root}/metrics", evaluated_at=AT)
    assert read_metrics(spark, f"{root}/metrics").first()["n_holdout"] == rows.count()
    again = training.retrain(rows, root, last_n=300, n_trees=20)
    assert again.version == 2 and 300 <= again.state.n_rows < 310


def test_latest_rows_keep_ties(spark):
    rows = [(i, AT + timedelta(seconds=i // 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, event_time timestamp")
    assert {r["id"] for r in training.latest_rows(df, 4).collect()} == set(range(24, 30))
    assert training.latest_rows(df, 100).count() == 30
    untimed = df.unionAll(spark.createDataFrame([(99, None)] * 3, df.schema))
    assert [training.latest_rows(untimed, n).count() for n in (4, 30, 31)] == [6, 30, 30]
    with pytest.raises(ValueError):
        training.latest_rows(df, 0)


def test_stored_rows_can_train(spark):
    stored = spark.createDataFrame(
        [("t", "u", 5.0, "atm", AT, "US", True, "geo_jump")],
        "transaction_id string, user_id string, amount double, merchant_category string, event_time timestamp, country string, ground_truth boolean, anomaly_type string")
    row = training.stored_as_transactions(stored).first()
    assert row["timestamp"] == "2024-01-15T00:00:00Z" and row["is_anomaly"] is True


def test_reflagging(spark):
    df = flag(spark.createDataFrame([(-0.1,), (-0.11,)], "score double"), -0.1)
    assert [r["is_flagged"] for r in df.collect()] == [False, True]
