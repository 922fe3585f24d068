"""Validation, injection, listings and rate reports on small frames."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import inject, quality, reports
from txnwatch.schemas import ALERT, ANOMALY_TYPES, FAR_COUNTRIES, HOME_COUNTRIES, METRICS, TRANSACTION
from txnwatch.sources import streams, tables

AT = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)


def decoded(spark, *texts):
    return streams.decode(spark.createDataFrame([(t,) for t in texts], "value string"))


def event(**changes):
    row = {"transaction_id": "t", "user_id": "u", "amount": 1.5, "merchant_category": "atm",
           "timestamp": "2024-01-15T02:00:00Z", "country": "US"}
    return json.dumps({**row, **changes})


def test_decode_and_rejects(spark):
    rows = decoded(spark, event(), event(extra=1), "{bad", event(amount="x"), event(transaction_id=None), None,
                   event(amount=None), event(transaction_id=7), event(amount=-1), event(amount=1e11), event(timestamp="soon"))
    assert streams.identified(rows).count() == 8 and streams.unreadable(rows).count() == 3
    checked = quality.check(streams.identified(rows), quality.stream_rules())
    assert quality.valid(checked).count() == 3
    reasons = {r["reason"]: r["n_rows"] for r in quality.rejects_by_reason(streams.identified(rows), quality.stream_rules()).collect()}
    assert reasons == {"missing_amount": 2, "amount_not_scorable": 1, "amount_too_large": 1, "bad_timestamp": 1}


def test_envelope_columns_survive(spark):
    df = spark.createDataFrame([(event().encode(), AT, 3, 9)], "value binary, timestamp timestamp, partition int, offset long")
    row = streams.decode(df).first()
    assert (row["transaction_id"], row["partition"], row["offset"]) == ("t", 3, 9) and row["ingest_ts"] is not None


def test_kafka_options():
    options = streams.kafka_options("b:9092", starting_offsets="earliest", fail_on_data_loss=False)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in options and options["subscribe"] == "transactions"
    assert streams.kafka_options("b:9092")["failOnDataLoss"] == "true"


def test_requests(spark):
    schema = "amount double, merchant_category string, timestamp string, hour int, user_id string, country string"
    df = spark.createDataFrame([(55.0, "grocery", None, None, None, None), (100.0, None, "", 3, "u", "SG"),
                                (-1.0, "atm", "", 24, "u", "SG"), (None, "atm", "", 0, "u", "SG")], schema)
    checked = quality.check(df, quality.request_rules(df.columns))
    assert [sorted(r["reject_reasons"]) for r in checked.collect()] == [
        [], ["missing_merchant_category"], ["amount_not_positive", "hour_out_of_range"], ["missing_amount"]]
    row = quality.with_defaults(quality.valid(checked), AT).first()
    assert (row["user_id"], row["country"], row["timestamp"]) == ("u_0000", "US", "2024-01-15T12:00:00Z")


@pytest.mark.parametrize("call", [
    lambda: quality.check_page(0), lambda: quality.check_page(201), lambda: quality.check_page(1, -1),
    lambda: quality.check_window(0), lambda: quality.check_window(1441),
    lambda: inject.inject_anomalies(None, types=["amount_spike", "typo"])])
def test_bounds(call):
    with pytest.raises(ValueError):
        call()


def test_types_from_text():
    assert inject.checked_types(" amount_spike, ,geo_jump,") == ["amount_spike", "geo_jump"]
    assert inject.checked_types("") == inject.checked_types(" , ") == [] and inject.checked_types(ANOMALY_TYPES) == list(ANOMALY_TYPES)


@pytest.mark.parametrize("text", ["typo", "amount_spike,typo", "amount_spike geo_jump"])
def test_unknown_types_are_refused(text):
    with pytest.raises(ValueError, match="no anomaly type"):
        inject.checked_types(text)


def plain(spark, n=400):
    return spark.range(n).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("u").alias("user_id"), F.lit(5.0).alias("amount"),
        F.lit("atm").alias("merchant_category"), F.lit("2024-01-15T12:34:56Z").alias("timestamp"), F.lit("US").alias("country"),
        F.lit(None).cast("boolean").alias("is_anomaly"), F.lit(None).cast("string").alias("anomaly_type"))


@pytest.mark.parametrize("kind", ANOMALY_TYPES)
def test_injection_of_one_kind(spark, kind):
    rows = inject.inject_anomalies(plain(spark), 1.0, [kind]).collect()
    assert {r["anomaly_type"] for r in rows} == {kind} and all(r["is_anomaly"] for r in rows)
    ratios = {r["amount"] / 5.0 for r in rows}
    if kind == "amount_spike":
        assert 10 <= min(ratios) and max(ratios) <= 50 and len(ratios) > 100
    else:
        assert ratios == {1.0}
    assert {r["country"] for r in rows} == (set(FAR_COUNTRIES) if kind == "geo_jump" else {"US"})
    hours = {r["timestamp"][11:13] for r in rows}
    assert hours == ({"02", "03", "04"} if kind == "odd_hour_burst" else {"12"})
    assert all(r["timestamp"].startswith("2024-01-15T") and r["timestamp"].endswith("Z") for r in rows)


def test_injection_rate_and_repeatability(spark):
    none = inject.inject_anomalies(plain(spark), 0.0)
    assert none.filter("is_anomaly OR anomaly_type IS NOT NULL").count() == 0
    assert inject.inject_anomalies(plain(spark), 1.0, []).filter("is_anomaly").count() == 0
    some = inject.inject_anomalies(plain(spark, 20_000), 0.025)
    first, again = (sorted(map(tuple, d.filter("is_anomaly").collect())) for d in (some, some.repartition(3)))
    assert first == again and 400 < len(first) < 600
    assert inject.injection_rate(some).first()["observed_rate_pct"] == pytest.approx(len(first) / 200, abs=0.006)


def test_assigned_homes(spark):
    users = spark.range(500).select(F.concat(F.lit("u_"), "id").alias("user_id"))
    got = [r[0] for r in users.select(inject.assigned_home()).collect()]
    assert set(got) == set(HOME_COUNTRIES) and got == [r[0] for r in users.select(inject.assigned_home()).collect()]


def alert(i, at=AT, score=-0.2, kind="geo_jump"):
    return (f"t{i:03d}", "u", None, "atm", at, "US", score, kind, at)


def test_pages_are_stable_when_times_tie(spark):
    alerts = spark.createDataFrame([alert(i) for i in (3, 1, 4, 0, 2)], ALERT)
    pages = [[r["transaction_id"] for r in reports.list_alerts(alerts, 2, start).collect()] for start in (0, 2, 4)]
    last = None
    for page in pages:
        rows = reports.list_alerts(alerts, 2, after=last).collect()
        assert [r["transaction_id"] for r in rows] == page
        last = (rows[-1]["alerted_at"], rows[-1]["transaction_id"])
    assert pages == [["t000", "t001"], ["t002", "t003"], ["t004"]]


def test_filters(spark):
    alerts = spark.createDataFrame([alert(0, score=-0.3), alert(1, AT + timedelta(seconds=1), -0.1, None),
                                    alert(2, AT + timedelta(seconds=2), -0.2, "amount_spike")], ALERT)

    def ids(**filters):
        return sorted(r["transaction_id"] for r in reports.matching(alerts, **filters).collect())

    assert ids() == ids(anomaly_type="") == ["t000", "t001", "t002"]
    assert ids(since=AT) == ["t001", "t002"] and ids(max_score=-0.2) == ["t000", "t002"]
    assert ids(since=AT, anomaly_type="amount_spike", max_score=-0.2) == ["t002"]


def test_new_rows(spark):
    now, before = (spark.createDataFrame([(i,) for i in ids], "transaction_id string") for ids in ("abc", "bz"))
    assert {r[0]: r[1] for r in reports.new_rows(now, before).collect()} == {"a": True, "b": False, "c": True}


def stats_inputs(spark, n_tx, alerts):
    tx = spark.createDataFrame([(AT - timedelta(minutes=i),) for i in range(n_tx)], "processed_at timestamp")
    return tx, spark.createDataFrame([(AT - timedelta(minutes=m), k) for m, k in alerts], "alerted_at timestamp, anomaly_type string")


def test_stats_report(spark):
    tx, alerts = stats_inputs(spark, 30, [(1, "geo_jump"), (2, None), (3, "other"), (50, "geo_jump")])
    metrics = spark.createDataFrame([(0.0, 1, 1, 1, 1.0, 0.5, 0.5, 0.5, 0.7, (1, 0, 0, 0), (None, 1.0, None), AT)], METRICS)
    row = reports.stats_report(tx, alerts, AT, 10, metrics).first()
    assert (row["total_transactions"], row["total_alerts"], row["anomaly_rate"]) == (10, 3, 0.3)
    assert tuple(row["by_type"]) == (0, 1, 0) and row["model_metrics"]["auprc"] == 0.7


def test_stats_of_nothing(spark):
    tx, alerts = stats_inputs(spark, 0, [])
    empty = spark.createDataFrame([], METRICS)
    row = reports.stats_report(tx, alerts, AT, 10, empty).first()
    assert (row["total_transactions"], row["anomaly_rate"], row["model_metrics"]) == (0, 0.0, None)


def test_rate_series_across_midnight(spark):
    midnight = datetime(2024, 1, 16, tzinfo=timezone.utc)
    times = [midnight + timedelta(seconds=s) for s in (-700, -590, -3, 1, 4, 300)]
    tx = spark.createDataFrame([(t,) for t in times], "processed_at timestamp")
    alerts = spark.createDataFrame([(times[1], None)], "alerted_at timestamp, anomaly_type string")
    got = [(r["total_transactions"], r["total_alerts"]) for r in reports.rate_series(tx, alerts).orderBy("sampled_at").collect()]
    assert got == [(1, 0), (2, 1), (2, 1), (4, 1), (4, 0)]


def test_latest_rates_include_quiet_polls(spark):
    tx, alerts = stats_inputs(spark, 20, [(11, "geo_jump")])
    got = reports.latest_rates(tx, alerts, AT).orderBy(F.desc("sampled_at")).collect()
    assert len(got) == 72 and got[0]["total_transactions"] == 10 and got[0]["total_alerts"] == 0
    assert got[-1]["total_alerts"] == 1 and got[-1]["anomaly_rate"] == 0.1


def test_metrics_file_may_be_missing_or_broken(spark, tmp_path):
    assert tables.read_metrics(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "broken.json").write_text("{not json")
    assert tables.read_metrics(spark, str(tmp_path / "broken.json")).count() == 0


def test_json_lines_and_messages(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text(event() + "\n" + event(transaction_id="t2") + "\n")
    rows = tables.read_transactions(spark, str(tmp_path / "in.jsonl"))
    assert rows.schema == TRANSACTION and rows.count() == 2
    tables.write_messages(tables.to_message(rows, "user_id", TRANSACTION.names), "json", path=str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert {r["key"] for r in back.collect()} == {"u"} and back.count() == 2


def test_duplicate_listing(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [tuple(r) for r in quality.duplicate_keys(df, "k").collect()] == [("a", 2)]
    assert "is_anomaly" not in quality.strip_labels(plain(spark)).columns
