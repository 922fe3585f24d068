"""Sinks and streaming queries, driven to completion on files."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from txnwatch.operators import velocity as speed
from txnwatch.operators.features import fit_features
from txnwatch.operators.scoring import CurrentModel, Model, load_model, register_sql, save_model, score_batch
from txnwatch.plans.catalog import FIXED_FOREST
from txnwatch.schemas import FOREST_NODE, TRANSACTION
from txnwatch.sources import streams, tables
from txnwatch.streaming import pipeline, stateful
from txnwatch.streaming.sinks import ScoringSink, first_of_each, follow_alerts, suppress_known

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def tx(i, amount=50.0, at="2024-01-15T12:00:00Z", **changes):
    return {"transaction_id": f"t{i:03d}", "user_id": f"u{i % 5}", "amount": amount, "merchant_category": "atm",
            "timestamp": at, "country": "US", "is_anomaly": None, "anomaly_type": None, **changes}


def batch(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in TRANSACTION.names) for r in rows], TRANSACTION)


@pytest.fixture(scope="module")
def model(spark):
    rows = batch(spark, [tx(i, 10.0 + i) for i in range(50)])
    return Model(fit_features(rows), spark.createDataFrame(FIXED_FOREST, FOREST_NODE), 3, 256, -0.5, "auto", 0)


def snapshot(spark, root):
    kept = ("transaction_id", "amount", "processed_at", "alerted_at", "batch_id")
    both = tables.read_stored_transactions(spark, root), tables.read_stored_alerts(spark, root)
    return [sorted(map(tuple, d.select(*[c for c in kept if c in d.columns]).collect())) for d in both]


def test_replay_changes_nothing(spark, model, tmp_path):
    clock = iter([NOW + timedelta(hours=h) for h in range(9)])
    sent = []
    sink = ScoringSink(model, str(tmp_path), "s", 1.0, lambda m, b: sent.append(m.count()), clock=lambda: next(clock))
    sink(batch(spark, [tx(i) for i in range(6)]), 0)
    first = snapshot(spark, str(tmp_path))
    sink(batch(spark, [tx(i) for i in range(6)]), 0)
    assert snapshot(spark, str(tmp_path)) == first and sent == [6, 6], "messages may repeat, rows may not"
    assert len(first[0]) == len(first[1]) == 6
    assert sink.last_metrics["n_rows"] == sink.last_metrics["n_flagged"] == 6


def test_first_write_wins_across_batches(spark, model, tmp_path):
    sink = ScoringSink(model, str(tmp_path), "s", 1.0, clock=lambda: NOW)
    sink(batch(spark, [tx(1, 50.0)]), 0)
    sink(batch(spark, [tx(1, 99.0), tx(2, 60.0)]), 1)
    stored, alerts = snapshot(spark, str(tmp_path))
    assert [(r[0], float(r[1])) for r in stored] == [("t001", 50.0), ("t002", 60.0)]
    assert [r[0] for r in alerts] == ["t001", "t002"]


def test_fresh_stream_name_keeps_old_batches(spark, model, tmp_path):
    for name, ids in (("a", (1, 2)), ("b", (2, 3))):
        ScoringSink(model, str(tmp_path), name, -9.0, clock=lambda: NOW)(batch(spark, [tx(i) for i in ids]), 0)
    stored, alerts = snapshot(spark, str(tmp_path))
    assert [r[0] for r in stored] == ["t001", "t002", "t003"] and alerts == []


def test_rejects_do_not_fail_the_batch(spark, model, tmp_path):
    sink = ScoringSink(model, str(tmp_path), "s", clock=lambda: NOW)
    sink(batch(spark, [tx(1), tx(2, None), tx(3, 1e11), tx(4, at="soon"), tx(5, -1.0)]), 0)
    assert [r[0] for r in snapshot(spark, str(tmp_path))[0]] == ["t001"]
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 4
    sink(batch(spark, []), 1)
    assert sink.last_metrics["batch_id"] == 0


def test_first_copy_by_ingest_then_offset(spark):
    df = spark.createDataFrame(
        [("a", 1.0, NOW, 0, 7), ("a", 2.0, NOW, 0, 5), ("a", 3.0, NOW + timedelta(seconds=1), 0, 1)],
        "transaction_id string, amount double, ingest_ts timestamp, partition int, offset long")
    rows = first_of_each(df).collect()
    assert [(r["amount"], r["offset"]) for r in rows] == [(2.0, 5)]


@pytest.mark.parametrize("n_rows", [3, 10**9])
def test_suppression_by_broadcast_and_by_shuffle(spark, n_rows):
    rows, stored = (spark.createDataFrame([(i,) for i in ids], "transaction_id string") for ids in ("abc", "bcd"))
    assert [r[0] for r in suppress_known(rows, stored, n_rows).collect()] == ["a"]


def test_message_stream_end_to_end(spark, model, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines = [json.dumps({"value": json.dumps(tx(i, 5000.0 if i % 4 == 0 else 20.0))}) for i in range(20)]
    (source / "one.json").write_text("\n".join(lines[:12] + [json.dumps({"value": "{bad"})]))
    (source / "two.json").write_text("\n".join(lines[8:]))
    root, out = str(tmp_path / "tables"), str(tmp_path / "alerts-topic")

    def go():
        messages = streams.read_files(spark, str(source), "value string", "json", max_files_per_trigger=1)
        pipeline.start_scoring(
            messages, model, root, str(tmp_path / "checkpoint"), threshold=0.05, trigger=None, name="test-scorer",
            publish=lambda m, b: tables.write_messages(m, "json", path=out), clock=lambda: NOW).awaitTermination()

    go()
    stored = tables.read_stored_transactions(spark, root)
    assert stored.count() == 20 and stored.select("transaction_id").distinct().count() == 20
    expected = score_batch(batch(spark, [tx(i, 5000.0 if i % 4 == 0 else 20.0) for i in range(20)]), model)
    flagged = {r[0] for r in expected.filter("score < 0.05").collect()}
    assert {r["transaction_id"] for r in tables.read_stored_alerts(spark, root).collect()} == flagged
    assert {r["key"] for r in spark.read.json(out).collect()} == flagged
    (refused,) = spark.read.parquet(f"{root}/rejects").collect()
    assert refused["raw_value"] == "{bad" and "missing_transaction_id" in refused["reject_reasons"]
    followed = []
    follow_alerts(spark, root, lambda rows, _: followed.extend(rows.collect()), str(tmp_path / "followed")).awaitTermination()
    assert {r["transaction_id"] for r in followed} == flagged and len(followed) == len(flagged)

    (source / "three.json").write_text(json.dumps({"value": json.dumps(tx(40))}))
    go()
    assert tables.read_stored_transactions(spark, root).count() == 21, "a restart resumes and appends"


def event_stream(spark, source):
    schema = "transaction_id string, user_id string, event_time timestamp, country string, amount double"
    return streams.read_files(spark, str(source), schema, "json", max_files_per_trigger=1)


def write_events(source, name, rows):
    source.mkdir(exist_ok=True)
    path = source / name
    number = len(list(source.iterdir()))
    path.write_text("\n".join(json.dumps(dict(zip(("transaction_id", "user_id", "event_time", "country", "amount"), r))) for r in rows))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))  # files are taken oldest first


def test_late_events_leave_state_but_not_scoring(spark, tmp_path):
    source = tmp_path / "in"
    write_events(source, "1.json", [(f"a{i}", "u", f"2024-01-15T12:00:0{i}Z", "US", 1.0) for i in range(3)])
    # Lateness is judged by the watermark the previous batch ran with, hence a batch in between.
    write_events(source, "1b.json", [("b", "u", "2024-01-15T12:00:03Z", "US", 1.0)])
    write_events(source, "2.json", [("late", "u", "2024-01-15T11:45:00Z", "US", 1.0), ("ok", "u", "2024-01-15T11:55:00Z", "US", 1.0)])
    write_events(source, "3.json", [("end", "u", "2024-01-15T13:00:00Z", "US", 1.0)])
    counts = speed.windowed_velocity(event_stream(spark, source), limit=0, seconds=60, slide_seconds=60)
    got = {r["window_start"].strftime("%H:%M"): r["n"] for r in pipeline.drain_to_files(counts, spark, "late").collect()}
    assert got == {"12:00": 4, "11:55": 1}
    assert pipeline.drain_to_files(event_stream(spark, source), spark, "all").count() == 7


def test_travel_state_crosses_batches(spark, tmp_path):
    source = tmp_path / "in"
    rows = [("1", "u", "2024-01-15T10:00:00Z", "US", 1.0), ("2", "u", "2024-01-15T10:30:00Z", "JP", 1.0),
            ("3", "v", "2024-01-15T10:00:00Z", "US", 1.0), ("4", "u", "2024-01-15T20:00:00Z", "US", 1.0),
            ("5", "v", "2024-01-15T10:01:00Z", "US", 1.0), ("6", "v", "2024-01-15T11:00:00Z", None, 1.0)]
    for number, part in enumerate((rows[:1], rows[1:3], rows[3:])):
        write_events(source, f"{number}.json", part)
    streamed = pipeline.drain_to_files(stateful.geo_velocity(event_stream(spark, source)), spark, "travel")
    table = spark.read.schema("transaction_id string, user_id string, event_time timestamp, country string, amount double").json(str(source))
    columns = ("transaction_id", "seconds_since_previous", "previous_country", "country_changed", "impossible_travel")
    expected = speed.gap_and_travel(table).select(*columns)
    assert sorted(map(tuple, streamed.select(*columns).collect())) == sorted(map(tuple, expected.collect()))


def test_late_row_is_not_measured_against_a_later_one(spark, tmp_path):
    source = tmp_path / "in"
    write_events(source, "0.json", [("b", "u", "2024-01-15T12:00:00Z", "US", 1.0)])
    write_events(source, "1.json", [("a", "u", "2024-01-15T11:00:00Z", "JP", 1.0), ("c", "u", "2024-01-15T13:00:00Z", "US", 1.0)])
    moves = pipeline.drain_to_files(stateful.geo_velocity(event_stream(spark, source)), spark, "late-travel")
    got = {r["transaction_id"]: (r["seconds_since_previous"], r["previous_country"]) for r in moves.collect()}
    assert got == {"b": (None, None), "a": (None, None), "c": (3600.0, "US")}


def test_a_quiet_user_is_forgotten_and_a_backfill_ends(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    days = [("a", "01-01"), ("b", "01-01"), ("b", "01-20"), ("b", "02-25"), ("b", "02-26"), ("a", "02-27")]
    for number, (user, day) in enumerate(days):
        write_events(source, f"{number}.json", [(str(number), user, f"2024-{day}T10:00:00Z", "US" if number < 5 else "JP", 1.0)])
    moves = stateful.geo_velocity(event_stream(spark, source), watermark="1 day", forget_after="30 days")

    def go():
        writer = moves.writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
        pipeline._start(writer, checkpoint, None, None).awaitTermination()
        return {row["transaction_id"]: row["seconds_since_previous"] for row in spark.read.parquet(str(tmp_path / "out")).collect()}

    late = source / "5.json"
    held = late.read_text()
    late.unlink()
    gaps = go()
    assert gaps["0"] is None and gaps["2"] == 19 * 86_400.0 and gaps["4"] == 86_400.0
    state = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    assert [row["key"]["user_id"] for row in state.select("key").collect()] == ["b"], "a has been quiet for over 30 days"
    late.write_text(held)
    assert go()["5"] is None, "who comes back after that starts anew"


def test_once_per_key_and_newest_message(spark, tmp_path):
    source = tmp_path / "in"
    for number in range(2):
        write_events(source, f"{number}.json", [("1", "u", "2024-01-15T10:00:00Z", "US", 1.0)])
    assert pipeline.drain_to_files(stateful.once_per_key(event_stream(spark, source)), spark, "once").count() == 1
    topic = spark.createDataFrame([("k", "old", 1), ("k", "new", 2)], "key string, value string, offset long")
    assert [r["value"] for r in stateful.latest_per_key(topic).collect()] == ["new"]


def test_model_round_trip_and_refresh(spark, model, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        load_model(spark, root)
    assert save_model(model, root) == 1
    rows = batch(spark, [tx(i, 7.0 * i) for i in range(1, 30)])

    def scores(m):
        return sorted(map(tuple, score_batch(rows, m).select("transaction_id", "score").collect()))

    current = CurrentModel(spark, root)
    assert scores(current.get()) == scores(model) and current.get() is current.get()
    model.offset = -0.4
    assert save_model(model, root) == 2 and current.get().version == 2 and current.get().offset == -0.4
    model.offset = -0.5
    register_sql(spark, model)
    assert -1 <= spark.sql("SELECT anomaly_score(0f, 0f, 1f, 0.2f, 1f)").first()[0] < 0


def test_named_query_stops(spark, tmp_path):
    source = tmp_path / "in"
    write_events(source, "1.json", [("1", "u", "2024-01-15T10:00:00Z", "US", 1.0)])
    writer = event_stream(spark, source).writeStream.format("noop")
    query = pipeline._start(writer, str(tmp_path / "c"), "named", "1 second")
    assert query.name == "named" and query.isActive
    query.stop()
    pipeline.run(query)
    assert not query.isActive
