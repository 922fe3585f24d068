"""The commit log, the key index and the alert feed of the live sink."""

import pytest
from pyspark.sql import functions as F

from test_streaming import NOW, batch, model, snapshot, tx  # noqa: F401
from txnwatch.sources import tables
from txnwatch.streaming import commits, runs, sinks
from txnwatch.streaming.sinks import KEY, ScoringSink, follow_alerts


def rows_of(spark, ids, stream="s", batch_id=0, attempt="a"):
    return spark.createDataFrame([(i, stream, batch_id, attempt) for i in ids], "transaction_id string, stream string, batch_id long, attempt string")


@pytest.fixture(scope="module")
def stopped(spark, model, tmp_path_factory):  # noqa: F811
    """Tables after one whole batch and one that stopped between its two tables, with what was visible at each point."""
    root, seen = str(tmp_path_factory.mktemp("stopped")), {}
    ScoringSink(model, root, "s", 1.0, clock=lambda: NOW)(batch(spark, [tx(1), tx(2)]), 0)
    seen["first"] = snapshot(spark, root)

    class Stopping(ScoringSink):
        def _write(self, spark, rows, table, *rest):
            if table == "alerts":
                raise RuntimeError("stopped")
            super()._write(spark, rows, table, *rest)

    with pytest.raises(RuntimeError, match="stopped"):
        Stopping(model, root, "s", 1.0, clock=lambda: NOW)(batch(spark, [tx(2), tx(3)]), 1)
    seen["stopped"] = snapshot(spark, root)
    return root, seen


def test_a_batch_that_stopped_between_the_tables_shows_in_neither(spark, stopped):
    root, seen = stopped
    assert seen["stopped"] == seen["first"] and len(seen["first"][0]) == len(seen["first"][1]) == 2
    assert tables.read_attempts(spark, root, "transactions").count() == 3, "it had written to the first table"


def test_keys_that_were_never_committed_suppress_nothing_and_a_replay_completes(spark, model, stopped):  # noqa: F811
    root, _ = stopped
    ScoringSink(model, root, "other", 1.0, clock=lambda: NOW)(batch(spark, [tx(3, 77.0)]), 0)
    ScoringSink(model, root, "s", 1.0, clock=lambda: NOW)(batch(spark, [tx(2), tx(3), tx(4)]), 1)
    stored, alerts = snapshot(spark, root)
    assert [(r[0], float(r[1])) for r in stored] == [("t001", 50.0), ("t002", 50.0), ("t003", 77.0), ("t004", 50.0)]
    assert [r[0] for r in alerts] == ["t001", "t002", "t003", "t004"]
    before = tables.read_attempts(spark, root, "transactions").count()
    assert commits.drop_unseen_attempts(spark, root) == 1 and snapshot(spark, root) == [stored, alerts]
    assert tables.read_attempts(spark, root, "transactions").count() == before - 1


def test_a_replay_stays_visible_until_its_marker(spark, model, tmp_path, monkeypatch):  # noqa: F811
    root, during = str(tmp_path), []
    sink = ScoringSink(model, root, "s", 1.0, clock=lambda: NOW)
    sink(batch(spark, [tx(1), tx(2)]), 0)
    first, marker = snapshot(spark, root), sinks.commit

    def late_marker(spark, *args):
        during.append(snapshot(spark, root))
        marker(spark, *args)

    monkeypatch.setattr(sinks, "commit", late_marker)
    sink(batch(spark, [tx(1), tx(2)]), 0)
    assert during == [first] and snapshot(spark, root) == first
    log = commits.all_commits(spark, root).orderBy("version").collect()
    assert [(r["batch_id"], r["version"], r["is_replay"], r["n_rows"]) for r in log] == [(0, 0, False, 2), (0, 1, True, 2)]


def test_a_replay_between_two_polls_hands_no_alert_on_twice(spark, model, tmp_path):  # noqa: F811
    root, got = str(tmp_path / "tables"), []

    def poll():
        follow_alerts(spark, root, lambda rows, _: got.extend(r[KEY] for r in rows.collect()), str(tmp_path / "feed")).awaitTermination()

    poll()
    assert got == []
    sink = ScoringSink(model, root, "s", 1.0, clock=lambda: NOW)
    sink(batch(spark, [tx(1), tx(2)]), 0)
    poll()
    sink(batch(spark, [tx(1), tx(2)]), 0)
    sink(batch(spark, [tx(3)]), 1)
    poll()
    assert sorted(got) == ["t001", "t002", "t003"]


def test_the_files_that_a_batch_opens_do_not_grow_with_the_history(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "FAN", 4)
    index = commits.KeyIndex(spark, str(tmp_path), "transactions", KEY, rows_per_file=40, keep_seconds=0)
    asked, opened, known = rows_of(spark, ["k5", "k17", "nowhere"]), [], 0
    for number in range(21):
        index.add("s", rows_of(spark, [f"k{20 * number + i}" for i in range(20)], batch_id=number), 20)
        known += 20
        found = index.entries(asked, 3)
        opened.append(len(found.inputFiles()))
        assert sorted((r[KEY], r["batch_id"]) for r in found.collect()) == [("k17", 0), ("k5", 0)]
    tiers = 3  # 21 additions by fours
    assert max(opened) <= 3 * 3 * tiers and opened[20] <= opened[19] + 3
    kept = {run.tier: run for run in index._runs("s").live()}
    assert sorted(run.tier for run in index._runs("s").live()) == [0, 1, 2] and (kept[2].first, kept[2].last, kept[2].rows, kept[2].buckets) == (0, 15, 320, 8)
    odd = rows_of(spark, ["it's", "a\\b", "k\n1", "", "\\'"])
    index.add("s", odd, 5)
    assert {r[KEY] for r in index.entries(odd, 5).collect()} == {"it's", "a\\b", "k\n1", "", "\\'"}
    large = index.entries(rows_of(spark, [f"k{i}" for i in range(0, 600)]), 600)
    assert large.count() == known, "a batch too large to list is joined with the whole index"


def test_unended_merges_do_not_count_and_covered_runs_go_after_a_while(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "FAN", 2)
    kept = runs.Runs(spark, str(tmp_path / "kept"), "k string", "k", keep_seconds=3600)
    (tmp_path / "kept" / "t1-000000000000-000000000009-1-9-unended").mkdir(parents=True)
    for number in range(2):
        assert kept.add(spark.createDataFrame([(str(number),)], "k string"), 1) == number + 10, "numbers of an unended merge are not used again"
    assert sorted(r["k"] for r in kept.read().collect()) == ["0", "1"] and len(kept.live()) == 1 and len(kept.all()) == 4
    kept.keep_seconds = -1
    kept.add(spark.createDataFrame([("2",)], "k string"), 1)
    assert sorted(run.tier for run in kept.all()) == [0, 1, 1] and sorted(r["k"] for r in kept.read().collect()) == ["0", "1", "2"]


def test_an_index_can_be_made_again(spark, model, tmp_path):  # noqa: F811
    root = str(tmp_path)
    sink = ScoringSink(model, root, "s", 1.0, clock=lambda: NOW)
    for number in range(2):
        sink(batch(spark, [tx(2 * number), tx(2 * number + 1)]), number)
    index = commits.KeyIndex(spark, root, "transactions", KEY)
    visible = tables.read_attempts(spark, root, "transactions").join(commits.visible_attempts(spark, root), commits.ATTEMPT, "left_semi")
    index.rebuild(visible)
    assert len(index._runs("s").all()) == 1
    assert index.known(rows_of(spark, ["t001", "t003", "t009"]), 3, "s", 9).orderBy(KEY).collect() == [("t001",), ("t003",)]


def test_metrics_come_from_the_pass_that_writes(spark, model, tmp_path):  # noqa: F811
    """No job of its own: as many jobs for a batch whether or not the metrics are read."""
    sink = ScoringSink(model, str(tmp_path), "s", 1.0, clock=lambda: NOW)
    sink(batch(spark, [tx(1), tx(2, None), tx(3, 2000.0)]), 0)
    scored = sink.last_metrics
    assert (scored["batch_id"], scored["n_rows"], scored["n_rejected"], scored["n_flagged"]) == (0, 2, 1, 2)
    lowest = tables.read_stored_transactions(spark, str(tmp_path)).agg(F.min("score")).first()[0]
    assert scored["min_score"] == lowest
