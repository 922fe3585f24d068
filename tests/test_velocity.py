from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnwatch.operators import velocity as speed
from txnwatch.operators import timelines
from txnwatch.operators.chunks import own_rows, with_halo

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id string, user_id string, event_time timestamp, country string, amount double"


def history(n=1500, seed=5):
    """A third of the rows belong to one user; some times repeat."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rng.integers(30)}"
        at = START + timedelta(seconds=int(rng.integers(0, 5 * 86_400)) // 7 * 7)
        rows.append((f"t{i:05d}", user, at, str(rng.choice(["US", "CA", "JP"])), 1.0))
    return rows


@pytest.fixture(scope="module")
def rows():
    return history()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(params=[1, 7])
def slices(request, spark):
    """The same with one slice and with many."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def test_gap_equals_brute_force(frame, rows, slices):
    expected, last = {}, {}
    for t, user, at, country, _ in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        before = last.get(user)
        gap = (at - before[0]).total_seconds() if before else None
        changed = before is not None and before[1] != country
        expected[t] = (gap, before[1] if before else None, changed, changed and gap < 6 * 3600)
        last[user] = (at, country)
    got = speed.gap_and_travel(frame).collect()
    assert {r["transaction_id"]: tuple(r)[-4:] for r in got} == expected and len(got) == len(rows)


@pytest.mark.parametrize("seconds", [60, 1800, 90_000])
def test_velocity_equals_brute_force(frame, rows, slices, seconds):
    """The longest reach spans several slices of the hot user."""
    span = timedelta(seconds=seconds)
    by_user = {}
    for t, user, at, *_ in rows:
        by_user.setdefault(user, []).append(at)
    expected = {t: sum(at - span <= other <= at for other in by_user[user]) for t, user, at, *_ in rows}
    got = speed.velocity(frame, limit=4, seconds=seconds).collect()
    assert {r["transaction_id"]: r["n_recent"] for r in got} == expected and len(got) == len(rows)
    assert all(r["too_fast"] == (r["n_recent"] > 4) for r in got)


def test_small_arrow_batches_and_missing_users(spark, rows, slices):
    some = [(t, None if user == "u3" else user, at, None if t.endswith("7") else country, 1.0) for t, user, at, country, _ in rows[:700]]
    some += [(f"tie{i}", "u5", START, "US", 1.0) for i in range(9)]
    df = spark.createDataFrame(some, SCHEMA)
    whole = [sorted(map(tuple, f(df).collect()), key=str) for f in (speed.gap_and_travel, lambda d: speed.velocity(d, seconds=7200))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert [sorted(map(tuple, f(df).collect()), key=str) for f in (speed.gap_and_travel, lambda d: speed.velocity(d, seconds=7200))] == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    span = timedelta(seconds=7200)
    expected = {t: sum(u == user and at - span <= other <= at for _, u, other, *_ in some) for t, user, at, *_ in some}
    assert {row[0]: row[-2] for row in whole[1]} == expected
    assert speed.velocity(df.limit(0)).count() == speed.gap_and_travel(df.limit(0)).count() == 0


def test_one_user_spreads_over_all_tasks(spark, slices):
    """Rows a millisecond apart, all within one chunk of any clock: slices are even in rows."""
    busy = spark.range(70_000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("u").alias("user_id"),
        F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id")).alias("event_time"), F.lit("US").alias("country"))
    stored = timelines.sliced(busy, ["user_id", "transaction_id", "event_time"], "event_time", timelines.count_back(1000), "_n long, _open boolean", "busy")
    sizes = [row["n"] for row in timelines.per_slice(stored)]
    assert len(sizes) == slices and max(sizes) <= 2 * 70_000 / slices
    counted = speed.velocity(busy, seconds=30)
    assert counted.agg(F.min("n_recent"), F.max("n_recent"), F.sum("n_recent")).first() == (1, 30_001, 30_001 * 70_000 - 30_000 * 30_001 // 2)


def test_halo_keeps_every_row_once(frame):
    spread = with_halo(frame, F.unix_micros("event_time"), 3_600_000_000, 60_000_000)
    assert own_rows(spread).count() == frame.count() <= spread.count()
    with pytest.raises(ValueError):
        with_halo(frame, F.unix_micros("event_time"), 10, 11)


def test_windows_and_sessions_in_batch(spark):
    times = [0, 5, 10, 400, 410]
    df = spark.createDataFrame([(str(s), "u", START + timedelta(seconds=s), "US", 2.0) for s in times], SCHEMA)
    windows = speed.windowed_velocity(df, limit=2, seconds=60, slide_seconds=10).collect()
    assert {r["n"] for r in windows} == {3} and len(windows) == 5
    got = sorted((r["n"], r["total_amount"], r["spans_countries"]) for r in speed.sessions(df, gap="60 seconds").collect())
    assert got == [(2, 4.0, False), (3, 6.0, False)]


@pytest.mark.parametrize("chunk", [60, 90, 3600])
def test_silence_of_exactly_the_gap_does_not_end_a_session(spark, chunk):
    """The same on either side of a chunk border, and one second more does end it."""
    times = [0, 60, 120, 181, 241, 302]
    df = spark.createDataFrame([(str(s), "u", START + timedelta(seconds=s), "US", 1.0) for s in times], SCHEMA)
    got = speed.sessions(df, gap="60 seconds", chunk_seconds=chunk).orderBy("session_start").collect()
    assert [r["n"] for r in got] == [3, 2, 1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sessions_equal_brute_force_and_move_as_bursts(spark, rows, tmp_path):
    """Sums of money are exact; what a task hands on is near the bursts, not the rows."""
    some = [(t, None if user == "u3" else user, at, None if i % 5 == 0 else country, Decimal(i % 997) / 100) for i, (t, user, at, country, _) in enumerate(rows)]
    df = spark.createDataFrame(some, SCHEMA.replace("amount double", "amount decimal(12,2)"))
    expected, last = [], {}
    for _, user, at, country, amount in sorted(some, key=lambda r: (r[1] or "", r[2])):
        if user not in last or at - last[user][2] > timedelta(minutes=30):
            last[user] = [user, at, at, 0, Decimal(0), set()]
            expected.append(last[user])
        own = last[user]
        own[2], own[3], own[4] = at, own[3] + 1, own[4] + amount
        own[5] |= {country} - {None}
    want = sorted([(u, a, b + timedelta(minutes=30), n, total, len(places) > 1 if places else None) for u, a, b, n, total, places in expected], key=str)
    for chunk in (600, 86_400):
        got = speed.sessions(df.repartition(3), gap="30 minutes", chunk_seconds=chunk)
        assert sorted(map(tuple, got.collect()), key=str) == want
    busy = spark.range(0, 20_000, 1, 2).select(
        F.lit("u").alias("user_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("event_time"), F.lit("US").alias("country"), F.lit(1.0).alias("amount"))
    assert speed._where_they_lie(busy, "event_time", 60_000_000).count() <= 4
    assert "MapInArrow" in plan_of(speed.sessions(busy)).rsplit("Exchange hashpartitioning", 1)[1]


def test_windows_repeat_counts_and_no_rows(spark, frame):
    from txnwatch.operators.reports import windowed_rates

    for windows in (speed.windowed_velocity(frame, limit=0, seconds=60, slide_seconds=25),
                    windowed_rates(frame.withColumn("is_flagged", F.col("country") == "JP"), window="1 hour", slide="15 minutes")):
        below_the_first_shuffle = plan_of(windows).rsplit("Exchange hashpartitioning", 1)[1]
        assert "Expand" not in below_the_first_shuffle and "Expand" in plan_of(windows)
    plain = frame.groupBy(F.window("event_time", "60 seconds", "25 seconds").alias("slot"), "user_id").agg(F.count("*").alias("n"))
    panes = speed.windowed_velocity(frame, limit=0, seconds=60, slide_seconds=25)
    assert sorted(map(tuple, panes.collect())) == sorted(map(tuple, plain.select("slot.start", "slot.end", "user_id", "n").collect()))
