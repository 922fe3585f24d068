"""Daily statistics that are kept, merged and refitted from."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from txnwatch.operators.features import fit_features
from txnwatch.operators.statistics import DailyStatistics
from txnwatch.plans import training

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = "transaction_id string, user_id string, amount double, merchant_category string, timestamp string, country string, is_anomaly boolean, event_time timestamp"


@pytest.fixture(scope="module")
def rows(spark):
    """Five days, 80 rows a day, with nulls in every column."""
    kinds, places = ["atm", "gas", "travel", None], ["US", "DE", None]
    data = []
    for i in range(400):
        at = START + timedelta(minutes=18 * i)
        data.append((f"t{i:03d}", None if i % 41 == 0 else f"u{i % 7}", None if i % 37 == 0 else 5.0 + (i * i) % 97,
                     kinds[(i // 3) % 4], f"{at:%Y-%m-%dT%H:%M:%SZ}", places[i * i % 3], i % 19 == 0 or (None if i % 5 == 0 else False),
                     None if i % 53 == 52 else at))
    return spark.createDataFrame(data, SCHEMA).cache()


def same(state, plain):
    for name in ("amount_mean", "amount_std", "merchant_freq_fallback"):
        assert getattr(state, name) == pytest.approx(getattr(plain, name), abs=1e-12)
    for name in ("n_rows", "n_categories", "n_users"):
        assert getattr(state, name) == getattr(plain, name)
    for name in ("merchant_freq", "user_home"):
        assert sorted(map(tuple, getattr(state, name).collect())) == sorted(map(tuple, getattr(plain, name).collect()))


@pytest.fixture(scope="module")
def kept(spark, rows, tmp_path_factory):
    statistics = DailyStatistics(spark, str(tmp_path_factory.mktemp("kept")))
    for third in range(3):
        statistics.add(rows.filter(F.substring("transaction_id", 4, 1).cast("int") % 3 == third), f"part{third}")
    return statistics


@pytest.mark.parametrize("first", [None, START, START + timedelta(days=2), START + timedelta(days=2, hours=7, seconds=1), START + timedelta(days=4, hours=23)])
def test_the_same_as_a_full_fit(rows, kept, first):
    recent = rows.filter(F.col("event_time").isNotNull())
    if first is not None:
        recent = recent.filter(F.col("event_time") >= F.lit(first))
    state, n_amounts = kept.state_since(rows, first)
    same(state, fit_features(recent))
    assert n_amounts == recent.filter("amount IS NOT NULL").count()


def test_whole_days_read_no_raw_rows(spark, kept):
    unread = spark.createDataFrame([], SCHEMA).withColumn("event_time", F.raise_error(F.lit("read")).cast("timestamp"))
    assert kept.state_since(unread, START + timedelta(days=1))[0].n_rows > 0


def test_repeated_merged_and_stopped_additions(spark, rows, tmp_path, monkeypatch):
    timed = rows.filter(F.col("event_time").isNotNull())
    statistics, plain = DailyStatistics(spark, str(tmp_path)), fit_features(timed)
    halves = [timed.filter(F.col("event_time") < F.lit(START + timedelta(days=2, hours=5)))]
    halves.append(timed.exceptAll(halves[0]))
    assert statistics.compact() == 0 and statistics.state_since(rows)[0].n_rows == 0
    assert statistics.add(halves[1], "a") and statistics.add(halves[0], "a")
    assert statistics.state_since(rows)[0].n_rows == halves[0].count(), "an addition that is repeated replaces the first"
    assert statistics.compact() == 1
    assert not statistics.add(halves[0], "a"), "it is merged already"
    assert statistics.add(timed.limit(0), "empty") and statistics.add(halves[1], "b")
    same(statistics.state_since(rows)[0], plain)
    assert statistics.compact() == 2 and not statistics.add(halves[0], "a") and not statistics.add(halves[1], "b")
    same(statistics.state_since(rows)[0], plain)

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(statistics._log, "add", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        statistics.add(halves[0], "c")
    monkeypatch.undo()
    same(statistics.state_since(rows)[0], plain)


def test_only_files_of_recent_days_hold_what_is_asked(spark, rows, kept):
    wanted = kept._read("countries").filter(F.col("day") >= 19785)
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day,19785)]" in wanted._jdf.queryExecution().toString()


@pytest.mark.parametrize("recent", [{"since": START + timedelta(days=3, hours=6)}, {"last_n": 130}, {"last_n": 130, "since": START + timedelta(days=4)}, {"last_n": 10_000}])
def test_retraining_gives_the_same_model(rows, kept, tmp_path, recent):
    timed = rows.filter(F.col("event_time").isNotNull())
    plain = training.retrain(timed, f"{tmp_path}/plain", n_trees=5, **recent)
    model = training.retrain(rows, f"{tmp_path}/kept", n_trees=5, statistics=kept, **recent)
    same(model.state, plain.state)
    assert model.offset == pytest.approx(plain.offset, abs=1e-9)


def test_statistics_of_other_rows_are_refused(spark, rows, tmp_path):
    statistics = DailyStatistics(spark, f"{tmp_path}/statistics")
    statistics.add(rows.filter("transaction_id < 't300'"), "most")
    with pytest.raises(ValueError, match="add what is missing"):
        training.retrain(rows, f"{tmp_path}/models", n_trees=2, statistics=statistics)
    with pytest.raises(ValueError, match="positive"):
        training.retrain(rows, f"{tmp_path}/models", last_n=0, statistics=statistics)


def test_an_addition_reads_its_rows_once(spark, tmp_path):
    """Both statistics come from one scan of what is added, and of the day that is cut."""
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    at = F.timestamp_seconds(F.lit(1_705_276_800) + F.col("id") * 60)
    rows = spark.range(300).select(
        F.col("id").cast("double").alias("amount"), F.lit("atm").alias("merchant_category"), F.lit("u").alias("user_id"),
        F.lit("US").alias("country"), (F.col("id") % 9 == 0).alias("is_anomaly"), at.alias("event_time"))
    counted = rows.mapInArrow(passing, rows.schema)
    statistics = DailyStatistics(spark, f"{tmp_path}/kept")
    assert statistics.add(counted, "all") and read.value == 300
    state, n_amounts = statistics.state_since(counted, datetime(2024, 1, 15, 1, tzinfo=timezone.utc))
    assert (state.n_rows, n_amounts, read.value) == (240, 240, 600)
