import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txnwatch.operators import forest as fo
from txnwatch.plans.catalog import FIXED_FOREST
from txnwatch.schemas import FEATURES, FOREST_NODE


def table(nodes):
    return pd.DataFrame(nodes, columns=FOREST_NODE.names)


def grown(n_trees=20, rows=256, seed=3):
    rng = np.random.default_rng(seed)
    nodes = []
    for tree in range(n_trees):
        data = np.column_stack([rng.normal(size=rows), rng.integers(0, 24, rows), rng.integers(0, 4, rows),
                                rng.integers(0, 5, rows), rng.integers(0, 2, rows)]).astype(np.float32).astype(float)
        nodes += [(tree, *node) for node in fo.grow_tree(data, 8, np.random.default_rng([seed, tree]))]
    return fo.compile_forest(table(nodes), rows)


def points(n, seed=9):
    rng = np.random.default_rng(seed)
    return np.column_stack([rng.normal(size=n) * 2, rng.choice([-1, 3, 9, 24], n), rng.integers(0, 2, n),
                            rng.integers(0, 6, n), rng.integers(0, 2, n)]).astype(np.float32).astype(float)


def brute(nodes, row, sub_sample):
    """One row at a time, straight from the node table."""
    by_tree = {}
    for tree, node, *rest in nodes:
        by_tree.setdefault(tree, {})[node] = rest
    total = 0.0
    for tree in by_tree.values():
        node = 0
        while tree[node][0] >= 0:
            left, right, feature, split = tree[node][:4]
            node = left if row[feature] <= split else right
        size, depth = tree[node][4:6]
        total += depth + float(fo.expected_path(size))
    return -(2.0 ** (-(total / len(by_tree)) / float(fo.expected_path(sub_sample))))


@pytest.fixture(autouse=True)
def early_curves(monkeypatch):
    monkeypatch.setattr(fo, "STEP_ROWS", 16)


def test_expected_path():
    assert list(fo.expected_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    assert float(fo.expected_path(256)) == pytest.approx(2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_walk_and_curves_agree_to_the_last_bit():
    forest, rows = grown(), points(12_000)
    walked = fo.walk(forest, rows)
    assert np.array_equal(fo.score_rows(forest, rows), walked)
    assert forest["place"], "common combinations should have curves by now"
    assert np.array_equal(fo.score_rows(forest, rows), walked)


def test_cut_values_themselves_agree():
    forest = grown()
    rows = np.repeat(points(3), len(forest["cuts"]), axis=0)
    rows[:, 0] = np.tile(forest["cuts"], 3)
    assert np.array_equal(fo.score_rows(forest, rows), fo.walk(forest, rows))


def test_full_curve_store_falls_back_to_walking(monkeypatch):
    monkeypatch.setattr(fo, "STEP_CURVES", 3)
    forest, rows = grown(), points(12_000)
    assert np.array_equal(fo.score_rows(forest, rows), fo.walk(forest, rows))
    assert len(forest["place"]) == 3


def test_missing_values_go_right():
    forest = grown()
    rows = points(200)
    rows[:, 0] = np.nan
    rows[::2, 3] = np.nan
    assert np.array_equal(fo.score_rows(forest, rows), fo.walk(forest, np.where(np.isnan(rows), np.inf, rows)))


def test_matches_row_by_row_reading_of_the_table():
    forest = fo.compile_forest(table(FIXED_FOREST), 256)
    rows = points(300)
    assert np.allclose(fo.score_rows(forest, rows), [brute(FIXED_FOREST, row, 256) for row in rows], atol=1e-12)


def test_tree_shape():
    rng = np.random.default_rng(0)
    data = rng.normal(size=(256, 5))
    data[:, 2] = 1.0
    nodes = fo.grow_tree(data, 8, rng)
    leaves = [n for n in nodes if n[1] < 0]
    assert sum(n[5] for n in leaves) == 256 and max(n[6] for n in nodes) <= 8
    assert 2 not in {n[3] for n in nodes}, "a constant feature cannot split"
    assert all(n[1] > n[0] and n[2] == n[1] + 1 for n in nodes if n[1] >= 0)


@pytest.mark.parametrize("data", [np.zeros((1, 5)), np.ones((40, 5))])
def test_unsplittable_data_gives_one_leaf(data):
    nodes = fo.grow_tree(data, 8, np.random.default_rng(0))
    assert len(nodes) == 1 and nodes[0][1] == -1 and nodes[0][5] == len(data)


def features(spark, n):
    noise = [(F.randn(seed) if seed < 2 else F.floor(F.rand(seed) * 5)).cast("float") for seed in range(5)]
    return spark.range(n).select(F.col("id").cast("string").alias("transaction_id"), *[v.alias(c) for v, c in zip(noise, FEATURES)])


@pytest.mark.parametrize("n", [50, 3000, 40_000])
def test_samples_are_full_and_distinct(spark, n):
    pooled = features(spark, n)
    size = fo.effective_sample(n, 64)
    got = fo.sample_per_tree(pooled, n, 10, size, 1, "transaction_id").groupBy("tree_id").agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("d")).collect()
    assert {(r["n"], r["d"]) for r in got} == {(size, size)} and len(got) == 10


def test_forest_depends_on_seed_not_on_partitioning(spark):
    from txnwatch.session import materialize

    rows = materialize(features(spark, 2000), "f")

    def build(df, seed):
        return sorted(map(tuple, fo.fit_forest(df, 2000, 5, 64, seed).fillna(-9.0).collect()))

    assert build(rows.repartition(1), 1) == build(rows.repartition(7, "hour_sin"), 1) != build(rows, 2)


def test_many_copies_of_one_key(spark):
    copies = features(spark, 3000).withColumn(
        "transaction_id", F.when(F.col("transaction_id").cast("int") % 3 == 0, "same").otherwise(F.col("transaction_id")))
    got = fo.sample_per_tree(copies, 3000, 10, 64, 1, "transaction_id").groupBy("tree_id").count().collect()
    assert {r["count"] for r in got} == {64}


def test_refuses_an_oversized_or_empty_forest(spark):
    nodes = spark.createDataFrame(FIXED_FOREST, FOREST_NODE)
    with pytest.raises(ValueError):
        fo.load_forest(nodes.limit(0), 256)
    with pytest.raises(ValueError):
        fo.load_forest(nodes, 2)
    with pytest.raises(ValueError):
        fo.load_forest(nodes, 256, 4)


def test_a_score_does_not_depend_on_its_batch(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(4000, 5)).astype(np.float32).astype(float)
    trees = [(t, *node) for t in range(100) for node in fo.grow_tree(data[rng.choice(4000, 256, False)], 8, rng)]
    forest = fo.compile_forest(pd.DataFrame(trees, columns=FOREST_NODE.names), 256)
    rows = data[:2050]
    whole = fo.walk(forest, rows)
    for width in (1, 2, 1024, 1025):
        parts = [fo.walk(forest, rows[i: i + width]) for i in range(0, len(rows), width)]
        assert (np.concatenate(parts) == whole).all(), width
    combination = rows[0, 1:]
    cuts = fo.curve(forest, combination)
    alike = np.column_stack([rows[:, 0], np.repeat(combination[None], len(rows), axis=0)])
    assert (cuts[np.searchsorted(forest["cuts"], alike[:, 0])] == fo.walk(forest, alike)).all()


def test_a_forest_that_lacks_trees_is_refused(spark):
    rows = features(spark, 60_000).withColumn("transaction_id", F.lit("one"))
    with pytest.raises(ValueError):
        fo.load_forest(fo.fit_forest(rows, 60_000, 20, 64), 64, 20)
