"""The Voronoi join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnwatch.llm import voronoi

SCHEMA = "vec_id long, embedding array<double>, label int, v string, cell string, query int"


def brute(rows, k=5, every=50):
    width = max((len(v) for _, v in rows if v), default=0)
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable[i, tuple(v)] = np.array([int(np.floor(256 * x)) for x in v] + [0] * (width - len(v)), object)
    found = []
    for (i, _), q in usable.items():
        if i % every == 0:
            scored = sorted((-int(q @ x) if width else 0, j) for (j, _), x in usable.items() if j != i)[:k]
            found += [(i, place + 1, j, -score) for place, (score, j) in enumerate(scored)]
    return sorted(found)


def run(spark, rows, every=50):
    table = spark.createDataFrame([(i, v, 1, "a", "b", 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, voronoi.top_products(table, F.col("vec_id") % every == 0).collect()))


@pytest.mark.parametrize("clusters,piece,group", [(1, 8192, 2048), (12, 64, 8)])
def test_equal_to_all_pairs(spark, monkeypatch, clusters, piece, group):
    monkeypatch.setattr(voronoi, "PIECE", piece)
    monkeypatch.setattr(voronoi, "QUERY_GROUP", group)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((clusters, 16)) * 3
    values = centres[rng.integers(0, clusters, 900)] + rng.standard_normal((900, 16)) * 0.2
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    assert run(spark, rows, 10) == brute(rows, every=10)


def test_odd_rows_and_a_common_vector(spark):
    rows = [(i, [0.5, 0.5]) for i in range(0, 120)] + [(200, None), (250, [None, 1.0]), (300, [float("nan"), 1.0]), (350, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    rows += [(400, [1.0]), (401, [1.0, 2.0, 3.0]), (402, []), (0, [0.5, 0.5]), (450, [-0.001, 0.0])]
    assert run(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(0, [3.0e9, 1.0]), (1, [2.0e9, -1.0]), (2, [-4.0e6, 5.0]), (3, [1.0, 1.0])]
    table = spark.createDataFrame([(i, v, 1, "a", "b", 0) for i, v in rows], SCHEMA)
    got = voronoi.top_products(table, F.col("vec_id") == 3, k=3, scale=1).collect()
    assert sorted(map(tuple, got)) == [(3, 1, 0, 3_000_000_001), (3, 2, 1, 1_999_999_999), (3, 3, 2, -3_999_995)]


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0])]) == [(0, 1, 1, 256 * 128)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == [] and run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, [(0, [])]) == []


def test_query_groups_share_and_split_cells(monkeypatch):
    monkeypatch.setattr(voronoi, "QUERY_GROUP", 10)
    groups = voronoi.query_groups({0: 3, 1: 4, 2: 50, 3: 1})
    assert groups[0] == groups[1] == groups[2] == (0, 6) and groups[3] == (3, 1)
