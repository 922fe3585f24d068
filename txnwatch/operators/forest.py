"""Isolation forest (Liu, Ting and Zhou, ICDM 2008) as Spark jobs.

Trees are grown in parallel, one small group of sampled rows per tree, and kept
as a node table. Scoring runs on Arrow batches next to the data.
"""

import sys
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnwatch.schemas import FEATURES, FOREST_NODE, N_TREES, SEED, SUB_SAMPLE

# Task-side helpers travel inside the closure, so workers need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP_ROWS = 256  # rows of one feature combination before its curve is worth building
STEP_CURVES = 2048  # curves a worker keeps
WALK_ROWS = 1024  # rows followed through the trees at a time
EULER = 0.5772156649


# --- growing -----------------------------------------------------------------

def _uniform(*parts) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def sample_per_tree(
    features: DataFrame, n_rows: int, n_trees: int, sub_sample: int, seed: int, row_key: str
) -> DataFrame:
    """``sub_sample`` rows for each tree, chosen by hashes of the row key.

    The choice depends on keys only, never on partitioning. Keys should be unique:
    few distinct ones may leave a tree without rows, which :func:`load_forest`
    then refuses. A first hash keeps
    about as many rows as are needed in total, a second one about four times the
    rows needed per tree; only those are ranked. Ranking keeps the best rows
    per task before the shuffle, so many copies of one key cannot swamp a tree.
    """
    keep = min(1.0, 1.0 * n_trees * sub_sample / max(n_rows, 1))
    per_tree = min(1.0, 4.0 * sub_sample / max(n_rows * keep, 1.0))
    pool = features.select(row_key, *FEATURES)
    if keep < 1.0:
        pool = pool.filter(_uniform(row_key, F.lit("pool"), F.lit(seed)) < keep)
    pairs = (
        pool.withColumn("tree_id", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))))
        .withColumn("draw", _uniform(row_key, F.col("tree_id"), F.lit(seed)))
        .filter(F.col("draw") < per_tree)
    )
    order = Window.partitionBy("tree_id").orderBy("draw", row_key, *FEATURES)
    return pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sub_sample)


def grow_tree(rows: np.ndarray, depth_limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (id, left, right, feature, split, size, depth) of one random tree."""
    nodes, waiting, next_id = [], deque([(0, rows, 0)]), 1
    while waiting:
        node, part, depth = waiting.popleft()
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (None, None)
        spread = np.flatnonzero(high > low) if len(part) > 1 else np.empty(0, int)
        if depth >= depth_limit or not len(spread):
            nodes.append((node, -1, -1, -1, np.nan, len(part), depth))
            continue
        feature = int(spread[rng.integers(len(spread))])
        split = rng.uniform(low[feature], high[feature])
        if not split < high[feature]:
            split = float(low[feature])
        goes_left = part[:, feature] <= split
        nodes.append((node, next_id, next_id + 1, feature, split, len(part), depth))
        waiting.append((next_id, part[goes_left], depth + 1))
        waiting.append((next_id + 1, part[~goes_left], depth + 1))
        next_id += 2
    return nodes


def fit_forest(
    features: DataFrame,
    n_rows: int,
    n_trees: int = N_TREES,
    sub_sample: int | None = None,
    seed: int = SEED,
    row_key: str = "transaction_id",
) -> DataFrame:
    """Node table of ``n_trees`` trees grown on at most ``sub_sample`` rows each."""
    sub_sample = effective_sample(n_rows, sub_sample)
    depth_limit = int(np.ceil(np.log2(max(sub_sample, 2))))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(key[0])
        ordered = rows.sort_values("place")[list(FEATURES)].to_numpy(np.float64)
        nodes = grow_tree(ordered, depth_limit, np.random.default_rng([seed, tree_id]))
        frame = pd.DataFrame(nodes, columns=FOREST_NODE.names[1:])
        frame.insert(0, "tree_id", tree_id)
        return frame

    # Left alone, samples this small would be merged into one task.
    tasks = min(n_trees, features.sparkSession.sparkContext.defaultParallelism)
    sampled = sample_per_tree(features, n_rows, n_trees, sub_sample, seed, row_key)
    return sampled.repartitionByRange(tasks, "tree_id").groupBy("tree_id").applyInPandas(build, FOREST_NODE)


def effective_sample(n_rows: int, sub_sample: int | None = None) -> int:
    return max(min(sub_sample or SUB_SAMPLE, n_rows), 1)


# --- scoring -----------------------------------------------------------------

def expected_path(size: np.ndarray) -> np.ndarray:
    """Mean depth still to go in a leaf of ``size`` rows."""
    size = np.asarray(size, float)
    far = np.maximum(size, 3.0)
    grown = 2.0 * (np.log(far - 1.0) + EULER) - 2.0 * (far - 1.0) / far
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, grown))


def load_forest(nodes: DataFrame, sub_sample: int, n_trees: int | None = None) -> dict:
    """Arrays for scoring, from a node table whose size is checked first.

    A tree over ``sub_sample`` rows has at most 2 x sub_sample - 1 nodes, however
    much data the forest was grown on. A forest that lacks trees is refused.
    """
    trees, count = nodes.agg(F.count_distinct("tree_id"), F.count("*")).first()
    limit = (n_trees or trees) * (2 * max(sub_sample, 1) - 1)
    if n_trees is not None and trees != n_trees:
        raise ValueError(f"forest has {trees} of {n_trees} trees")
    if not 0 < count <= limit:
        raise ValueError(f"forest of {count} nodes cannot be loaded (limit {limit})")
    return compile_forest(nodes.toPandas(), sub_sample)


def compile_forest(table: pd.DataFrame, sub_sample: int) -> dict:
    tree = pd.factorize(table["tree_id"], sort=True)[0]
    node = table["node_id"].to_numpy()
    shape = (tree.max() + 1, node.max() + 1)
    leaf = table["left"].to_numpy() < 0
    left, right = (np.where(leaf, node, table[side].to_numpy()) for side in ("left", "right"))
    feature = np.where(leaf, 0, table["feature"].to_numpy())
    split = np.where(leaf, np.inf, table["split"].to_numpy(float))
    depth = table["depth"].to_numpy()
    path = depth + expected_path(table["size"].to_numpy())

    roots = np.arange(shape[0]) * shape[1]

    def run(values, kind=np.intp):
        flat = np.zeros(shape, kind)
        flat[tree, node] = values
        return flat.ravel()

    # The box of feature values that leads to each node, level by level.
    low, high = np.full((*shape, len(FEATURES)), -np.inf), np.full((*shape, len(FEATURES)), np.inf)
    for level in range(depth.max()):
        at = np.flatnonzero((depth == level) & ~leaf)
        t, parent, f = tree[at], node[at], feature[at]
        for child in (left[at], right[at]):
            low[t, child], high[t, child] = low[t, parent], high[t, parent]
        high[t, left[at], f] = split[at]
        low[t, right[at], f] = split[at]

    cuts = np.unique(split[~leaf & (feature == 0)])
    at = np.flatnonzero(leaf)
    at = at[np.lexsort((low[tree[at], node[at], 0], tree[at]))]
    box_low, box_high = low[tree[at], node[at]], high[tree[at], node[at]]
    first = np.searchsorted(cuts, box_low[:, 0], side="right")
    last = np.searchsorted(cuts, box_high[:, 0], side="left")
    return {
        "roots": roots, "left": run(left + roots[tree]), "right": run(right + roots[tree]),
        "feature": run(feature), "split": run(split, float), "path": run(path, float),
        "levels": int(depth.max()), "norm": max(float(expected_path(sub_sample)), 1e-12),
        "cuts": cuts, "box_low": box_low[:, 1:], "box_high": box_high[:, 1:],
        "box_path": path[at], "box_width": last - first + 1,
        "seen": {}, "place": {}, "curves": None,
    }


def _to_raw(forest: dict, paths: np.ndarray) -> np.ndarray:
    """Scores from one path length per tree and row.

    Trees are added one after the other. The mean of NumPy picks its order of
    summing by the width of the block, and with it the last bit of a score.
    """
    total = np.zeros(paths.shape[1])
    for tree in paths:
        total += tree
    return -np.exp2(-(total / len(paths)) / forest["norm"])


def walk(forest: dict, rows: np.ndarray) -> np.ndarray:
    """Follow every tree for every row, one level at a time.

    Nodes of all trees lie in one run of arrays; a leaf leads to itself. Rows go
    in blocks small enough for the working arrays to stay in the processor cache.
    """
    blocks = [rows[i:i + WALK_ROWS] for i in range(0, len(rows), WALK_ROWS)]
    return np.concatenate([_walk_block(forest, block) for block in blocks])


def _walk_block(forest: dict, rows: np.ndarray) -> np.ndarray:
    flat = np.ascontiguousarray(rows).ravel()
    start = np.arange(len(rows)) * rows.shape[1]
    at = np.repeat(forest["roots"][:, None], len(rows), axis=1)
    for _ in range(forest["levels"]):
        value = flat.take(forest["feature"].take(at) + start)
        at = np.where(value <= forest["split"].take(at), forest["left"].take(at), forest["right"].take(at))
    return _to_raw(forest, forest["path"].take(at))


def curve(forest: dict, combination: np.ndarray) -> np.ndarray:
    """Raw score for each interval of the amount, the other features being fixed.

    In every tree the leaves open to the combination tile the amount axis.
    """
    open_to = ((forest["box_low"] < combination) & (combination <= forest["box_high"])).all(axis=1)
    paths = np.repeat(forest["box_path"][open_to], forest["box_width"][open_to])
    return _to_raw(forest, paths.reshape(len(forest["roots"]), -1))


def score_rows(forest: dict, rows: np.ndarray) -> np.ndarray:
    """Raw scores in [-1, 0), lower for rows that are easier to isolate.

    Apart from the amount, features take few distinct combinations (hours x
    categories x home or not), and for a fixed combination the score is a step
    function of the amount. Common combinations get that curve once per worker
    and cost one binary search per row; the rest walk the trees. Both give the
    same number to the last bit.
    """
    rows = np.where(np.isnan(rows), np.inf, rows)
    codes = np.zeros(len(rows), np.int64)
    for column in range(1, rows.shape[1]):
        part, values = pd.factorize(rows[:, column])
        codes = pd.factorize(codes * len(values) + part)[0]
    counts = np.bincount(codes)
    example = np.empty(len(counts), np.int64)
    example[codes[::-1]] = np.arange(len(rows))[::-1]

    seen, place = forest["seen"], forest["place"]
    slots = np.full(len(counts), -1)
    for number, (row, count) in enumerate(zip(rows[example, 1:], counts)):
        name = row.tobytes()
        if name not in place and len(place) < STEP_CURVES:
            seen[name] = seen.get(name, 0) + count
            if seen[name] >= STEP_ROWS:
                if forest["curves"] is None:
                    forest["curves"] = np.empty((STEP_CURVES, len(forest["cuts"]) + 1))
                forest["curves"][len(place)] = curve(forest, row)
                place[name] = len(place)
                del seen[name]
            elif len(seen) > 50 * STEP_CURVES:
                seen.clear()
        slots[number] = place.get(name, -1)

    slot = slots[codes]
    out = np.empty(len(rows))
    known = slot >= 0
    if known.any():
        out[known] = forest["curves"][slot[known], np.searchsorted(forest["cuts"], rows[known, 0])]
    if not known.all():
        out[~known] = walk(forest, rows[~known])
    return out


def raw_score_udf(shared):
    """Vectorised function of the five feature columns.

    ``shared`` is the broadcast of the compiled node table, whose size
    :func:`load_forest` checked. Curves built by a worker live in it and serve
    later tasks.
    """

    @F.pandas_udf("double")
    def raw_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            rows = np.column_stack([column.to_numpy(np.float64) for column in batch])
            yield pd.Series(score_rows(model, rows) if len(rows) else np.empty(0))

    return raw_score


def anomaly_score(raw: Column, offset: float) -> Column:
    """Calibrated score: 0 is the boundary, lower is more anomalous."""
    return raw - F.lit(offset)


def predicted_class(score: Column) -> Column:
    return F.when(score < 0, -1).otherwise(1)
