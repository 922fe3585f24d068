"""Exact top-k inner products by a Voronoi join.

Pivots split all vectors into cells. A cell is summed up by its size and radius, a
group of query cells by its largest products with each pivot, its longest query and
the score that all its queries reach at least, known from a few landmark vectors. As
q.x <= q.p + |q| |x - p|, a vector is sent to a group of queries only if its distance
from its pivot lets it reach that score. Each pair of a query group and a piece of a
cell is solved whole in numpy, and the best of a query's answers are kept.

Cases: vectors that are null, have no id or hold a null or non-finite component take
no part; shorter vectors count as zero beyond their end; rows repeated whole count
once; ties go to the smaller id; with fewer than k candidates all are returned; an
empty table gives no rows. Only the id and vector columns are read.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from txnwatch.llm.common import slices
from txnwatch.session import materialize

#: Pivots, and vectors (the pivots among them) whose products give each query its first bound.
PIVOTS, LANDMARKS = 64, 2048
#: Queries of a group, and vectors of a piece of a cell, about.
QUERY_GROUP, PIECE = 2048, 8192


def whole_vectors(table: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """vec_id and v: components times ``scale``, rounded down."""
    values = F.col(embedding).cast("array<double>")
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.filter(F.col(embedding).isNotNull() & F.col(vec_id).isNotNull() & usable)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(values, lambda x: F.floor(x * scale)).alias("v")).distinct()


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, zero beyond their end."""
    starts = np.asarray(column.offsets, np.int64)
    values = np.asarray(column.values, np.int64)
    lengths = np.diff(starts)
    found = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    found[rows, np.arange(starts[0], starts[-1]) - np.repeat(starts[:-1], lengths)] = values[starts[0]: starts[-1]]
    return found


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products: in floating point while every sum stays a whole double, else in whole numbers."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2.0 ** 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))


def place(vectors: DataFrame, pivots: np.ndarray, landmarks: np.ndarray, landmark_ids: np.ndarray, is_query, k: int) -> DataFrame:
    """Adds cell, distance from its pivot, and for queries length, products with the pivots and the score that is surely reached."""
    width = pivots.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2048):
            rows, query = matrix(batch.column(1), width), batch.column(2).to_numpy(zero_copy_only=False)
            gaps = np.stack([_lengths(rows - pivot) for pivot in pivots], axis=1)
            cell = gaps.argmin(axis=1)
            near, sure, length = products(rows, pivots), np.full(len(rows), -np.inf), _lengths(rows)
            if query.any():
                scores = products(rows[query], landmarks).astype(np.float64)
                scores[batch.column(0).to_numpy()[query][:, None] == landmark_ids[None, :]] = -np.inf
                if scores.shape[1] >= k:
                    sure[query] = -np.sort(-scores, axis=1)[:, k - 1]
            dots = [row.tolist() if is_query else None for row, is_query in zip(near, query)]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(i) for i in range(3)), pa.array(cell.astype(np.int32)), pa.array(gaps.min(axis=1)), pa.array(length),
                pa.array(sure), pa.array(dots, pa.list_(pa.float64())),
            ], ["vec_id", "v", "query", "cell", "gap", "length", "sure", "dots"])

    return vectors.withColumn("query", is_query).mapInArrow(
        run, "vec_id long, v array<long>, query boolean, cell int, gap double, length double, sure double, dots array<double>")


def query_groups(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Cell -> its group and the parts that the group is dealt into; small cells share a group."""
    groups, members, size = {}, [], 0
    for cell in sorted(counts):
        members.append(cell)
        size += counts[cell]
        if size >= QUERY_GROUP or cell == max(counts):
            groups |= {member: (members[0], -(-size // QUERY_GROUP)) for member in members}
            members, size = [], 0
    return groups


def top_products(table: DataFrame, is_query, k: int = 5, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: for each row that ``is_query`` (over vec_id) picks, its k largest products with all other rows."""
    spark = table.sparkSession
    vectors = materialize(whole_vectors(table, vec_id, embedding, scale), "vectors")
    marks = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(LANDMARKS).toArrow().combine_chunks()
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    empty = "query_id long, rank int, vec_id long, score long"
    if not marks.num_rows or not width:
        return spark.createDataFrame([], empty)
    landmarks, landmark_ids = matrix(marks["v"].combine_chunks() if isinstance(marks["v"], pa.ChunkedArray) else marks["v"], width), marks["vec_id"].to_numpy()
    placed = materialize(place(vectors, landmarks[:PIVOTS], landmarks, landmark_ids, is_query, k), "placed-vectors")

    # summaries: a row per cell, or per group of query cells and pivot; pivots bound them all
    cells = {row["cell"]: row for row in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("gap").alias("radius"), F.count_if("query").alias("queries")).collect()}
    groups = query_groups({cell: row["queries"] for cell, row in cells.items() if row["queries"]})
    if not groups:
        return spark.createDataFrame([], empty)
    group_of = F.create_map(*[F.lit(x) for cell, (group, _) in groups.items() for x in (cell, group)])
    queries = placed.filter("query").withColumn("group", group_of[F.col("cell")])
    bounds = {row["group"]: row for row in queries.groupBy("group").agg(
        F.min("sure").alias("sure"), F.max("length").alias("length"),
        F.array(*[F.max(F.col("dots")[j]) for j in range(len(landmarks[:PIVOTS]))]).alias("dots")).collect()}
    parts = {group: n for group, n in groups.values()}
    needs = [(group, cell, float((row["sure"] - row["dots"][cell]) / max(row["length"], 1e-9)) - 1e-6 * (1 + cells[cell]["radius"]), parts[group], -(-cells[cell]["n"] // PIECE))
             for group, row in bounds.items() for cell in cells]
    needs = [need for need in needs if cells[need[1]]["radius"] >= need[2]]
    pairs = spark.createDataFrame(needs, "group int, to_cell int, least double, parts int, pieces int")

    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    data = placed.join(F.broadcast(pairs), (F.col("cell") == F.col("to_cell")) & (F.col("gap") >= F.col("least"))).select(
        "vec_id", "v", "group", "to_cell", every("parts").alias("part"), deal("pieces", 1).alias("piece"), F.lit(False).alias("query"))
    asked = queries.join(F.broadcast(pairs), "group").select(
        "vec_id", "v", "group", "to_cell", deal("parts", 2).alias("part"), every("pieces").alias("piece"), F.lit(True).alias("query"))
    unit = ["group", "part", "to_cell", "piece"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = data.unionByName(asked).select(*unit, "query", "vec_id", "v").repartition(tasks, *unit).sortWithinPartitions(*unit, "query")

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def close() -> pa.RecordBatch:
            query = np.concatenate([b.column(4).to_numpy(zero_copy_only=False) for b in held])
            ids = np.concatenate([b.column(5).to_numpy() for b in held])
            rows = np.concatenate([matrix(b.column(6), width) for b in held])
            found = best_products(rows[query], ids[query], rows[~query], ids[~query], k)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for start, end in zip(cuts, cuts[1:]):
                if held and tuple(keys[start]) != key:
                    yield close()
                    held.clear()
                key = tuple(keys[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield close()

    local = dealt.mapInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best_products(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of ``rows`` for each query, ties to the smaller id, the query's own id left out."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    found = []
    for start in range(0, len(queries), 256):
        scores = products(queries[start: start + 256], rows)
        own = query_ids[start: start + 256, None] == ids[None, :]
        scores[own] = -np.iinfo(np.int64).max
        best = np.argsort(-scores, axis=1, kind="stable")[:, :k] if scores.shape[1] else np.zeros((len(scores), 0), np.int64)
        asked = np.repeat(query_ids[start: start + 256], best.shape[1])
        real = ~np.take_along_axis(own, best, axis=1).ravel()
        found.append((asked[real], ids[best.ravel()][real], np.take_along_axis(scores, best, axis=1).ravel()[real]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


ORACLE_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS place
  FROM usable AS q JOIN usable AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""
