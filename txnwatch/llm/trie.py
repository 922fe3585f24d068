"""The prefix trie of conversations, peeled from its deepest turns to the root.

A node is a distinct sequence of first turns. It is known by its depth and a rolling
128-bit hash, exclusive-or of the hashes of its turns with their places, so stripping
the last turn takes one more exclusive-or. Each conversation is stripped turn by turn;
prefixes that come out alike are one node, grouped and counted as they are met.

What is summed over a subtree travels up with the truncation. As long as all members of
a node go on with the same turn, stripping it merges nothing, so such a run is stripped
at once: nodes of one smallest member and one number of members. A wave strips all runs
below which everything has arrived, regroups what is left of them, and hands up sums; a
run waits until all its children have come. There are as many waves as runs on the
longest way from a leaf to the root, whatever the length of the conversations.

Turns are put in order in even slices, counted and carried over from slice to slice, and
hashes roll inside stretches of ``STRETCH`` turns, so a conversation with a large share
of all turns is many groups. Nodes and runs with many rows are joined through
``join_counted``. The digest of the conversations that end at a node is by definition
one string; their ids stream through one task in order, and are never held together.

Cases: turns without a number come first, those of one number are ordered by role and
text, and repeated rows are turns of their own; null role and text are empty; rows
without a conversation id belong to no conversation; a conversation may end at the root;
an empty table gives no rows. Only the four columns are read.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnwatch.llm.common import few_rows_at_a_time, join_counted
from txnwatch.session import materialize

#: Turns of a stretch, and characters by which even slices are cut.
STRETCH, SLICED_BY = 1024, 64
#: A conversation is rebuilt from that of its hundred, of which it takes the first 0 to 5 turns.
FAMILY, MOST_TAKEN = 100, 5
NO_ENDS = hashlib.sha256().hexdigest()
_KEY = ["depth", "a", "b"]


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, 3 ...), two hashes of role and text, and chars (code points of the text), stored."""
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("role", "text")])
    sliced = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, SLICED_BY), F.substring("text", 1, SLICED_BY))
    sliced = sliced.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "conv_id", F.xxhash64("role", "text").alias("x"), F.xxhash64(F.lit("second"), "text", "role").alias("y"),
        F.length("text").cast("long").alias("chars"), F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("row"))
    sliced = materialize(sliced, "numbered-turns")
    # a conversation lies in neighbouring slices, in order
    parts = sliced.groupBy("conv_id", "slice").agg(F.min("row").alias("start"), F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    placed = join_counted(sliced, materialize(parts, "turn-slices"), ["conv_id", "slice"], "size", F.col("row"))
    return materialize(placed.select("conv_id", (F.col("before") + F.col("row") - F.col("start") + 1).alias("place"), "x", "y", "chars"), "placed-turns")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, x, y, chars), and the conversations (conv_id, n_turns)."""
    sizes = materialize(placed.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = sizes.select("conv_id", "n", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_TAKEN + 1)).alias("take"), family.alias("first_of"))
    first = sizes.filter(F.col("conv_id") == family).select(F.col("conv_id").alias("first_of"), F.col("n").alias("n_first"))
    convs = convs.join(first, "first_of", "left").withColumn("taken", F.least("take", F.coalesce("n_first", F.lit(0))))
    convs = materialize(convs.select("conv_id", "first_of", "n", "take", "taken"), "families")
    heads = placed.filter((F.col("conv_id") == family) & (F.col("place") <= MOST_TAKEN)).withColumnRenamed("conv_id", "first_of")
    taken = convs.select("conv_id", "first_of", "take").join(heads, "first_of").filter("place <= take")
    own = join_counted(placed, convs.select("conv_id", "n", "take", "taken"), ["conv_id"], "n", F.col("place")).filter("place > take")
    columns = ["conv_id", "depth", "x", "y", "chars"]
    turns = taken.withColumn("depth", F.col("place")).select(columns).unionAll(own.withColumn("depth", F.col("taken") + F.col("place") - F.col("take")).select(columns))
    return turns, convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("take"), F.lit(0))).alias("n_turns"))


def prefixes(turns: DataFrame) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, its hash (a, b), that of the prefix without the last turn (pa, pb), chars of the last text, upto (of all texts)."""
    rows = turns.select(
        "conv_id", "depth", F.floor((F.col("depth") - 1) / STRETCH).alias("stretch"), "chars",
        F.xxhash64("depth", "x", "y").alias("ta"), F.xxhash64("y", "depth", "x").alias("tb"))
    parts = rows.groupBy("conv_id", "stretch").agg(F.bit_xor("ta").alias("a"), F.bit_xor("tb").alias("b"), F.sum("chars").alias("c"), F.count("*").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("conv_id", "stretch", "size", *[
        F.coalesce(function(name).over(earlier), F.lit(0)).alias(f"before_{name}") for name, function in (("a", F.bit_xor), ("b", F.bit_xor), ("c", F.sum))])
    inside = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = rows.select("*", F.bit_xor("ta").over(inside).alias("a"), F.bit_xor("tb").over(inside).alias("b"), F.sum("chars").over(inside).alias("c"))
    rolled = rolled.join(carried, ["conv_id", "stretch"])
    a, b = F.col("a").bitwiseXOR(F.col("before_a")), F.col("b").bitwiseXOR(F.col("before_b"))
    return rolled.select(
        "conv_id", "depth", a.alias("a"), b.alias("b"), a.bitwiseXOR(F.col("ta")).alias("pa"), b.bitwiseXOR(F.col("tb")).alias("pb"),
        "chars", (F.col("c") + F.col("before_c")).alias("upto"))


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of conversations that end at a node (depth, a, b), ascending, between commas."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([value]) for value in (*node, state.hexdigest())], [*_KEY, "ends_sha256"])

        for batch in batches:
            keys = np.stack([np.asarray(batch.column(i), np.int64) for i in range(3)], axis=1)
            ids = np.asarray(pc.cast(batch.column(3), pa.string()))
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            closed = []
            for start, end in zip(cuts, cuts[1:]):
                if end == start:
                    continue
                if node != (here := tuple(keys[start].tolist())):
                    if node is not None:
                        closed.append(row())
                    node, state = here, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(ids[start:end]).encode())
            if closed:
                yield pa.Table.from_batches(closed).combine_chunks().to_batches()[0]
        if node is not None:
            yield row()

    dealt = ends.select(*_KEY, "conv_id").repartition(*_KEY).sortWithinPartitions(*_KEY, "conv_id")
    return few_rows_at_a_time(dealt).mapInArrow(run, "depth long, a long, b long, ends_sha256 string")


def peeled(runs: DataFrame) -> DataFrame:
    """``runs`` with leaves and saved, each summed over the subtree of the run's top.

    A run has its lower end (depth, a, b), what its upper end hangs on (p_depth, pa, pb; null at the root), the number
    of its children (kids) and what it saves by itself (own).
    """
    state = runs.select(*_KEY, "p_depth", "pa", "pb", "kids", F.col("own").alias("saved"), F.when(F.col("kids") == 0, 1).otherwise(0).cast("long").alias("leaves"))
    waves: list[DataFrame] = []
    while True:
        waves.append(materialize(state.filter("kids = 0"), "peeled-runs"))
        state = state.filter("kids > 0")
        arrived = waves[-1].filter("p_depth IS NOT NULL").groupBy(F.col("p_depth").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.count("*").alias("came"), F.sum("saved").alias("more"), F.sum("leaves").alias("more_leaves"))
        state = state.join(arrived, _KEY, "left").select(
            *_KEY, "p_depth", "pa", "pb", (F.col("kids") - F.coalesce("came", F.lit(0))).alias("kids"),
            (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"))
        state = materialize(state, "waiting-runs")
        if state.isEmpty():
            break
    done = waves[0]
    for wave in waves[1:]:
        done = done.unionAll(wave)
    return done.select(*_KEY, "leaves", "saved")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = rebuilt(numbered_turns(turns))
    paths = materialize(prefixes(rows), "conversation-prefixes")
    convs = materialize(convs, "rebuilt-conversations")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).filter("n > 0").select(
        *[F.lit(0).cast("long").alias(name) for name in _KEY], "conv_id", "n",
        *[F.lit(None).cast("long").alias(name) for name in ("pa", "pb")], *[F.lit(0).cast("long").alias(name) for name in ("chars", "upto")])
    nodes = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), *[F.min(name).alias(name) for name in ("pa", "pb", "chars", "upto")])
    nodes = materialize(nodes.unionAll(root), "trie-nodes")

    # a run: nodes with the same members, between two turns where members part, end, or are one
    top = F.min(F.struct("depth", "pa", "pb", (F.col("upto") - F.col("chars")).alias("above"))).alias("top")
    bottom = F.max(F.struct("depth", "a", "b", "upto")).alias("bottom")
    runs = nodes.groupBy("conv_id", "n").agg(top, bottom).select(
        "conv_id", "n", "bottom.depth", "bottom.a", "bottom.b", "top.above", F.col("top.depth").alias("top"),
        F.when(F.col("top.depth") > 0, F.col("top.depth") - 1).alias("p_depth"), "top.pa", "top.pb", ((F.col("n") - 1) * (F.col("bottom.upto") - F.col("top.above"))).alias("own"))
    runs = materialize(runs, "trie-runs")
    children = runs.filter("p_depth IS NOT NULL").groupBy(F.col("p_depth").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("kids"))
    runs = materialize(runs.join(children, _KEY, "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "trie-runs")

    sums = peeled(runs)
    ending = paths.join(convs.select(F.col("conv_id"), F.col("n_turns").alias("depth")), ["conv_id", "depth"]).select(*_KEY, "conv_id")
    ending = ending.unionAll(convs.filter("n_turns = 0").select(*[F.lit(0).cast("long").alias(name) for name in _KEY], "conv_id"))
    parents = runs.filter("kids > 0").select(
        F.col("depth").alias("p_depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("above_conv"), "kids")
    whole = join_counted(runs.drop("own").withColumnRenamed("kids", "n_kids"), materialize(parents, "trie-parents"), ["p_depth", "pa", "pb"], "kids", F.col("conv_id"))
    whole = whole.join(sums, _KEY).join(end_digests(ending), _KEY, "left")
    whole = materialize(whole.select(
        "conv_id", "n", "top", F.col("depth").alias("bottom"), "above", "above_conv", F.col("n_kids").alias("kids"), "leaves", "saved", "ends_sha256",
        (F.col("depth") - F.col("top") + 1).alias("size")), "whole-runs")

    found = join_counted(nodes.select("conv_id", "depth", "n", "chars", "upto"), whole, ["conv_id", "n"], "size", F.col("depth"))
    at_end: Column = F.col("depth") == F.col("bottom")
    return found.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("above_conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(at_end, F.col("kids")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n") - 1) * (F.col("upto") - F.col("chars") - F.col("above"))).alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends_sha256", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"))


ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id
), convs AS (
  SELECT conv_id, conv_id - conv_id % {FAMILY} AS first_of, n,
         xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda sum, byte: list_reduce(list_concat([xor(sum, byte)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda v, step: xor(v >> 1, 3988292384::UBIGINT * (v & 1::UBIGINT)))), 4294967295::UBIGINT) % {MOST_TAKEN + 1} AS take
  FROM sizes
), rebuilt AS (
  SELECT c.conv_id, t.place AS depth, role, text FROM convs c JOIN turns t ON t.conv_id = c.first_of AND t.place <= c.take
  UNION ALL
  SELECT c.conv_id, t.place - c.take + least(c.take, coalesce(f.n, 0)) AS depth, role, text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.take LEFT JOIN sizes f ON f.conv_id = c.first_of
), paths AS (
  SELECT conv_id, depth, text, count(*) OVER (PARTITION BY conv_id) AS n_turns,
         sha256(string_agg(sha256(role) || sha256(text), '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM rebuilt
  UNION ALL
  SELECT conv_id, 0, '', (SELECT count(*) FROM rebuilt r WHERE r.conv_id = convs.conv_id), '' FROM convs
), nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(length(text)) AS own,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, node
), placed AS (
  SELECT nodes.*, up.node AS parent, above.conv_id AS parent_conv_id
  FROM nodes LEFT JOIN paths up ON up.conv_id = nodes.conv_id AND up.depth = nodes.depth - 1
  LEFT JOIN nodes above ON above.node = up.node AND above.depth = up.depth
), children AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM placed WHERE depth > 0 GROUP BY ALL
), whole AS (
  SELECT placed.*, coalesce(n_children, 0) AS n_children FROM placed LEFT JOIN children ON children.parent = placed.node AND children.depth = placed.depth
), sums AS (
  SELECT up.node, up.depth, sum(own)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM whole JOIN paths up ON up.conv_id = whole.conv_id AND up.depth <= whole.depth GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM whole JOIN sums USING (node, depth)
"""
