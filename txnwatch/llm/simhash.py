"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints are
one node. Nodes are laid out in cells by the population counts of the four quarters
of the fingerprint: two fingerprints at distance r have counts that differ by r at
most in sum, so all other pairs of cells are skipped. Cells are cut into tiles of
bounded size; each pair of tiles is compared whole with exclusive-or and bit counts
in numpy, and hands on a spanning forest of the links that it finds. Components then
join over the forests.

Cases: null text counts as empty; texts without a word have fingerprint zero and
are linked like any other; rows that repeat an id keep their rows, and a null id is
a component's id only if it has no other; an empty table gives no rows. Only
``doc_id`` and ``text`` are read.
"""

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from txnwatch.llm.common import fresh, join_counted, map_batches, texts_of
from txnwatch.llm.components import components
from txnwatch.session import materialize

#: Shingles that are hashed at a time.
STRETCH = 1 << 16
#: Nodes on each side of a pair of tiles; the comparisons held at a time.
TILE, HELD = 1 << 14, 1 << 21
SEED = 42


def fingerprint(text: str, width: int = 3) -> int:
    """A bit is set if it is set in over half of the hashes of all shingles, repeats included."""
    words = text.encode().lower().split()
    n = max(1, len(words) - width + 1) if words else 0
    counts = np.zeros(64, np.int64)
    for start in range(0, n, STRETCH):
        end = min(n, start + STRETCH)
        part = words[start: end + width - 1]
        shingles = map(b" ".join, zip(*(part[i: i + end - start] for i in range(width)))) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, end - start)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(text, width) for text in texts_of(batch)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, bits long")


def neighbour_steps(radius: int) -> list[int]:
    """Differences of cell numbers between which distances up to ``radius`` are possible, one of each two directions."""
    span = range(-radius, radius + 1)
    steps = [(a, b, c, d) for a in span for b in span for c in span for d in span if sum(map(abs, (a, b, c, d))) <= radius]
    return sorted(number for step in steps if (number := cell_number(step)) >= 0)


def cell_number(counts) -> int:
    """Counts of 0 to 16 and steps between them, five bits each and some to spare, never run into each other."""
    number = 0
    for count in counts:
        number = number * 64 + count
    return number


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over all pairs of the two sides within ``radius``."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    root = np.arange(len(nodes))
    rows = max(1, HELD // max(1, len(right)))
    for start in range(0, len(left), rows):
        distance = np.bitwise_count(left[start: start + rows, None] ^ right[None, :])
        a, b = np.nonzero(distance <= radius)
        a, b = place[:len(left)][a + start], place[len(left):][b]
        a, b = a[a != b], b[a != b]
        while len(a):
            low = np.minimum(root[a], root[b])
            open_ = root[a] != root[b]
            if not open_.any():
                break
            np.minimum.at(root, np.concatenate([root[a], root[b]]), np.concatenate([low, low]))
            while (root != root[root]).any():
                root = root[root]
            a, b = a[open_], b[open_]
    joined = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[joined], nodes[root[joined]]


def links_within(nodes: DataFrame, radius: int) -> DataFrame:
    """Links u, v between fingerprints (column ``bits``, distinct) that keep every component of pairs within ``radius``."""
    quarters = [F.bit_count(F.shiftrightunsigned("bits", 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("long") for i in range(4)]
    cell = F.lit(0).cast("long")
    for quarter in quarters:
        cell = cell * 64 + quarter
    nodes = nodes.select("bits", cell.alias("cell"))
    # at most 17 ** 4 cells exist, whatever the input
    homes = nodes.groupBy("cell").agg(F.count("*").alias("n"))
    steps = F.array(*[F.lit(step).cast("long") for step in neighbour_steps(radius)])
    around = F.explode(F.transform(steps, lambda step: F.col("cell") + step)).alias("cell")
    guests = homes.select(around, "n").groupBy("cell").agg(F.sum("n").alias("guests"))
    tiles = materialize(homes.join(guests, "cell").select(
        "cell", F.ceil(F.col("n") / TILE).alias("home_tiles"), F.ceil(F.col("guests") / TILE).alias("guest_tiles")), "cells")

    deal = lambda tiles_of: F.pmod(F.xxhash64("bits"), F.col(tiles_of))
    every = lambda tiles_of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(tiles_of) - 1))
    at_home = nodes.join(F.broadcast(tiles), "cell").select("bits", "cell", deal("home_tiles").alias("a"), every("guest_tiles").alias("b"))
    visiting = nodes.select("bits", around).join(F.broadcast(tiles), "cell").select(
        "bits", "cell", every("home_tiles").alias("a"), deal("guest_tiles").alias("b"))
    sides = at_home.select("cell", "a", "b", "bits", F.lit(True).alias("home")).unionAll(
        visiting.select("cell", "a", "b", "bits", F.lit(False).alias("home")))

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def close() -> pa.RecordBatch:
            _, bits, home = (np.concatenate(part) for part in zip(*held))
            u, v = _forest(bits[home], bits[~home], radius)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            tile = np.stack(columns[:3], axis=1)
            bits, home = columns[3].view(np.uint64), columns[4].astype(bool)
            cuts = [0, *(np.flatnonzero((tile[1:] != tile[:-1]).any(axis=1)) + 1).tolist(), len(tile)]
            for start, end in zip(cuts, cuts[1:]):
                if held and (held[-1][0][0] != tile[start]).any():
                    yield close()
                    held.clear()
                held.append((tile[start:end], bits[start:end], home[start:end]))
        if held:
            yield close()

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sides.repartition(parts, "cell", "a", "b").sortWithinPartitions("cell", "a", "b")
    return dealt.mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row."""
    marked = materialize(fingerprints(docs, width), "fingerprints")
    nodes = materialize(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("size")), "fingerprint-nodes")
    roots = components(links_within(nodes, radius)).select(F.col("node").alias("bits"), "root")
    placed = nodes.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    placed = materialize(placed, "placed-fingerprints")
    firsts = placed.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("members"))
    # an unlinked node is its own component, so only roots with several members are joined
    several = materialize(firsts.filter("members > 1").drop("members"), "components")
    named = placed.join(several, "root", "left").select(
        "bits", "size", F.coalesce("component_id", "first_id").alias("component_id"))
    rows = join_counted(marked, materialize(named, "named-fingerprints"), ["bits"], "size", F.col("doc_id"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, width: int = 3, radius: int = 2) -> DataFrame:
    """The documents whose id is their component's smallest, with their own columns; rows that share a kept id all stay."""
    (kept,) = fresh(docs, "_kept_id")
    found = near_duplicates(docs, width, radius).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    found = found.select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col(kept)), "left_semi").select(*docs.columns)
