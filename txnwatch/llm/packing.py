"""Packing along a space-filling curve.

A document's vector counts its byte triples, hashed; a fixed projection takes it to
few dimensions, whose Hilbert index is the sort key. Ranges of the key go to tasks;
each task lays its documents end to end along the curve and cuts the run every
``length`` tokens, so neighbours on the curve share sequences and nothing is padded
but the task's last sequence, which is cut at powers of two.

Cases: null and empty texts are packed as their end id alone; null ids keep their
rows; copies, which share a key, are ordered by id and may be cut anywhere, so a
large group is spread over tasks; an empty table gives no rows. Only ``doc_id`` and
``text`` are read.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from txnwatch.llm.common import map_batches, slices_by_size, texts_of
from txnwatch.llm.tokens import crc32_of_ids, encoder

BUCKETS, DIMENSIONS, BITS = 1024, 3, 10
#: Bytes of a text that are hashed at a time.
STRETCH = 1 << 20


def projection(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))


def hashed_vector(text: str) -> np.ndarray:
    """Counts of hashed byte triples, at unit length; zero for texts under three bytes."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.zeros(BUCKETS)
    for start in range(0, max(0, len(data) - 2), STRETCH):
        part = data[start: start + STRETCH + 2].astype(np.uint16)
        mixed = part[:-2] * np.uint16(0x9E37) + part[1:-1] * np.uint16(0x85EB) + part[2:] * np.uint16(0xC2B3)
        counts += np.bincount(mixed >> np.uint16(6), minlength=BUCKETS)
    length = np.sqrt(counts @ counts)
    return counts / length if length else counts


def cells(points: np.ndarray) -> np.ndarray:
    """Grid cells of projected points: the real line is bent to the grid, so no bounds are needed."""
    return np.clip(((1 + np.tanh(points)) * (1 << BITS - 1)).astype(np.int64), 0, (1 << BITS) - 1)


def hilbert(cells_: np.ndarray) -> np.ndarray:
    """Place of grid cells (rows of ``DIMENSIONS`` coordinates) on the Hilbert curve.

    The coordinates are turned, from the highest bit down, so that each sub-cube is
    entered where its predecessor is left; their bits, taken in turn, are then a
    Gray code of the place.
    """
    axes = [cells_[:, d].copy() for d in range(cells_.shape[1])]
    for bit in range(BITS - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for axis in range(len(axes)):
            up = (axes[axis] & high) != 0
            swap = np.where(up, 0, (axes[0] ^ axes[axis]) & low)
            axes[0] = np.where(up, axes[0] ^ low, axes[0] ^ swap)
            if axis:
                axes[axis] ^= swap
    place = np.zeros(len(cells_), np.int64)
    parity = np.zeros(len(cells_), np.int64)
    for bit in range(BITS - 1, -1, -1):
        for axis in axes:
            parity ^= axis >> bit & 1
            place = place << 1 | parity
    return place


def curve_keys(texts: list[str]) -> np.ndarray:
    vectors = np.stack([hashed_vector(text) for text in texts]) if texts else np.zeros((0, BUCKETS))
    return hilbert(cells(vectors @ projection()))


class Packer:
    """Lay documents end to end and cut them into sequences; rows of a sequence are handed out once it is closed."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.sequence = length, first_sequence
        self.open, self.filled = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            size = min(self.length - self.filled, len(ids) - start)
            self.open.append((doc_id, start, ids[start: start + size], len(ids)))
            self.filled, start = self.filled + size, start + size
            if self.filled == self.length:
                yield from self._close(self.length)

    def finish(self) -> Iterator[tuple]:
        """What is left, cut into sequences whose lengths are powers of two and so need no padding."""
        while self.filled:
            yield from self._close(1 << self.filled.bit_length() - 1)

    def _close(self, size: int) -> Iterator[tuple]:
        at, rest = 0, []
        for doc_id, start, ids, total in self.open:
            own = min(len(ids), max(0, size - at))
            if own:
                yield doc_id, start, own, crc32_of_ids(ids[:own]), total, self.sequence, at, ids[:own]
                at += own
            if own < len(ids):
                rest.append((doc_id, start + own, ids[own:], total))
        self.open, self.filled, self.sequence = rest, self.filled - size, self.sequence + 1


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: where each begins in its document and where it lies in which sequence."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = pa.array(curve_keys(texts_of(batch)), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), keys], ["doc_id", "text", "key"])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        names = [part.split()[0] for part in PIECES.split(", ")]

        def table(pieces: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(column, pa.int64()) for column in list(zip(*pieces))[:7]]
            if not with_ids:
                return pa.RecordBatch.from_arrays(columns, names)
            ids = pa.array([piece[7].astype(np.int32) for piece in pieces], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([*columns, ids], [*names, "ids"])

        for batch in slices_by_size(batches):
            ids, ends = coder.documents(batch.column(1), end_id)
            runs = zip(batch.column(0).to_pylist(), ends.tolist(), ends[1:].tolist())
            pieces = [piece for doc_id, start, end in runs for piece in packer.add(doc_id, ids[start:end])]
            if pieces:
                yield table(pieces)
        if pieces := list(packer.finish()):
            yield table(pieces)

    along = map_batches(rows, keyed, "doc_id long, text string, key long", rows=64)
    along = along.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id")
    return along.drop("key").mapInArrow(cut, PIECES + ", ids array<int>" * with_ids)
