"""Token-id files: documents in ascending id order, coded by a static range asymmetric numeral system.

A file holds a run of documents: a frequency table that all its blocks share, an
index of documents, an index of blocks with checksums, and the blocks of
``rans``. Blocks and the sections between their checkpoints decode on their own.

Cases: null text counts as empty and gives only the end id; null doc_id sorts
first; rows that repeat an id stay next to each other, ordered by a hash of their
text; an empty table gives no file. Only ``doc_id`` and ``text`` are read, so other
columns, whatever their names, don't matter.
"""

import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from txnwatch.llm import rans
from txnwatch.llm.common import few_rows_at_a_time, slices_by_size
from txnwatch.llm.tokens import encoder
from txnwatch.session import materialize, scratch_path

MAGIC = b"TIDR\x01"
#: Tokens after which a task closes a file.
FILE_TOKENS = 1 << 21
MANIFEST = "part int, segment int, path string, n_docs long, n_tokens long, n_bytes long, crc32 long"


def pack_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    table = rans.Table.of(ids)
    blocks = rans.encode(ids, table) if len(ids) else []
    payloads = [b["states"].astype("<u8").tobytes() + b["starts"].astype("<u4").tobytes() + b["words"].astype("<u4").tobytes() for b in blocks]
    index, at, token = [], 0, 0
    for block, payload in zip(blocks, payloads):
        own = ids[token: token + block["n"]]
        index.append([block["n"], at, len(payload), len(block["starts"]), zlib.crc32(payload), zlib.crc32(own.astype("<u4"))])
        at, token = at + len(payload), token + block["n"]
    parts = [zlib.compress(part) for part in (
        np.diff(table.symbols.astype(np.int64), prepend=0).astype("<u4").tobytes() + table.shares.astype("<u4").tobytes(),
        np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes() + bytes(x is None for x in doc_ids) + lengths.astype("<u8").tobytes(),
    )]
    head = json.dumps({
        "n_docs": len(doc_ids), "n_tokens": len(ids), "n_symbols": len(table.symbols), "steps": rans.layout(len(ids))[1],
        "lanes": rans.LANES, "interval": rans.INTERVAL, "scale_bits": rans.SCALE_BITS,
        "parts": [[len(part), zlib.crc32(part)] for part in parts], "blocks": index,
    }).encode()
    return b"".join([MAGIC, struct.pack("<II", len(head), zlib.crc32(head)), head, *parts, *payloads])


class TokenFile:
    """A file's bytes, checked and split; blocks are decoded when asked for."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        size, crc = struct.unpack_from("<II", data, len(MAGIC))
        at = len(MAGIC) + 8
        head = self._checked(data[at: at + size], crc, "header")
        self.head, at = json.loads(head), at + size
        if (self.head["lanes"], self.head["interval"], self.head["scale_bits"]) != (rans.LANES, rans.INTERVAL, rans.SCALE_BITS):
            raise ValueError("a token file of another layout")
        parts = []
        for length, crc in self.head["parts"]:
            parts.append(zlib.decompress(self._checked(data[at: at + length], crc, "index")))
            at += length
        n, docs = self.head["n_symbols"], self.head["n_docs"]
        self.table = rans.Table(np.cumsum(np.frombuffer(parts[0], "<u4", n).astype(np.int64)), np.frombuffer(parts[0], "<u4", n, 4 * n))
        ids, missing = np.frombuffer(parts[1], "<i8", docs), np.frombuffer(parts[1], np.uint8, docs, 8 * docs)
        self.doc_ids = [None if gone else int(x) for x, gone in zip(ids, missing)]
        self.lengths = np.frombuffer(parts[1], "<u8", docs, 9 * docs).astype(np.int64)
        self.data, self.start = data, at

    @staticmethod
    def _checked(part: bytes, crc: int, what: str) -> bytes:
        if zlib.crc32(part) != crc:
            raise ValueError(f"checksum of a token file's {what} doesn't match")
        return part

    def block(self, number: int) -> dict:
        n, at, length, sections, crc, _ = self.head["blocks"][number]
        payload = self._checked(self.data[self.start + at: self.start + at + length], crc, "block")
        states = np.frombuffer(payload, "<u8", sections * rans.LANES).reshape(sections, rans.LANES)
        starts = np.frombuffer(payload, "<u4", sections, states.nbytes)
        return {"n": n, "states": states, "starts": starts, "words": np.frombuffer(payload, "<u4", -1, states.nbytes + starts.nbytes)}

    def ids(self, numbers: Iterable[int] | None = None) -> np.ndarray:
        """Ids of some blocks, or of all."""
        numbers = list(range(len(self.head["blocks"])) if numbers is None else numbers)
        if not numbers:
            return np.zeros(0, np.uint32)
        found = rans.decode([self.block(i) for i in numbers], self.head["steps"], self.table)
        for i, own in zip(numbers, found):
            self._checked(np.ascontiguousarray(own, "<u4").tobytes(), self.head["blocks"][i][5], "ids")
        return np.concatenate(found)


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files under ``root``; returns the stored list of files.

    One range shuffle orders the texts; each task then encodes its run and closes a
    file whenever it is full. A retried task writes new names; the list, stored once
    by Spark's own commit, says which files count.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, segment = encoder(tokenizer), TaskContext.get().partitionId(), 0
        files, base = _place(root)
        files.create_dir(base)
        doc_ids, lengths, pieces, tokens = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, pieces, tokens, segment
            data = pack_file(doc_ids, np.concatenate(lengths), np.concatenate(pieces))
            name = f"part-{part:06d}-{segment:05d}-{uuid.uuid4().hex}.tid"
            with files.open_output_stream(f"{base}/{name}") as file:
                file.write(data)
            row = [part, segment, f"{root}/{name}", len(doc_ids), tokens, len(data), zlib.crc32(data)]
            doc_ids, lengths, pieces, tokens, segment = [], [], [], 0, segment + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4))],
                ["part", "segment", "path", "n_docs", "n_tokens", "n_bytes", "crc32"])

        for batch in slices_by_size(batches):
            ids, ends = coder.documents(batch.column(1), end_id)
            names, at = batch.column(0).to_pylist(), 0
            while at < len(names):
                stop = min(len(names), int(np.searchsorted(ends, ends[at] + file_tokens - tokens)))
                pieces.append(ids[ends[at]: ends[stop]])
                lengths.append(np.diff(ends[at: stop + 1]))
                doc_ids += names[at:stop]
                tokens += int(ends[stop] - ends[at])
                at = stop
                if tokens >= file_tokens:
                    yield close()
        if doc_ids:
            yield close()

    tie = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = few_rows_at_a_time(ordered).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return materialize(ordered.mapInArrow(write, MANIFEST), "token-files")


def with_starts(files: DataFrame) -> DataFrame:
    """Adds to each listed file the ids of all files before it. Parts, of which there are as many as tasks, are added up first."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return files.withColumn("_own", own).join(parts, "part").withColumn("start", F.col("_before") + F.col("_own")).drop("_own", "_before")


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of listed files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    The files are dealt evenly over tasks; each is read, checked and decoded whole.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, crc, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                files_, name = _place(path)
                with files_.open_input_stream(name) as file:
                    data = file.read()
                held = TokenFile(TokenFile._checked(data, crc, "bytes"))
                ids = held.ids()
                ends = np.cumsum(held.lengths)
                cuts = list(zip(ends - held.lengths, ends))
                columns = [
                    pa.array(held.doc_ids, pa.int64()), pa.array(start + ends - held.lengths, pa.int64()), pa.array(held.lengths, pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in cuts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    spark = files.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = with_starts(files).select("path", "crc32", "start").repartition(tasks, "path")
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def token_file_folder(spark) -> str:
    return scratch_path(spark, "token-ids")
