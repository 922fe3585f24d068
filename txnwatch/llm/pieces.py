"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation walks the model's compiled character map for the longest prefix at
each place and records, for every byte it puts out, the byte of the source that it
stands for. The library merges pieces of these normalised bytes; its own normaliser is
switched off. Pieces are laid over the normalised bytes and so projected to byte spans
of the original text.

Where the map is empty and no piece of the model has a blank after its beginning,
no merge reaches over the start of a word; each distinct word of a batch is then
encoded once and the ids are put together. Any other model gets whole texts.

Cases: null and empty texts give no ids and decode to an empty text; an unknown piece
spans what it stands for; very long texts are encoded whole, with 4 bytes of alignment
for each of theirs; repeated rows are encoded each; an empty table gives no rows. Only
``doc_id`` and ``text`` are read.
"""

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from txnwatch.llm.common import map_batches

#: The character that stands for a blank in pieces; a fixed value of the format.
BLANK = "▁"
#: Kind of piece that the normaliser leaves alone; a fixed value of the format.
USER_DEFINED = 4
#: Appended to a model, these fields override its normaliser: no map (2), no prefix (3), blanks kept (4) and not escaped (5).
NO_NORMALIZER = bytes([3 << 3 | 2, 8, 2 << 3 | 2, 0, 3 << 3, 0, 4 << 3, 0, 5 << 3, 0])


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def fields(data: bytes):
    """(number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = data[at: at + size], at + size
        yield tag >> 3, value


class Normalizer:
    """The normaliser that a model carries: character map, symbols that stay as they are, dummy prefix, blanks."""

    def __init__(self, model: bytes):
        spec, self.kept = {}, []
        for number, value in fields(model):
            if number == 3:  # what comes later overrides what came before
                spec.update(fields(value))
            elif number == 1 and (piece := dict(fields(value))).get(3) == USER_DEFINED:
                self.kept.append(piece[1])
        self.kept.sort(key=len, reverse=True)
        self.prefix, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        charsmap = spec.get(2, b"")
        self.units, self.replacements = np.zeros(0, np.uint32), b""
        if charsmap:
            size = int.from_bytes(charsmap[:4], "little")
            self.units = np.frombuffer(charsmap, "<u4", size // 4, 4).tolist()
            self.replacements = charsmap[4 + size:]

    @property
    def identity(self) -> bool:
        """Whether nothing but the prefix and the blanks change."""
        return not len(self.units) and not self.kept and not self.squeeze and self.prefix and self.escape

    def longest_prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        """What the longest mapped prefix of ``data[at:]`` becomes, and its bytes; without one, the next character as it is."""
        for symbol in self.kept:
            if data.startswith(symbol, at):
                return symbol, len(symbol)
        found = None
        if len(self.units):
            node = self._offset(self.units[0])
            for place in range(at, len(data)):
                node ^= data[place]
                unit = self.units[node] if node < len(self.units) else 0
                if unit & 0x800000FF != data[place]:
                    break
                node ^= self._offset(unit)
                if unit >> 8 & 1:
                    found = (self.units[node] & 0x7FFFFFFF, place + 1 - at)
        if found:
            start, size = found
            return self.replacements[start: self.replacements.index(b"\0", start)], size
        lead = data[at]
        size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        return data[at: at + size], size

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and for the end, the byte of ``text`` it comes from."""
        data = text.encode()
        if self.identity:
            if not data:
                return b"", np.zeros(1, np.int32)
            blank = np.frombuffer(data, np.uint8) == 32
            align = np.repeat(np.arange(len(data) + 1, dtype=np.int32), np.append(1 + 2 * blank.view(np.int8), 1))
            return (b" " + data).replace(b" ", BLANK.encode()), np.concatenate([np.zeros(3, np.int32), align])
        out, align, at = bytearray(), [], 0
        steps = []
        while at < len(data):
            put, size = self.longest_prefix(data, at)
            steps.append((put, at))
            at += size
        end = len(data)
        if self.squeeze:
            while steps and steps[0][0] in (b" ", b""):
                steps.pop(0)
            while steps and steps[-1][0] in (b" ", b""):
                end = steps.pop()[1]
        blank = BLANK.encode() if self.escape else b" "
        if self.prefix and steps:
            out += blank
            align += [steps[0][1]] * len(blank)
        before_blank = self.squeeze
        for put, place in steps:
            for byte in put:
                if byte == 32:
                    if not (self.squeeze and before_blank):
                        out += blank
                        align += [place] * len(blank)
                else:
                    out.append(byte)
                    align.append(place)
                before_blank = byte == 32
        tail = blank if self.squeeze else b""
        while tail and out.endswith(tail):
            end = align[len(out) - len(tail)]
            del out[-len(tail):], align[-len(tail):]
        return bytes(out), np.array([*align, end], np.int32)


class PieceEncoder:
    """Ids, digests and spans of texts by a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = file.read()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=model + NO_NORMALIZER)
        self.normalize = Normalizer(model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.widths = np.array([1 if self.model.is_byte(i) else len(name.encode()) for i, name in enumerate(names)], np.uint16)
        inner = any(BLANK in name.lstrip(BLANK) for name in names)
        self.by_word = self.normalize.identity and not inner and any(self.model.is_byte(i) for i in range(len(names)))
        self.decimals = [str(i) for i in range(len(names))]

    def encode_batch(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of every text (null as empty), and where each begins and ends in the bytes of the text.

        Normalised texts are cut into words, told apart in Arrow, so the library
        merges each distinct word of the batch once and the rest is array work.
        """
        walked = [self.normalize(text or "") for text in texts.to_pylist()]
        normal = [text for text, _ in walked]
        found = self._by_word(normal) if self.by_word and normal else [self._whole(text) for text in normal]
        return [(ids, *self._spans(align, widths)) for (ids, widths), (_, align) in zip(found, walked)]

    def _by_word(self, normal: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        # what stands before the first blank is empty, as every normalised text begins with one
        cut = pc.split_pattern(pa.array(normal, pa.string()), BLANK)
        first = np.asarray(cut.offsets, np.int64)
        coded = pc.dictionary_encode(cut.values)
        index, words = np.array(coded.indices, np.int64), coded.dictionary.to_pylist()
        n_empty = np.add.reduceat(np.array([not word for word in words])[index], first[:-1]).tolist()
        found = self.merges.encode([word and BLANK + word for word in words], num_threads=1)
        ends = np.cumsum([0, *map(len, found)])
        ids = np.fromiter(chain.from_iterable(found), np.int64, ends[-1])
        lengths = np.diff(ends)[index]
        places = np.concatenate([[0], np.cumsum(lengths)])
        ids = ids[np.repeat(ends[index] - places[:-1], lengths) + np.arange(places[-1])]
        widths, cuts = self.widths[ids], places[first].tolist()
        # several blanks in a row, and blanks at an end, may share a piece: such texts are merged whole
        return [
            self._whole(normal[i]) if empty > 1 else (ids[cuts[i]: cuts[i + 1]], widths[cuts[i]: cuts[i + 1]])
            for i, empty in enumerate(n_empty)
        ]

    def _whole(self, normal: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a normalised text, and the bytes that each takes in it."""
        text = normal.decode()
        ids = np.array(self.merges.encode(text), np.int64)
        widths = self.widths[ids]
        if (ids == self.model.unk_id()).any():  # as long as what it stands for
            known = self.merges.encode(text, out_type="proto").pieces
            widths = np.array([len(piece.surface.encode()) for piece in known], np.int64)
        return ids, widths

    @staticmethod
    def _spans(align: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte and byte after the last, in the original text, of each piece."""
        ends = np.cumsum(widths, dtype=np.int64)
        if (ends[-1] if len(ends) else 0) != len(align) - 1:
            raise ValueError("pieces do not cover the normalised text")
        return align[ends - widths], align[ends]

    def decimal(self, ids: list[int]) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.decimals.__getitem__, ids))


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """Documents with ids, byte spans of the pieces and the decoded text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = piece_encoder(model)
        found = encoder.encode_batch(batch.column(1))
        ints = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays([
            batch.column(0), *(pa.array([row[i].astype(np.int32) for row in found], ints) for i in range(3)),
            pa.array([encoder.model.decode(row[0].tolist()) if len(row[0]) else "" for row in found], pa.string()),
        ], ["doc_id", "ids", "begins", "ends", "decoded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string", by_size=True)


def piece_digests(docs: DataFrame, model: str) -> DataFrame:
    """The same work, with digests in place of the long columns.

    ``spans_sha256`` is of the first byte and the byte after the last of every piece, in turn, as little-endian
    unsigned 32-bit integers; ``covered_bytes`` adds the spans up, which together are the whole text unless the
    normaliser drops some of it.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = piece_encoder(model)
        rows = []
        for ids, begins, ends in encoder.encode_batch(batch.column(1)):
            spans = np.stack([begins, ends], axis=1).astype("<u4").tobytes()
            ids = ids.tolist()
            decoded = encoder.model.decode(ids) if ids else ""
            texts = (encoder.decimal(ids).encode(), decoded.encode(), spans)
            rows.append((len(ids), *(hashlib.sha256(text).hexdigest() for text in texts), int((ends - begins).sum())))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
        columns = zip(*rows) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(column, kind) for column, kind in zip(columns, kinds))],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256", "covered_bytes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string, covered_bytes long", by_size=True)
