"""Exact token counts of every prefix of a text, by dynamic programming over prefixes.

For byte-level pair encodings the last token of a prefix is found from shorter
prefixes alone: it is the one vocabulary entry that ends there and that, put after
the last token of what stands before it, the merges leave as it is. So

    count[i] = count[i - len(last[i])] + 1

and one walk over a text counts each of its prefixes as the library would count it,
had it been given that prefix alone. What is kept of a text is the difference of each
prefix's count from the one before, a byte a character; questions on it (does a text
fit, how long may it be, what does a prefix cost) are answered from that table and
encode nothing again.

Texts are walked a segment at a time: white space and what follows it up to the next
white space. A prefix ends its text, and white space that ends a text is one unit for
the tokenizer's own pattern, while inside it would be divided; a segment starts where
white space does, so counts within it depend on nothing outside. A worker remembers
the differences of the segments it has seen, which is bounded and only saves time.

Cases: null text counts as empty and has no prefixes; ids may be null or repeat, each
row is counted for itself; an empty table gives no rows; memory goes with the longest
text of a task (a text of any length is one row, its segments of any length are walked
whole). Only ``doc_id`` and ``text`` are read. An added token of the tokenizer's file is
one token where it stands whole, and ordinary characters in prefixes that end inside it.
"""

import json
import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from txnwatch.llm.common import map_batches

#: Most segments that a worker takes from batch to batch, most pairs of tokens that it remembers, and the longest segment that it does.
SEGMENTS, PAIRS, LONG = 400_000, 1_000_000, 64
#: What separates segments while Arrow cuts texts; texts that hold it are cut in Python.
_CUT = "\0"
#: White space that every engine takes for white space, and characters that only some do.
_PLAIN = " \t\r\n"
_DOUBTFUL = "\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿"
_BOUNDARY = re.compile(f"(?<=[^{_PLAIN}{_DOUBTFUL}])(?=[{_PLAIN}])")
#: Units of the pattern whose own prefixes are other units.
_CONTRACTIONS = ("'re", "'ve", "'ll")
#: Most segments: one unit of Latin letters, alone or before punctuation that is one unit and begins no contraction.
_SIMPLE = re.compile("(?P<lead>[ \\n]?)(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<tail>[.,;:!?*#$%&|]*)")

TABLE = "doc_id long, n_bytes long, n_chars long, n_tokens long, width int, deltas binary"


class PrefixCounter:
    """Counts for one tokenizer file of the tokenizers library: byte-level BPE with the usual pattern, nothing normalised."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        before = settings.get("pre_tokenizer") or {}
        added = settings.get("added_tokens") or []
        odd = [t["content"] for t in added if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]]
        if settings.get("normalizer") or before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space") or odd:
            raise ValueError(f"{path} is no byte-level tokenizer whose prefixes can be counted")
        tokenizer = Tokenizer.from_file(path)
        self.units, self.model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model
        self.vocabulary = frozenset(settings["model"]["vocab"])
        self.tails = frozenset(token[i:] for token in self.vocabulary for i in range(len(token)))
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = "|".join(map(re.escape, contents)) or r"[^\s\S]"
        self.seldom = f"[{_CUT}{_DOUBTFUL}]" + ("|" + "|".join(re.escape(c) for c in contents) if contents else "")
        self.names: dict[str, str] = {}
        self.letters = {code: self._spelled(chr(code)) for code in range(256) if _SIMPLE.fullmatch(chr(code))}
        self.spaces: dict[str, bool] = {char: True for char in _PLAIN}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.segments: dict[str, bytes | None] = {}
        self.walked: tuple[str, list[int], list[str]] = "", [0], [""]

    def _stay(self, left: str, right: str) -> bool:
        """Whether the merges leave these two tokens, side by side, as they are."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        tokens = self.model.tokenize(left + right)
        found = self.pairs[left, right] = len(tokens) == 2 and tokens[0].value == left
        return found

    def _walk(self, unit: str) -> list[int]:
        """Counts of all prefixes of one unit, in the spelling of bytes. What it shares with the unit before is walked once."""
        before, counts, last = self.walked
        shared = 0
        for mine, other in zip(unit, before):
            if mine != other:
                break
            shared += 1
        counts, last = counts[:shared + 1], last[:shared + 1]
        tails, vocabulary, pairs = self.tails, self.vocabulary, self.pairs
        for end in range(shared + 1, len(unit) + 1):
            fitting, start = [], end - 1
            while start >= 0 and (token := unit[start:end]) in tails:
                if token in vocabulary:
                    fitting.append((start, token))
                start -= 1
            while fitting:  # one fits; the longest is tried first, as it is the likeliest
                start, token = fitting.pop()
                if not start or not fitting:
                    break
                stay = pairs.get((last[start], token))
                if stay or stay is None and self._stay(last[start], token):
                    break
            counts.append(counts[start] + 1)
            last.append(token)
        if len(unit) <= LONG:
            self.walked = unit, counts, last
        return counts[1:]

    def _word(self, letters: str, blank: bool) -> bytes:
        """Differences of the counts of a word of Latin letters, a blank before it or not; such a word is one unit."""
        spelled = letters if letters.isascii() else letters.translate(self.letters)
        counts = self._walk("\u0120" + spelled if blank else spelled)
        if len(spelled) > len(letters):  # letters of two bytes count where they end
            ends = list(accumulate([blank + 0, *[1 + (char > "\x7f") for char in letters]]))
            counts = [counts[end - 1] for end in ends if end]
        return bytes([(after - before) & 255 for before, after in zip([0, *counts], counts)])

    def _is_space(self, char: str) -> bool:
        """As the library has it: neither a letter, nor a number, nor other."""
        if char not in self.spaces:
            self.spaces[char] = bool(re.match(f"[{_DOUBTFUL}]", char)) and all(len(self.units(kind + char)) > 1 for kind in "a1!")
        return self.spaces[char]

    def _spelled(self, char: str) -> str:
        if char not in self.names:
            self.names[char] = self.units(char)[0][0]
        return self.names[char]

    def _counts(self, text: str) -> np.ndarray:
        """Counts of all prefixes, by characters, of a segment (or of any text without added tokens)."""
        lengths = np.array([len(char.encode()) for char in text], np.int64)
        counts, before = [], 0
        for unit, _ in self.units(text):
            own = self._walk(unit)
            if unit in _CONTRACTIONS:
                own[1] = len(self._walk("'")) + 1
            counts += [before + count for count in own]
            before += own[-1]
        counts = np.array(counts, np.int64)[np.cumsum(lengths) - 1]
        start = 0
        while start < len(text):  # white space that ends a prefix is one unit
            end = start
            while end < len(text) and self._is_space(text[end]):
                end += 1
            if end > start:
                own = np.array(self._walk("".join(map(self._spelled, text[start:end]))))
                counts[start:end] = (counts[start - 1] if start else 0) + own[np.cumsum(lengths[start:end]) - 1]
            start = end + 1
        return counts

    def _segment(self, segment: str) -> bytes | None:
        """Differences of the counts, a byte each; none if one doesn't fit in a byte."""
        if segment in self.segments:
            return self.segments[segment]
        simple = _SIMPLE.fullmatch(segment) if len(segment) <= LONG else None
        if simple and not simple["tail"]:
            found = b"\x01" * (simple["lead"] == "\n") + self._word(simple["word"], simple["lead"] == " ")
        elif simple:
            found = self._segment(simple["lead"] + simple["word"]) + self._segment(simple["tail"])
        else:
            deltas = np.diff(self._counts(segment), prepend=0)
            found = deltas.astype(np.int8).tobytes() if deltas.size == 0 or np.abs(deltas).max() < 128 else None
        if len(segment) <= LONG:
            self.segments[segment] = found
        return found

    def deltas(self, text: str) -> np.ndarray:
        """Difference of every prefix's count from the one before, of any text."""
        parts, start = [], 0
        for mark in [*re.finditer(self.added, text), None]:
            # what ends inside an added token is ordinary text
            plain = text[start: mark.end() - 1 if mark else len(text)]
            for segment in _BOUNDARY.split(plain) if plain else []:
                own = self._segment(segment)
                parts.append(np.frombuffer(own, np.int8).astype(np.int64) if own is not None else np.diff(self._counts(segment), prepend=0))
            if mark:
                here = np.concatenate([np.empty(0, np.int64), *parts])
                ahead = len(mark[0]) - 1
                parts = [here, [1 - here[len(here) - ahead:].sum()]]
                start = mark.end()
        return np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64)

    def table(self, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """Rows of ``TABLE``. Segments are cut and told apart in Arrow, so each distinct one of the batch is looked up once."""
        if len(self.segments) > SEGMENTS:
            self.segments.clear()
        texts = pc.fill_null(texts, "")
        seldom = np.asarray(pc.match_substring_regex(texts, self.seldom))
        marked = pc.replace_substring_regex(texts, f"([^{_PLAIN}])([{_PLAIN}])", f"\\1{_CUT}\\2")
        cut = pc.split_pattern(pc.if_else(pa.array(seldom), "", marked), _CUT)
        first = np.asarray(cut.offsets, np.int64)
        coded = pc.dictionary_encode(cut.values)
        segments = coded.dictionary.to_pylist()
        for segment in sorted(set(segments).difference(self.segments)):  # neighbours share what is walked
            self._segment(segment)
        found = list(map(self._segment, segments))
        index = np.asarray(coded.indices, np.int64)
        wide = np.array([own is None for own in found], bool)[index]
        seldom |= np.add.reduceat(wide, first[:-1]) > 0 if len(texts) else False
        counts = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(own or b"" for own in found), np.int8), dtype=np.int64)])
        totals = np.diff(counts[np.cumsum([0, *(len(own or b"") for own in found)])])[index]
        n_tokens = np.diff(np.concatenate([[0], np.cumsum(totals)])[first])
        width = np.ones(len(texts), np.int32)
        taken = pa.array([own or b"" for own in found], pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset: taken.offset + len(taken) + 1]
        deltas = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends[first].tobytes()), taken.buffers()[2]]) if len(texts) else taken
        if seldom.any():
            rows = deltas.to_pylist()
            for i in np.flatnonzero(seldom).tolist():
                own = self.deltas(texts[i].as_py())
                n_tokens[i] = own.sum()
                width[i] = 1 if not own.size or np.abs(own).max() < 128 else 4
                rows[i] = own.astype("i1" if width[i] == 1 else "<i4").tobytes()
            deltas = pa.array(rows, pa.large_binary())
        columns = [ids, pc.cast(pc.binary_length(texts), pa.int64()), pc.cast(pc.utf8_length(texts), pa.int64()), pa.array(n_tokens), pa.array(width), deltas.cast(pa.binary())]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in TABLE.split(", ")])


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of this Python worker, made once."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per document its size and the differences of its prefixes' counts (``TABLE``): the table that questions are asked of, to be stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, lambda batch: counter(path).table(batch.column(0), batch.column(1)), TABLE, by_size=True)


def counts_of(deltas: bytes, width: int) -> np.ndarray:
    """Tokens of the prefixes of 0, 1, 2 ... characters."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(deltas, "i1" if width == 1 else "<i4"), dtype=np.int64)])


def longest_prefixes(table: DataFrame, budget: int) -> DataFrame:
    """``table`` without its differences, with cut_chars and cut_tokens: the longest prefix of at most ``budget`` tokens, and its tokens."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cuts, costs = [], []
        for own, width in zip(batch.column("deltas").to_pylist(), batch.column("width").to_pylist()):
            counts = counts_of(own, width)
            fits = np.flatnonzero(counts <= budget)
            cuts.append(int(fits[-1]) if fits.size else 0)
            costs.append(int(counts[cuts[-1]]))
        names = [name for name in batch.schema.names if name not in ("deltas", "width")]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in names], pa.array(cuts, pa.int64()), pa.array(costs, pa.int64())], [*names, "cut_chars", "cut_tokens"])

    return map_batches(table, run, "doc_id long, n_bytes long, n_chars long, n_tokens long, cut_chars long, cut_tokens long")


def prefix_tokens(table: DataFrame, n_chars: Column) -> DataFrame:
    """doc_id, n_chars and n_tokens: what the first ``n_chars`` characters of each text cost, or the whole text if it is shorter."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        asked, costs = [], []
        for own, width, n in zip(batch.column("deltas").to_pylist(), batch.column("width").to_pylist(), batch.column("n_chars").to_pylist()):
            counts = counts_of(own, width)
            asked.append(min(max(n or 0, 0), len(counts) - 1))
            costs.append(int(counts[asked[-1]]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(asked, pa.int64()), pa.array(costs, pa.int64())], ["doc_id", "n_chars", "n_tokens"])

    return map_batches(table.select("doc_id", n_chars.cast("long").alias("n_chars"), "width", "deltas"), run, "doc_id long, n_chars long, n_tokens long")
