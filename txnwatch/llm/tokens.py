"""Token ids of whole texts by a published tokenizer, one library call per distinct chunk.

A text is cut only where the tokenizer's own pre-tokenizer always cuts, so the ids
of the chunks, put together, are the ids of the text. A worker remembers chunks it
has seen; what it remembers is bounded and only saves time.
"""

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most chunks that a worker remembers at a time.
REMEMBERED = 300_000
#: A blank before a character that no engine takes for white space always begins a new pre-token.
_BLANK_BEFORE_WORD = re.compile(" (?=[^\\s\\u180e\\u200b\\ufeff])")
#: Letters that neither normal forms nor neighbours change, and punctuation that begins no contraction.
_LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&|]+)?")
_ODD_START = re.compile("[\\s\\u180e\\u200b\\ufeff]")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Memory(dict):
    """Chunk -> its ids as little-endian 32-bit bytes."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit = encode, limit

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) >= self.limit:
            self.clear()
        found = self[chunk] = self.encode(chunk)
        return found


class TextEncoder:
    """Encode texts to bytes of little-endian unsigned 32-bit ids.

    ``path`` is a file of the tokenizers library. Two kinds are known by their
    settings: those that drop white space (chunks are what stands between blanks
    and line ends) and byte-level ones (chunks begin at a blank before a word).
    Any other tokenizer gets whole texts.

    A chunk of Latin letters, alone or before punctuation, is one or two
    pre-tokens, so it goes straight to the library's model; every other chunk goes
    through the whole tokenizer. A text with an added token (``<|endoftext|>``) is
    never cut, as the library finds those before all else.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        settings = _settings(path)
        added = [token["content"] for token in settings.get("added_tokens") or []]
        plain = not any(token.get("normalized") or re.search(r"\s", token["content"]) for token in settings.get("added_tokens") or [])
        self.kind = "whole" if not plain else "words" if _drops_white_space(settings) else "bytes" if _is_byte_level(settings) else "whole"
        # in any case of letters, so that lower-casing makes no added token that the text doesn't hold
        self.has_added = re.compile("|".join(map(re.escape, added)) or r"[^\s\S]", re.I).search
        # a character of every added token, whatever the case of its letters; looked for first, as that is quick
        self.mark = next((char for char in "".join(added[:1]) if not char.isalpha() and all(char in content for content in added)), "")
        self.lower = self.kind == "words"
        self.as_bytes = str.maketrans(_byte_names())
        self.plain = _Memory(self._ids, remembered)
        self.after_blank = _Memory(self._ids_after_blank, remembered)

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        return _packed([token.id for token in self.model.tokenize(word if word.isascii() and word.isalpha() else word.translate(self.as_bytes))])

    def _ids(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        simple = _LETTERS.fullmatch(chunk) if self.kind != "whole" else None
        if not simple:
            return self._whole(chunk)
        letters, tail = simple.groups()
        if tail:
            return self.plain[letters] + self.plain[tail]
        return self._letters(letters.lower() if self.lower else letters)

    def _ids_after_blank(self, word: str) -> bytes | None:
        """None marks a chunk at which a blank is no safe place to cut."""
        if not word or _ODD_START.match(word):
            return None
        simple = _LETTERS.fullmatch(word)
        if not simple:
            return self._whole(" " + word)
        letters, tail = simple.groups()
        return self.after_blank[letters] + self.plain[tail] if tail else self._letters(" " + letters)

    def encode(self, text: str) -> bytes:
        if self.mark in text and self.has_added(text):
            return self._whole(text)
        if self.kind == "words":
            # the tokenizer lower-cases letter by letter, Python looks around a sigma
            text = text if "Σ" in text else text.lower()
            return b"".join(map(self.plain.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind == "whole":
            return self._whole(text)
        first, *rest = text.split(" ")
        try:
            return self.plain[first] + b"".join(map(self.after_blank.__getitem__, rest))
        except TypeError:
            first, *rest = _BLANK_BEFORE_WORD.split(text)
            return self.plain[first] + b"".join(map(self.after_blank.__getitem__, rest))


    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's ids begin and end.

        Words are cut and told apart in Arrow, so each distinct word of the batch is
        looked up once and the rest is array work. Null counts as empty.
        """
        texts = pc.fill_null(texts, "")
        if self.kind == "whole" or not len(texts):
            return _joined([self.encode(text) for text in texts.to_pylist()])
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " ") if self.kind == "words" else texts, " ")
        first = np.asarray(cut.offsets, np.int64)
        coded = pc.dictionary_encode(cut.values)
        index = np.array(coded.indices, np.int64)
        words = coded.dictionary.to_pylist()
        added = np.array([self.mark in word and self.has_added(word) is not None for word in words])
        with_added = np.flatnonzero(np.add.reduceat(added[index], first[:-1])).tolist() if added.any() else []
        if self.kind == "words":
            found, odd = list(map(self.plain.__getitem__, words)), set()
        else:
            found = list(map(self.after_blank.__getitem__, words))
            unsafe = np.array([ids is None for ids in found])[index]
            unsafe[first[:-1]] = False
            odd = set(np.flatnonzero(np.add.reduceat(unsafe, first[:-1])).tolist())
            own = [self.plain[words[i]] for i in index[first[:-1]].tolist()]
            index[first[:-1]] = len(found) + np.arange(len(own))
            found = [ids or b"" for ids in found] + own
        odd = sorted(odd.union(with_added))
        if odd:  # added tokens, blanks in a row, or before other white space: such texts are cut with more care
            pieces = {i: self.encode(texts[i].as_py()) for i in odd}
            for i in odd:
                index[first[i]: first[i + 1]] = len(found)
                found.append(b"")
            for i, ids in pieces.items():
                index[first[i]] = len(found)
                found.append(ids)
        ids, starts = _joined(found)
        lengths = np.diff(starts)[index]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids[np.repeat(starts[index] - ends[:-1], lengths) + np.arange(ends[-1])], ends[first]

    def documents(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_batch``, with ``end_id`` after each text."""
        ids, ends = self.encode_batch(texts)
        return np.insert(ids, ends[1:], end_id).astype("<u4", copy=False), ends + np.arange(len(ends))


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return np.frombuffer(b"".join(parts), "<u4"), ends


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_names() -> dict[str, str]:
    """How byte-level models spell the blank and the letters of ``_LETTERS``, as the library spells them."""
    from tokenizers import pre_tokenizers

    spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = [chr(code) for code in range(256) if _LETTERS.fullmatch(chr(code))]
    return {char: spell.pre_tokenize_str(char)[0][0] for char in [" ", *letters]}


def _settings(path: str) -> dict:
    import json

    with open(path, encoding="utf-8") as file:
        return {key: value for key, value in json.load(file).items() if key != "model"}


def _drops_white_space(settings: dict) -> bool:
    parts = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return parts[0].get("type") == "Split" and parts[0].get("behavior") == "Removed" and parts[0].get("invert") is True


def _is_byte_level(settings: dict) -> bool:
    own = settings.get("pre_tokenizer") or {}
    return not settings.get("normalizer") and own.get("type") == "ByteLevel" and own.get("use_regex") is True and not own.get("add_prefix_space")


_encoders: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> TextEncoder:
    """The encoder of this Python worker, made once."""
    if (path, remembered) not in _encoders:
        _encoders[path, remembered] = TextEncoder(path, remembered)
    return _encoders[path, remembered]


def crc32_of_ids(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
