"""Token files, packing and pieces against the libraries on whole texts."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from txnwatch.llm import packing, pieces, rans, tokenfile
from txnwatch.llm.tokens import TextEncoder, tokenizer_path

ODD = [
    "", " ", "  ", " a", "a ", None, "a   b\n\n  c \t d", "x \n\ny   z \u3000q", "it's 'tis we'll  '", "á ́b", "Ğİ ΣΑΣ σς",
    "<|endoftext|> a", "\x1c a \x1db", "a \u200bb \ufeffc", "tab\t\tx \r\n y", "٣٤ 12abc—“q”  …", " \n x", "word. Word, WORD! été", "long " * 3000,
]
SCHEMA = "doc_id long, text string, key long, n_tokens string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()
    return ODD + [r["text"] for r in rows] + ODD


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("remembered", [50, 100_000])
def test_ids_equal_whole_text_ids(texts, name, remembered):
    coder = TextEncoder(tokenizer_path(name), remembered)
    assert coder.kind != "whole"
    ids, ends = coder.encode_batch(pa.array(texts))
    for i, text in enumerate(texts):
        whole = coder.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids[ends[i]: ends[i + 1]].tolist() == whole, text
        assert np.frombuffer(coder.encode(text or ""), "<u4").tolist() == whole


ADDED = [
    "<|endoftext|> a", "a<|endoftext|>b", "a  <|endoftext|>  b", "<|startoftext|>", "<|ENDOFTEXT|> A", "x\n<|endoftext|>\n\ny", "<|startoftext|><|endoftext|>",
    "Σ <|endoftext|>", "<|endof text|>", "plain words", "<|endoftext|", " <|EndOfText|><|endoftext|> ", None, "",
]


@pytest.mark.parametrize("name, end_id", [("word_bpe_49k.json", 49407), ("byte_bpe_50k.json", 50256)])
def test_added_tokens_have_their_own_ids(name, end_id):
    from tokenizers import Tokenizer

    library, coder = Tokenizer.from_file(tokenizer_path(name)), TextEncoder(tokenizer_path(name))
    for texts in (ADDED, ADDED[:1], ADDED[9:10] * 3 + ADDED):
        ids, ends = coder.encode_batch(pa.array(texts))
        for i, text in enumerate(texts):
            whole = library.encode(text or "", add_special_tokens=False).ids
            assert ids[ends[i]: ends[i + 1]].tolist() == whole, text
            assert np.frombuffer(coder.encode(text or ""), "<u4").tolist() == whole, text
    assert coder.encode_batch(pa.array(ADDED[:1]))[0][0] == end_id


@pytest.mark.parametrize("n", [1, 255, 256, 257, 65_537, 262_145, 300_000])
def test_coder_round_trip(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_407).astype("<u4")
    held = tokenfile.TokenFile(tokenfile.pack_file([3, None], np.array([n, 0]), ids))
    assert (held.ids() == ids).all() and held.doc_ids == [3, None]
    last = len(held.head["blocks"]) - 1
    assert (held.ids([last]) == ids[-held.head["blocks"][last][0]:]).all()


def test_shares_fill_the_table():
    for counts in ([1], [5, 5], [10 ** 9, *[1] * 60_000], [1] * (1 << rans.SCALE_BITS)):
        shares = rans.scaled(np.array(counts))
        assert shares.sum() == 1 << rans.SCALE_BITS and shares.min() >= 1


def test_damage_is_found():
    data = tokenfile.pack_file([1], np.array([1000]), np.arange(1000, dtype="<u4"))
    for at in (20, len(data) // 2, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            tokenfile.TokenFile(bytes(broken)).ids()


def test_token_files_round_trip(spark, texts):
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)] + [(None, "null id"), (2, "again"), (2, "again")]
    path = tokenizer_path("word_bpe_49k.json")
    files = tokenfile.write_token_files(docs_of(spark, rows), tokenfile.token_file_folder(spark), path, 1, file_tokens=2000)
    assert files.count() > 3
    got = tokenfile.read_token_files(files, with_ids=True).orderBy("start").collect()
    coder = TextEncoder(path)
    want = {}
    for i, t in rows:
        ids = [*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want.setdefault(i, []).append(ids)
    start = 0
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0)) and len(got) == len(rows)
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"]) and r["ids"] in want[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]


def test_packing_covers_every_id_once(spark, texts):
    rows = list(enumerate(texts)) + [(None, "null id")] + [(1000 + i, "copy of one text " * 40) for i in range(200)]
    path = tokenizer_path("byte_bpe_50k.json")
    got = packing.pack(docs_of(spark, rows), path, 0, 1024, with_ids=True).toPandas()
    coder = TextEncoder(path)
    by_doc = dict(list(got.groupby("doc_id")))
    for i, t in rows:
        ids = [*coder.tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        own = (got[got.doc_id.isna()] if i is None else by_doc[i]).sort_values("start")
        assert own.start.tolist() == np.cumsum([0, *own.length])[:-1].tolist() and own.doc_tokens.eq(len(ids)).all()
        assert [x for part in own.ids for x in part] == ids
        assert own.ids_crc32.tolist() == [zlib.crc32(np.array(part, "<u4").tobytes()) for part in own.ids]
    for _, sequence in got.groupby("sequence_id"):
        own = sequence.sort_values("offset")
        assert own.offset.tolist() == np.cumsum([0, *own.length])[:-1].tolist()
        total = own.length.sum()
        assert total <= 1024 and total & total - 1 == 0  # full, or a power of two: nothing is padded


def test_hilbert_steps_to_neighbours(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 3)
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    place = packing.hilbert(grid)
    walk = grid[np.argsort(place)]
    assert sorted(place) == list(range(512)) and np.abs(np.diff(walk, axis=0)).sum(axis=1).max() == 1


def test_near_texts_lie_near_on_the_curve():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    texts = [" ".join(rng.choice(words, 200)) for _ in range(50)]
    keys = packing.curve_keys([t for text in texts for t in (text, text + " end")])
    assert np.median(np.abs(keys[::2] - keys[1::2])) < np.median(np.abs(keys[::2] - np.roll(keys[1::2], 1)))


def test_pieces_equal_the_library(spark, texts):
    path = tokenizer_path("piece_bpe_32k.model")
    rows = [*enumerate([*texts, "x▁y ▁▁ z", "▁", " ▁ ", "😀 日本語 ﬁ½", "<s> </s> <unk> <0x41>", "\x00b"]), (None, "null id")]
    coder = pieces.PieceEncoder(path)
    model = coder.model
    digests = {r["doc_id"]: r for r in pieces.piece_digests(docs_of(spark, rows), path).collect()}
    spans = {r["doc_id"]: r for r in pieces.encode_pieces(docs_of(spark, rows), path).collect()}
    for i, text in rows:
        ids = model.encode(text or "")
        assert spans[i]["ids"] == ids and spans[i]["decoded"] == (model.decode(ids) if ids else "")
        assert digests[i]["n_tokens"] == len(ids)
        assert digests[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256(spans[i]["decoded"].encode()).hexdigest()
        data = (text or "").encode()
        assert b"".join(data[a:b] for a, b in zip(spans[i]["begins"], spans[i]["ends"])) == data
        assert digests[i]["covered_bytes"] == len(data)
        flat = np.array([*zip(spans[i]["begins"], spans[i]["ends"])], "<u4")
        assert digests[i]["spans_sha256"] == hashlib.sha256(flat.tobytes()).hexdigest()


def test_spans_agree_with_the_library():
    coder = pieces.PieceEncoder(tokenizer_path("piece_bpe_32k.model"))
    text = "Hello  world été ½\n\tx  "
    (ids, begins, ends), = coder.encode_batch(pa.array([text]))
    for piece, a, b in zip(coder.model.encode(text, out_type="proto").pieces, begins, ends):
        assert piece.id == ids[0] and piece.surface == text.encode()[a:b].decode()
        ids = ids[1:]


def test_normaliser_walks_a_compiled_map():
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    ours = pieces.Normalizer(library.serialized_model_proto())
    assert len(ours.units) and not ours.identity
    for text in ["", " ", "  a  b ", "ﬁ½ Å  ｶﾞ  ①②  …", "á x", "Ǻ \u3000 x", "tail  ", "日本語 😀", "\x00b\n\nc"]:
        normal, align = ours(text)
        assert normal.decode() == library.normalize(text), text
        assert len(align) == len(normal) + 1 and (np.diff(align) >= 0).all() and (not len(align) or align[-1] <= len(text.encode()))


def _message(number, data):
    size, out = len(data), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes([*out, size]) + data


@pytest.fixture(scope="module")
def other_models(tmp_path_factory):
    """The given vocabulary with a character map and squeezed blanks; with symbols that are left alone; without byte pieces."""
    import sentencepiece

    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    mapped = model + sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto()
    named = lambda name, kind: _message(1, _message(1, name.encode()) + b"\x15\0\0\0\0\x18" + bytes([kind]))
    symbols = mapped + named("ﬁ①", pieces.USER_DEFINED) + named("[a  b]", pieces.USER_DEFINED)
    unknown = b"".join(
        _message(1, value.replace(b"\x18\x06", b"\x18\x05") if number == 1 else value) if number == 1 else _message(number, value)
        for number, value in pieces.fields(mapped)) + _message(2, b"\x98\x02\0")
    folder, paths = tmp_path_factory.mktemp("models"), {}
    for name, data in (("mapped", mapped), ("symbols", symbols), ("unknown", unknown)):
        paths[name] = str(folder / f"{name}.model")
        with open(paths[name], "wb") as file:
            file.write(data)
    return paths


MAPPED = ["ﬁ½ Å  ｶﾞ  ①②  …", "á x", "Ǻ \u3000 x", "  tail  ", "日本語 😀😀 z", "\x00b\n\nc", "ﬁ①②  [a  b] x[a  b]", "\u200b", "x▁y ▁▁ z"]


@pytest.mark.parametrize("name", ["mapped", "symbols", "unknown"])
def test_models_with_a_character_map(spark, texts, other_models, name):
    path = other_models[name]
    coder, rows = pieces.PieceEncoder(path), list(enumerate([*MAPPED, *texts]))
    assert len(coder.normalize.units) and not coder.by_word and len(coder.normalize.kept) == 2 * (name == "symbols")
    digests = {r["doc_id"]: r for r in pieces.piece_digests(docs_of(spark, rows), path).collect()}
    spans = {r["doc_id"]: r for r in pieces.encode_pieces(docs_of(spark, rows), path).collect()}
    n_unknown = 0
    for i, text in rows:
        ids = coder.model.encode(text or "")
        n_unknown += ids.count(coder.model.unk_id())
        assert spans[i]["ids"] == ids, text
        assert digests[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i]["decoded_sha256"] == hashlib.sha256((coder.model.decode(ids) if ids else "").encode()).hexdigest()
        begins, ends = spans[i]["begins"], spans[i]["ends"]
        assert begins == sorted(begins) and all(a <= b <= len((text or "").encode()) for a, b in zip(begins, ends))
        known = coder.model.encode(text or "", out_type="proto").pieces
        for piece, begin, end in zip(known, begins, ends, strict=True):
            if not coder.model.is_byte(piece.id):
                assert piece.surface.encode() == text.encode()[begin:end], text
    assert (n_unknown > 0) == (name == "unknown")


def test_empty_tables(spark):
    docs = docs_of(spark, [])
    files = tokenfile.write_token_files(docs, tokenfile.token_file_folder(spark), tokenizer_path("word_bpe_49k.json"), 1)
    assert files.count() == 0 and tokenfile.read_token_files(files).count() == 0
    assert packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), 0).count() == 0
    assert pieces.piece_digests(docs, tokenizer_path("piece_bpe_32k.model")).count() == 0
