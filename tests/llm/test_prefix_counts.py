"""Token counts of every prefix, against the library given each prefix by itself."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnwatch.llm import prefixcounts
from txnwatch.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = [*"  \n\t'ravelsdt.,!12éß中文🙂　\xa0​\x0b\x1c\x85﻿\0-=ABab", "'re", "'ve", " the", "international", "<|endoftext|>", "<|endof",
         "  \n", "    ", "-----------", "\r\n", "'ll", "Straße ", "été, "]


def plain(text):
    return [len(LIBRARY.encode(text[:end], add_special_tokens=False).ids) for end in range(1, len(text) + 1)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12) | st.lists(st.text(max_size=8), max_size=4))
def test_every_prefix_counts_as_the_library_has_it(parts):
    text = "".join(parts)
    counter = prefixcounts.counter(PATH)
    assert np.cumsum(counter.deltas(text)).tolist() == plain(text)
    (row,) = counter.table(pa.array([1]), pa.array([text])).to_pylist()
    assert prefixcounts.counts_of(row["deltas"], row["width"])[1:].tolist() == plain(text)
    assert (row["n_bytes"], row["n_chars"], row["n_tokens"]) == (len(text.encode()), len(text), (plain(text) or [0])[-1])


def test_nothing_depends_on_what_is_remembered(monkeypatch):
    monkeypatch.setattr(prefixcounts, "SEGMENTS", 3)
    monkeypatch.setattr(prefixcounts, "PAIRS", 2)
    counter, rng = prefixcounts.PrefixCounter(PATH), random.Random(4)
    for _ in range(30):
        texts = ["".join(rng.choices(PARTS, k=rng.randrange(15))) for _ in range(4)]
        for text, row in zip(texts, counter.table(pa.array(range(4)), pa.array(texts)).to_pylist()):
            assert prefixcounts.counts_of(row["deltas"], row["width"])[1:].tolist() == plain(text)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "z", 0) for i, t in rows], "doc_id long, text string, n_tokens long, deltas string, width int")


def test_questions_are_answered_from_the_table(spark):
    texts = [(1, "the quick brown fox's tail\n\n and more  of it, été"), (1, "the quick"), (2, None), (3, ""), (None, "a <|endoftext|> b"), (4, "ab" * 400)]
    table = prefixcounts.prefix_counts(docs(spark, texts), PATH)
    for budget in (0, 1, 7, 1000):
        got = prefixcounts.longest_prefixes(table, budget).collect()
        for (doc_id, text), row in zip(texts, got):
            counts = [0, *plain(text or "")]
            longest = max(end for end, count in enumerate(counts) if count <= budget)
            assert (row["doc_id"], row["cut_chars"], row["cut_tokens"], row["n_tokens"]) == (doc_id, longest, counts[longest], counts[-1])
    asked = prefixcounts.prefix_tokens(table, F.lit(5)).collect()
    assert [row["n_tokens"] for row in asked] == [[0, *plain(text or "")][min(5, len(text or ""))] for _, text in texts]
    assert prefixcounts.prefix_counts(docs(spark, texts).limit(0), PATH).count() == 0


def test_very_long_texts(spark):
    texts = [(1, "word and another " * 40_000), (2, "x" * 300_000), (3, " " * 100_000)]
    got = {row["doc_id"]: row for row in prefixcounts.longest_prefixes(prefixcounts.prefix_counts(docs(spark, texts), PATH), 512).collect()}
    for doc_id, text in texts:
        assert got[doc_id]["n_tokens"] == len(LIBRARY.encode(text, add_special_tokens=False).ids)
        cut = got[doc_id]["cut_chars"]
        assert len(LIBRARY.encode(text[:cut], add_special_tokens=False).ids) <= 512 < len(LIBRARY.encode(text[:cut + 1], add_special_tokens=False).ids)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="no byte-level tokenizer"):
        prefixcounts.PrefixCounter(tokenizer_path("word_bpe_49k.json"))


def test_the_query_counts_whole_texts(spark):
    from txnwatch.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    texts = {row["doc_id"]: row["text"] or "" for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op11_token_counts(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        n = len(LIBRARY.encode(texts[row["doc_id"]], add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(texts[row["doc_id"]].encode()), n, n > 512)
