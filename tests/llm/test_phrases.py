"""Phrases mined by relations, against counting them plainly."""

import random
import re
from collections import Counter

import pytest

from txnwatch.llm import setm

LONGEST = 5


def rows(spark, texts):
    return spark.createDataFrame([(i, t, lang, 9, "x", 1.5) for i, (t, lang) in enumerate(texts)],
                                 "doc_id long, text string, lang string, n long, phrase string, block double")


def plain(texts, min_count, first):
    counts, totals = Counter(), Counter()
    for text, lang in texts:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for m in range(1, LONGEST + 1):
                counts.update((lang, tuple(words[i: i + m])) for i in range(len(words) - m + 1))
    frequent = {key: a for key, a in counts.items() if a >= min_count}
    inside = Counter()
    for (lang, phrase), a in frequent.items():
        for m in range(2, len(phrase)):
            for i in range(len(phrase) - m + 1):
                inside[lang, phrase[i: i + m]] = max(inside[lang, phrase[i: i + m]], a)
    found = {}
    for (lang, phrase), a in frequent.items():
        if len(phrase) > 1 and inside[lang, phrase] < a:
            cuts = [(1000 * a * totals[lang] // (frequent[lang, phrase[:k]] * frequent[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((" ".join(phrase), a, frequent[lang, phrase[:k]], frequent[lang, phrase[k:]], totals[lang], score))
    want = []
    for lang, own in found.items():
        own.sort(key=lambda row: (-row[5], -row[1], row[0].encode()))
        want += [(lang, rank, *row) for rank, row in enumerate(own[:first], 1)]
    return sorted(want, key=str)


def made(seed, n=60):
    rng = random.Random(seed)
    words = ["a", "the", "B", "é", "É", "new", "york", "x.y", "\x0bq", "'s", "the", "new", "york", " w"]
    return [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", " "]) for _ in range(rng.randrange(120))), rng.choice(["en", "de", None, "und", ""])) for _ in range(n)]


@pytest.mark.parametrize("small, seed", [(setm.SMALL, 1), (0, 2)])
def test_phrases_equal_plain_counting(spark, monkeypatch, small, seed):
    texts = [*made(seed), (None, "en"), ("", "en"), ("same words here " * 40, "fr"), ("same words here " * 40, "fr"), (" ! \t", None)]
    for name, value in (("STRETCH", 16), ("BLOCK", 4)) if seed == 2 else ():
        monkeypatch.setattr(setm, name, value)  # texts over many rows and blocks
    got = setm.collocations(rows(spark, texts).repartition(3), 6, LONGEST, 25, small)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain(texts, 6, 25)
    assert sorted(map(tuple, got.collect()), key=str) == want and len({row[0] for row in want}) >= 4


def test_counts_in_ranges_and_ranks_in_parts(spark, monkeypatch):
    """Tasks hand on a row a range, however many groups it holds, and a language is ranked from the first of its parts."""
    texts = made(3, 200)
    for name, value in (("COUNTED", 200), ("COUNTED_BYTES", 1000), ("RANGE", 64), ("RANKED", 3)):
        monkeypatch.setattr(setm, name, value)  # many counts of a task, sums on the way
    found = setm.collocations(rows(spark, texts).repartition(5), 4, LONGEST, 7)
    assert sorted(map(tuple, found.collect()), key=str) == plain(texts, 4, 7)


def test_groups_that_occur_often_are_counted_in_arrays(spark):
    relation = spark.createDataFrame([(0, 4, setm.np.array(words, "<i4").tobytes(), None) for words in ([0, 1, 0, 1], [1, 0, 1, -1], [2, 2, 2, 2])] * 3, setm.RELATION)
    counts = setm.phrase_counts(relation.repartition(2), 2, 3, 3, ("<i4", "<i4"), 6, 4)
    assert sorted(map(tuple, counts.collect())) == [(1, 9), (3, 6), (8, 9)]
    assert counts._jdf.queryExecution().executedPlan().toString().count("HashAggregate") == 0


def test_a_long_text_without_an_end_is_many_rows(spark):
    texts = [(" ".join(f"w{i % 7}" for i in range(20_000)), "en"), ("word" * 300_000, "en")]
    docs = rows(spark, texts)
    cut = setm.stretches(docs, LONGEST)
    assert cut.filter("own > 512").isEmpty() and cut.count() == 41
    assert sorted(map(tuple, setm.collocations(docs).collect()), key=str) == plain(texts, 100, 2000)


def test_products_that_pass_64_bits(spark):
    cut = spark.sql("SELECT 4000000000000 a, 9000000000000000 n, 5000000000000 l, 6000000000000 r")
    text = "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(17,0)) * cast(r as decimal(17,0)))"
    assert cut.selectExpr(f"{text} s").first()["s"] == 1000 * 4 * 10**12 * 9 * 10**15 // (5 * 6 * 10**24)


def test_empty_and_nothing_frequent(spark):
    assert setm.collocations(rows(spark, [("a b", "en")]).limit(0)).count() == 0
    assert setm.collocations(rows(spark, [("a b c", "en"), (None, None)])).count() == 0
