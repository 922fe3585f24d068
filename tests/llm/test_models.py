"""Classifiers: held-out accuracy, what must not leak in, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnwatch.llm import convolution, subword
from txnwatch.llm.labelled import label_counts, remainder, sample
from txnwatch.llm.words import Runs, runs_where, stretches

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, score int, predicted string, held_out int"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(result, labels, label):
    rows = result.filter("held_out").join(labels.select("doc_id", F.col(label).alias("y")), "doc_id").toPandas()
    place = rows.score.rank()
    auc = (place[rows.y == 1].mean() - place[rows.y == 0].mean()) / len(rows) + 0.5
    return auc, (rows.predicted == rows.y).mean()


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    result = subword.quality(docs, labels)
    auc, right = held_out(result, labels, "quality")
    assert auc > 0.99 and right > 0.98
    assert result.count() == docs.count() and result.filter("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    result = convolution.toxicity(docs, labels)
    auc, right = held_out(result, labels, "toxic")
    assert auc > 0.93 and right > 0.95
    assert result.count() == docs.count()


@pytest.mark.parametrize("learn,label,modulus,rest", [(subword.learn, "quality", 3, 1), (convolution.learn, "toxic", 5, 0)])
def test_held_out_labels_are_never_seen(tables, learn, label, modulus, rest):
    """Labels of held-out rows turned round change no score."""
    docs, labels = tables
    rule = remainder("doc_id", modulus) != rest
    texts = ["of the and was", "$$$ *** %%%", "idiot", ""]
    turned = labels.withColumn(label, F.when(rule, F.col(label)).otherwise(1 - F.col(label)))
    a, b = learn(docs, labels, label, rule, per_label=(60, 60)), learn(docs, turned, label, rule, per_label=(60, 60))
    assert a.scores(texts).tolist() == b.scores(texts).tolist()


def test_odd_rows_and_clashing_columns(spark, tables):
    _, labels = tables
    rows = [(0, None, None, 1, "x", 1), (1, "", "en", 1, "x", 1), (1, "", "en", 1, "x", 1), (None, "of the and", "de", 1, "x", 1), (2, "word " * 200_000, "en", 1, "x", 1), (3, "\x00 \n", "en", 1, "x", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    for run in (subword.quality, convolution.toxicity):
        got = run(docs, labels).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (0, 1)}) == 1
        assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


@pytest.mark.parametrize("run", [subword.quality, convolution.toxicity])
def test_missing_labels_and_empty_tables(spark, run):
    docs = spark.createDataFrame([(1, "a b", "en", 1, "x", 1), (2, None, "en", 1, "x", 1)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in run(docs, none).collect()} == {0.5}
    one_kind = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (2, 1, 1), (7, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r["score"] <= 1 for r in run(docs, one_kind).collect())
    assert run(spark.createDataFrame([], DOCS), none).count() == 0


def test_samples_are_bounded_and_repeated_labels_count_once(spark, tables):
    docs, labels = tables
    clean, counts = label_counts(labels.unionAll(labels), "toxic", F.lit(True))
    assert sum(counts.values()) == labels.select("doc_id").distinct().count()
    chosen = sample(docs, clean, (35, 25))
    assert sorted(r["count"] for r in chosen.groupBy("label").count().collect()) == [25, 35]


def test_runs_hash_by_content_alone():
    data = b"abc xx abc xx  toxic abcx"
    (values, size), = stretches(data)
    starts, ends = runs_where(values[:size] > 32)
    found = Runs(values).hashes(starts, ends)
    words = data.split()
    assert [bytes(values[a:b]) for a, b in zip(starts, ends)] == words
    assert all((found[i] == found[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(i))


def test_stretches_cover_whole_texts(monkeypatch):
    from txnwatch.llm import words

    monkeypatch.setattr(words, "STRETCH", 10)
    text = "some words of a text that is longer than one stretch " * 5
    assert b"".join(bytes(v[:n]) for v, n in stretches(text.encode())) == text.encode()
    whole = convolution.word_buckets(text)
    assert len(whole) == len(text.split())
    assert sum(len(part) for part in subword.features(text)) > len(text)


def test_pooling_in_stretches_equals_pooling_whole():
    rng = np.random.default_rng(0)
    model = convolution.ToxicityModel(
        rng.standard_normal((convolution.BUCKETS, sum(convolution.WIDTHS), convolution.FILTERS)).astype(np.float32),
        np.zeros((len(convolution.WIDTHS), convolution.FILTERS), np.float32), np.ones(len(convolution.WIDTHS) * convolution.FILTERS, np.float32), 0.0)
    words = rng.integers(0, convolution.BUCKETS, (40_000, convolution.VIEWS)).astype(np.int32)
    taps = model.taps[words].sum(axis=1)
    want, at = [], 0
    for width in convolution.WIDTHS:
        n = len(words) - width + 1
        want.append(sum(taps[t: t + n, at + t] for t in range(width)).max(axis=0))
        at += width
    assert np.allclose(model.pooled(words), np.maximum(0, np.concatenate(want)), atol=1e-4)


def test_threshold_has_the_fewest_errors():
    logits, labels = np.array([-3, -2, -1, 0.5, 1.0, 4.0]), np.array([0, 0, 1, 0, 1, 1])
    assert -1 > convolution.best_threshold(logits, labels, 5.0) > -2
    assert 1 > convolution.best_threshold(logits, labels, 0.1) > 0.5
