"""Learning from every labelled row: nothing is left out, shards are averaged, cuts and sums are those of the whole."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from txnwatch.llm import convolution, labelled, subword
from txnwatch.llm.labelled import remainder

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("learn,weights", [(subword.learn, "weights"), (convolution.learn, "taps")])
def test_rows_past_the_first_thousands_are_learned_from(spark, learn, weights, monkeypatch):
    monkeypatch.setattr(convolution, "STEPS", 1)
    rows = spark.range(6600).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"))
    late = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")) > 3000
    docs = rows.select("doc_id", F.when(late, "zebra owl").otherwise("green red").alias("text"), "label", late.alias("late")).localCheckpoint()
    plain = learn(docs.withColumn("text", F.lit("green red")), rows, "label", F.lit(True))
    assert not np.array_equal(getattr(plain, weights), getattr(learn(docs, rows, "label", F.lit(True)), weights))


def test_whole_texts_are_learned_from(spark):
    """What tells the labels apart lies behind 200,000 characters that all texts have."""
    texts = [(i, "a " * 100_000 + ("spam" if i % 2 else "ham"), i % 2) for i in range(6)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label int")
    table, n_shards, kinds = labelled.in_shards(docs.drop("label"), docs.select("doc_id", "label"))
    found = labelled.summed(table.select(F.lit(True).alias("fitted"), "label", "text", F.lit("").alias("lang")), convolution._profile)
    held = np.concatenate([found[f"held {at}"].reshape(2, -1) for at in range(0, convolution.BUCKETS, labelled.BLOCK)], axis=1)
    spam, ham = (convolution.word_buckets(word)[0, 0] for word in ("spam", "ham"))
    assert held[:, spam].tolist() == [0, 3] and held[:, ham].tolist() == [3, 0] and kinds == {0: 3, 1: 3} and n_shards == 1


@pytest.mark.parametrize("module,read", [(subword, lambda model: -model.bias), (convolution, lambda model: model.constant + 1)])
def test_every_row_is_passed_as_often_whatever_the_shards(spark, module, read, monkeypatch):
    """Each shard adds the passes it is asked for to the bias, so the average of the shards is how often rows are learned from."""
    def count_passes(weights, examples, rng, epochs, first, last):
        weights[2 if len(weights) == 3 else 4][0] += epochs

    monkeypatch.setattr(convolution, "STEPS", 2000)
    monkeypatch.setattr(module, "descend", count_passes)
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), (F.col("id") % 2).cast("int").alias("label"))
    alone = read(module.learn(rows.drop("label"), rows, "label", F.lit(True)))
    monkeypatch.setattr(labelled, "SHARD_ROWS", 50)
    assert alone >= 4 and read(module.learn(rows.drop("label"), rows, "label", F.lit(True))) == pytest.approx(alone)


@pytest.mark.parametrize("run,label", [(subword.quality, "quality"), (convolution.toxicity, "toxic")])
def test_averaged_shards_tell_held_out_rows(spark, monkeypatch, run, label):
    monkeypatch.setattr(labelled, "SHARD_ROWS", 700)
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    rows = run(docs, labels).filter("held_out").join(labels.select("doc_id", F.col(label).alias("y")), "doc_id").toPandas()
    place = rows.score.rank()
    assert (place[rows.y == 1].mean() - place[rows.y == 0].mean()) / len(rows) + 0.5 > 0.93
    assert (rows.predicted == rows.y).mean() > 0.95


def test_every_row_lies_in_one_place_whatever_repeats(spark, monkeypatch):
    monkeypatch.setattr(labelled, "SHARD_ROWS", 100)
    rows = spark.range(1000).select((F.col("id") % 7).alias("doc_id"), F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id"))).alias("text"))
    table, n, kinds = labelled.in_shards(rows.unionAll(spark.createDataFrame([(None, "x")], rows.schema)), rows.select("doc_id").distinct().withColumn("label", F.lit(1)))
    places = {}
    for row in table.collect():
        places.setdefault(row["shard"], []).append(row["place"])
    assert n == 10 and kinds == {1: 1000} and sum(map(len, places.values())) == 1000
    assert all(sorted(found) == list(range(len(found))) for found in places.values())


def test_cuts_are_those_of_all_points(spark):
    rng = np.random.default_rng(4)
    rows = [(int(group), float(np.round(rng.normal(label * 1.5 - 1, 40.0 if group == 2 else 1.0), 1 + int(group))), int(label))
            for group, label in zip(rng.integers(0, 4, 600), rng.integers(0, 2, 600))] + [(9, 0.5, 1)] * 9
    cuts = labelled.best_cuts(spark.createDataFrame(rows, "group int, logit double, label int"), 1.7, 8)
    assert sorted(cuts) == [0, 1, 2, 3]
    for group, cut in cuts.items():
        logits, marks = (np.array(values) for values in zip(*[(logit, label) for g, logit, label in rows if g == group]))
        assert cut == pytest.approx(convolution.best_threshold(logits, marks, 1.7))


def test_responses_in_parts_equal_those_of_the_whole():
    rng = np.random.default_rng(1)
    vectors, filters = rng.standard_normal((convolution.BUCKETS, 3)).astype(np.float32), rng.standard_normal((3, sum(convolution.WIDTHS), convolution.FILTERS)).astype(np.float32)
    words = rng.integers(0, convolution.BUCKETS, (70_000, convolution.VIEWS)).astype(np.int32)
    best, where = convolution.responses(words, vectors, filters)
    taps, at = np.tensordot(vectors[words].sum(axis=1), filters, 1), 0
    for i, width in enumerate(convolution.WIDTHS):
        whole = sum(taps[t: len(taps) - width + 1 + t, at + t] for t in range(width))
        assert np.allclose(best[i], whole.max(axis=0), atol=1e-4) and (where[i] == whole.argmax(axis=0)).all()
        at += width
    assert len(convolution.responses(words[:0], vectors, filters)[0]) == len(convolution.WIDTHS)


def test_labels_of_no_document_and_rows_kept_out(spark):
    docs = spark.createDataFrame([(i, "x y") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    clean, _ = labelled.label_counts(labels, "label", remainder("doc_id", 3) != 1)
    assert labelled.in_shards(docs, clean)[0].filter(remainder("doc_id", 3) == 1).count() == 0
    assert convolution.learn(docs, labels.withColumn("doc_id", F.col("doc_id") + 100), "label", F.lit(True)).thresholds.tolist() == [0]
