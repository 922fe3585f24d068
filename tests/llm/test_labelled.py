"""What learning may read: bounded in rows and size, whatever ids repeat; scores of long texts."""

import resource

from pyspark.sql import functions as F

from txnwatch.llm import labelled, subword
from txnwatch.llm.words import STRETCH, stretches


def test_copies_of_one_id_are_bounded_by_rows(spark):
    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    docs = docs.unionAll(spark.createDataFrame([(8, "other"), (9, None), (None, "x")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 0)], "doc_id long, label int")
    got = {row["label"]: row["count"] for row in labelled.sample(docs, labels, (3000, 1500)).groupBy("label").count().collect()}
    assert got == {0: 2, 1: 1500}
    assert labelled.sample(docs, labels, (1, 1)).count() == 2


def test_the_size_of_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(labelled, "TEXT_CHARS", 50)
    monkeypatch.setattr(labelled, "LABEL_CHARS", 120)
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), 100).alias("text"))
    rows = labelled.sample(docs, spark.range(30).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label")), (15, 15)).collect()
    assert len(rows) == 6 and {len(row["text"]) for row in rows} == {50}


def test_stretches_are_bounded_and_whole():
    for data in (b"", b"a" * (5 * STRETCH + 3), b"word " * STRETCH, b"x" * STRETCH + b" y" + b"z" * (3 * STRETCH)):
        parts = list(stretches(data))
        assert b"".join(part[:length].tobytes() for part, length in parts) == data
        assert all(length <= 2 * STRETCH for _, length in parts)


def test_a_text_of_64_mb_without_a_blank_takes_little_memory():
    import numpy as np

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert 0 < subword.QualityModel(np.zeros(subword.BUCKETS, np.float32), 0.1).scores(["x" * (64 << 20)])[0] < 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 900_000
