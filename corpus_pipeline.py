"""From raw documents to packed training sequences, a stage at a time.

Each stage takes all that the one before kept and hands on whole documents; the
last one hands on the pieces of the packed sequences. A stage's result is written
to the shared folder and read again, so a lost executor costs a stage's own tasks.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.llm import convolution, exact, packing, queries, simhash, subword
from txnwatch.llm.common import few_rows_at_a_time, fresh
from txnwatch.llm.labelled import remainder
from txnwatch.llm.tokens import tokenizer_path
from txnwatch.session import materialize


def _scored(docs: DataFrame, model) -> tuple[DataFrame, str]:
    (name,) = fresh(docs, "_score")
    return few_rows_at_a_time(docs).withColumn(name, subword.score("text", model)), name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier does not reject as toxic."""
    model = convolution.learn(docs, queries.table(spark, sf_dir, "labels"), "toxic", remainder("doc_id", 5) != 0)
    rows, score = _scored(docs, model)
    return rows.filter(F.col(score) < 0.5).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword classifier takes for good."""
    model = subword.learn(docs, queries.table(spark, sf_dir, "labels"), "quality", remainder("doc_id", 3) != 1)
    rows, score = _scored(docs, model)
    return rows.filter(F.col(score) >= 0.5).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose fingerprints link them (three-word shingles, two bits), the document with the smallest id."""
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences along the curve."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), queries.PACK_END_ID, queries.PACK_LENGTH)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("packing", pack),
]

#: Learned scores can't be put in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
