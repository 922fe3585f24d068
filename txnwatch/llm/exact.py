"""Exact deduplication with DataFrame functions alone.

Texts are grouped by a 128-bit hash together with the text itself, so the bytes
inside a hash group are compared by the aggregation and a collision makes two
groups; tasks combine their own copies before the shuffle. Groups are then joined
back to the rows by their digests. A group with a thousandth of all rows or more
is hot; there are at most a thousand of them, so they are broadcast, and no row of
theirs meets the others in one task.

Cases: null text counts as empty; null ids never stay unless a group has no other
id; rows that repeat an id and a text count each in ``group_size``; an empty table
gives no rows. Columns of any name may be present.
"""

import string

from pyspark.sql import Column, DataFrame, functions as F

from txnwatch.llm.common import fresh, join_counted
from txnwatch.session import materialize


def normalised(text: str) -> Column:
    """Null as empty, A-Z in lower case, nothing else changed."""
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def text_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One stored row per distinct text: hash, text_sha256, keep_id, group_size."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), normalised(text).alias("text"))
    texts = texts.select("doc_id", "text", F.unhex(F.md5("text")).alias("hash"))
    groups = texts.groupBy("hash", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return materialize(groups.select("hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "text-groups")


def with_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with keep_id, group_size, kept and text_sha256 under names that are new to it, and these names."""
    keep_id, size, kept, sha, digest = fresh(docs, "keep_id", "group_size", "kept", "text_sha256", "_text")
    groups = text_groups(docs, doc_id, text).select(
        F.col("hash").alias(digest), F.col("text_sha256").alias(sha), F.col("keep_id").alias(keep_id), F.col("group_size").alias(size))
    rows = docs.withColumn(digest, normalised(text)).withColumn(sha, F.sha2(digest, 256)).withColumn(digest, F.unhex(F.md5(digest)))
    rows = join_counted(rows, groups, [digest, sha], size, F.col(doc_id))
    rows = rows.withColumn(kept, F.col(doc_id).eqNullSafe(F.col(keep_id)))
    return rows.select(*docs.columns, keep_id, size, kept, sha), [keep_id, size, kept, sha]


def duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    rows, names = with_groups(docs.select("doc_id", "text"))
    return rows.select("doc_id", *names)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their own columns: of equal texts the largest id, once.

    What stays is decided on ids and digests; whole rows move once, to meet the
    decision, and copies of a row under one id then lie side by side.
    """
    rows, (_, _, kept, sha) = with_groups(docs.select("doc_id", "text"))
    number, missing, digest = fresh(docs, "_number", "_missing", "_digest")
    keys = [number, missing, digest]
    key_of = [F.coalesce("doc_id", F.lit(0)).alias(number), F.col("doc_id").isNull().alias(missing)]
    stay = materialize(rows.filter(kept).select(*key_of, F.col(sha).alias(digest)).distinct(), "kept-texts")
    whole = docs.select("*", *key_of, F.sha2(normalised("text"), 256).alias(digest))
    return whole.join(stay, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


ORACLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS text FROM documents
), groups AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN groups USING (text)
"""
