"""Registered queries of the operators, with production parameters, and their SQL checks."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.llm import chat, convolution, exact, packing, pieces, prefixcounts, setm, simhash, sitetree, subword, tokenfile, trie, voronoi
from txnwatch.llm.tokens import tokenizer_path
from txnwatch.session import materialize

#: Ids that end a document, the longest sequence, and the tokens a document may have, as the results ask for.
FILE_END_ID, PACK_END_ID, PACK_LENGTH, TOKEN_LIMIT = 1, 0, 1024, 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convolution.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write token files of all documents, read them back."""
    files = tokenfile.write_token_files(
        table(spark, sf_dir, "documents"), tokenfile.token_file_folder(spark), tokenizer_path("word_bpe_49k.json"), FILE_END_ID)
    return tokenfile.read_token_files(files)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), PACK_END_ID, PACK_LENGTH)


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count every prefix, store the table, and ask it for sizes and for the longest prefix within the limit."""
    table_of_counts = materialize(prefixcounts.prefix_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")), "prefix-counts")
    asked = prefixcounts.longest_prefixes(table_of_counts, TOKEN_LIMIT)
    return asked.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_chars", "cut_tokens")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm.collocations(table(spark, sf_dir, "documents"), min_count=100, longest=5, first=2000)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (op1_quality, op2_top_products, op3_toxicity, op4_token_files, op5_sentencepiece, op6_packing, op7_main_text, op8_simhash, op9_exact_dedup, op10_chat,
                                op11_token_counts, op12_collocations, op13_prefix_trie)
}

ORACLE_SQL = {"op2_top_products": voronoi.ORACLE_SQL, "op9_exact_dedup": exact.ORACLE_SQL, "op10_chat": chat.ORACLE_SQL, "op12_collocations": setm.ORACLE_SQL,
              "op13_prefix_trie": trie.ORACLE_SQL}
