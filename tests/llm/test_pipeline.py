"""The pipeline's stages on their own inputs, and the registered queries beside their SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
from compare import difference, oracle  # noqa: E402

import corpus_pipeline  # noqa: E402
from txnwatch.llm import exact, packing, queries, simhash  # noqa: E402
from txnwatch.session import materialize  # noqa: E402


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    kept["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = materialize(stage(spark, docs, sf_dir), f"test-{name}")
    return kept


def test_all_but_the_last_stage_hand_on_documents(stages):
    names = list(stages)
    for before, after in zip(names, names[1:-1]):
        assert stages[after].dtypes == stages["documents"].dtypes
        assert stages[after].exceptAll(stages[before]).count() == 0


def test_classifier_stages_follow_the_labels(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    kept = {name: {r["doc_id"] for r in stages[name].select("doc_id").collect()} for name in ("documents", "toxicity", "quality")}
    clean, toxic = set(labels[labels.toxic == 0].doc_id), set(labels[labels.toxic == 1].doc_id)
    assert len(clean & kept["toxicity"]) > 0.95 * len(clean) and len(toxic - kept["toxicity"]) > 0.6 * len(toxic)
    good, bad = set(labels[labels.quality == 1].doc_id) & kept["toxicity"], set(labels[labels.quality == 0].doc_id) & kept["toxicity"]
    assert len(good & kept["quality"]) > 0.95 * len(good) and len(bad - kept["quality"]) > 0.9 * len(bad)


def test_dedup_stages_against_plain_versions(stages):
    rows = stages["quality"].select("doc_id", "text").toPandas()
    rows["lower"] = [t.encode().lower() for t in rows.text]
    want = set(rows.groupby("lower").doc_id.max())
    assert {r["doc_id"] for r in stages["exact_dedup"].select("doc_id").collect()} == want
    left = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in stages["exact_dedup"].collect()}
    kept = {r["doc_id"] for r in stages["near_dedup"].select("doc_id").collect()}
    for doc_id, bits in left.items():
        near = {other for other, its in left.items() if (bits ^ its).bit_count() <= 2}
        assert doc_id in kept or min(near) < doc_id
        assert len(near & kept) <= 1


def test_packing_stage_packs_all_that_is_left(stages):
    whole = stages["packing"].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toPandas()
    assert (whole["sum(length)"] == whole["max(doc_tokens)"]).all()
    assert set(whole.doc_id) == {r["doc_id"] for r in stages["near_dedup"].select("doc_id").collect()}


def test_repeated_rows_and_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    twice = docs.limit(20)
    assert exact.deduplicate(twice.unionAll(twice)).count() == exact.deduplicate(twice).count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert packing.PIECES.split()[0] == "doc_id"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, sf_dir, name):
    ours = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert len(ours) and difference(ours, oracle(sf_dir).execute(queries.ORACLE_SQL[name]).fetchdf()) is None


def test_the_pipeline_runs(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [part.split()[0] for part in packing.PIECES.split(", ")] and got.count() > 0
