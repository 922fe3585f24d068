"""Exact and near deduplication, components, and what they do with odd rows."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from txnwatch.llm import exact, simhash
from txnwatch.llm.components import components
from txnwatch.session import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _text string, keep_id string, bits long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5, "x", "y", 7) for i, t in rows], SCHEMA)


ODD = [
    (1, "Same TEXT"), (2, "same text"), (3, "SAME text"), (3, "SAME text"), (4, None), (5, ""), (None, "same text"), (None, None),
    (6, "Éa"), (7, "éa"), (8, "word " * 3000), (9, "word " * 3000 + "x"), (10, "   \n\t "), (11, "one two"),
]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_groups_of_odd_rows(spark):
    got = exact.duplicates(table(spark, ODD)).collect()
    texts = [(i, lower(t)) for i, t in ODD]
    want = []
    for i, t in texts:
        own = [j for j, u in texts if u == t]
        keep = max((j for j in own if j is not None), default=None)
        want.append((i, keep, len(own), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_stage_keeps_columns_and_one_row_of_each(spark):
    docs = table(spark, ODD)
    kept = exact.deduplicate(docs)
    assert kept.columns == docs.columns
    texts = [lower(row["text"]) for row in kept.collect()]
    assert sorted(texts) == sorted({lower(t) for _, t in ODD})


def test_a_hot_text_is_spread(spark):
    docs = table(spark, [(i, "hot" if i % 3 else f"cold {i}") for i in range(3000)])
    got = exact.duplicates(docs).toPandas()
    assert got[got.doc_id % 3 > 0].keep_id.eq(2999).all() and got[got.doc_id % 3 > 0].group_size.eq(2000).all()
    assert got[got.doc_id % 3 == 0].kept.all()


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i: i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(bits, ids, radius=2):
    root = list(range(len(bits)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(bits)):
        for j in range(i):
            if (int(bits[i]) ^ int(bits[j])).bit_count() <= radius:
                root[find(i)] = find(j)
    smallest = {}
    for i, own in enumerate(ids):
        if own is not None:
            smallest[find(i)] = min(own, smallest.get(find(i), own))
    return [smallest.get(find(i)) for i in range(len(bits))]


def test_fingerprints_and_components_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = docs.toPandas().sort_values("doc_id")
    got = simhash.near_duplicates(docs).toPandas().sort_values("doc_id")
    bits = [brute_fingerprint(t) for t in rows.text]
    assert [int(x, 16) for x in got.fingerprint] == bits
    assert got.component_id.tolist() == brute_components(bits, rows.doc_id.tolist())


def test_fingerprints_of_odd_rows(spark):
    got = simhash.near_duplicates(table(spark, ODD)).collect()
    bits = [brute_fingerprint(t) for _, t in ODD]
    want = brute_components(bits, [i for i, _ in ODD])
    assert sorted(map(tuple, got), key=str) == sorted(((i, f"{b:016x}", c) for (i, _), b, c in zip(ODD, bits, want)), key=str)


@pytest.mark.parametrize("tile", [32, 1 << 14])
def test_tiles_find_all_links(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = np.random.default_rng(1)
    steps = [rng.integers(0, 2 ** 63, 60, dtype=np.uint64)]
    for _ in range(8):
        bits = rng.integers(0, 64, (2, 60)).astype(np.uint64)
        steps.append(steps[-1] ^ (np.uint64(1) << bits[0]) ^ (np.uint64(1) << bits[1]))
    bits = np.unique(np.concatenate([*steps, np.arange(120, dtype=np.uint64)]))
    nodes = spark.createDataFrame(pd.DataFrame({"bits": bits.view(np.int64)})).repartition(3)
    found = components(simhash.links_within(nodes, 2)).toPandas()
    root = dict(zip(found.node.tolist(), found.root.tolist()))
    ours, theirs = {}, {}
    for value, other in zip(bits.view(np.int64).tolist(), brute_components(bits.tolist(), list(range(len(bits))))):
        ours.setdefault(root.get(value, value), set()).add(value)
        theirs.setdefault(other, set()).add(value)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)]
    links = materialize(spark.createDataFrame(chain, "u long, v long"), "chain")
    found = dict(components(links).collect())
    assert all(found[i] == 0 for i in range(1, 201)) and all(found[1001 + i] == 1000 for i in range(300))


def test_empty_tables(spark):
    docs = table(spark, [])
    assert exact.duplicates(docs).count() == 0 and exact.deduplicate(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0 and simhash.one_of_each(docs).count() == 0


def test_near_stage_keeps_one_of_each(spark):
    docs = table(spark, [(5, "a b c d e"), (4, "A b c d e"), (9, "other words stand here now"), (None, "null id has words too ok")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "9", "None"]
