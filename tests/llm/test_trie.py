"""The peeled conversation trie, against building it whole."""

import hashlib
import random
import zlib

from txnwatch.llm import trie

SCHEMA = "conv_id long, turn int, role string, text string, depth long, a string, n long"


def table(spark, rows):
    return spark.createDataFrame([(*row, 7, "x", 1) for row in rows], SCHEMA)


def plain(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {conv: [row[2:] for row in sorted(own)] for conv, own in turns.items()}
    rebuilt = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = tuple(turns.get(conv - conv % 100, [])[:h] + own[h:])
    members = {}
    for conv, own in rebuilt.items():
        for depth in range(len(own) + 1):
            members.setdefault(own[:depth], []).append(conv)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        if node:
            up = node[:-1]
            kids[up], leaves[up], saved[up] = kids.get(up, 0) + 1, leaves.get(up, 0) + leaves[node], saved.get(up, 0) + saved[node]
    digest = lambda node: hashlib.sha256(",".join(str(c) for c in sorted(members[node]) if rebuilt[c] == node).encode()).hexdigest()
    return sorted([(min(own), len(node), min(members[node[:-1]]) if node else None, len(own), kids.get(node, 0), leaves[node], saved[node], digest(node))
                   for node, own in members.items()], key=str)


def check(spark, rows, **kind):
    got = trie.prefix_trie(table(spark, rows).repartition(3))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_the_trie_equals_a_plain_one(spark):
    rng, rows = random.Random(1), []
    for conv in rng.sample(range(330), 90) + [None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, 0, None]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "a", "bé", "", None, "long text"])))
    check(spark, rows + rows[:5])


def test_snapshots_and_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRETCH", 4)
    log = [("u", f"turn {i}") for i in range(24)]
    rows = [(conv, i, *turn) for conv, n in ((0, 24), (1, 24), (2, 11), (3, 12), (4, 24), (5, 1), (7, 17), (250, 24), (201, 3)) for i, turn in enumerate(log[:n])]
    check(spark, rows)


def test_many_convs_under_one_turn_and_one_long_conv(spark):
    rows = [(conv, turn, "u", "hello" if turn == 0 else f"{conv % 900} {turn}") for conv in range(1000, 3000) for turn in range(2)]
    rows += [(5, turn, "u", f"t{turn % 50}") for turn in range(6000)] + [(17, turn, "u", f"t{turn % 50}") for turn in range(6000)]
    check(spark, rows)


def test_empty(spark):
    assert trie.prefix_trie(table(spark, [(1, 0, "u", "x")]).limit(0)).count() == 0
    assert trie.prefix_trie(table(spark, [(None, 0, "u", "x")])).count() == 0
