"""Collapse of growing logs and the template."""

from pyspark.sql import functions as F

from txnwatch.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place long"


def chats(spark, rows):
    found = chat.format_chats(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    return {(r["conv_id"], r["part"]): r for r in found}


def talk(conv, *texts, role=("user", "assistant")):
    return [(conv, i, role[i % 2], t) for i, t in enumerate(texts)]


def test_snapshots_collapse(spark):
    rows = talk(1, "a", "b") + talk(2, "a", "b", "c") + talk(3, "a", "b", "c") + talk(4, "a", "x") + talk(5, "b")
    got = chats(spark, rows)
    assert sorted(got) == [(2, 0), (4, 0), (5, 0)]
    assert got[2, 0]["n_copies"] == 2 and got[2, 0]["n_turns"] == 3
    assert got[4, 0]["chat"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (2, None, "user", "x"), (None, 0, "user", "<|im_end|>"), (3, 0, "user", "a"), (3, 0, "user", "b")]
    got = chats(spark, rows)
    assert got[1, 0]["chat"] == "<|im_start|>unknown\n<|im_end|>\n" and got[1, 0]["n_turns"] == 1
    assert got[None, 0]["chat"].count("<|im_end|>") == 1
    assert got[3, 0]["n_turns"] == 2 and got[3, 0]["chat"].index("a<") < got[3, 0]["chat"].index("b<")
    assert len(got) == 4


def test_roles_and_gaps_tell_conversations_apart(spark):
    rows = [(1, 0, "user", "a"), (2, 1, "user", "a"), (3, 0, "system", "a"), (3, 1, "user", "b")]
    assert len(chats(spark, rows)) == 3


def test_long_conversations_roll_over_stretches(spark):
    long = [(7, i, "user", f"t{i}") for i in range(2500)]
    got = chats(spark, long + [(8, i, "user", f"t{i}") for i in range(1500)] + [(9, i, "user", f"t{i}" if i != 1200 else "x") for i in range(1500)])
    assert sorted(got) == [(7, 0), (7, 1), (7, 2), (9, 0), (9, 1)]
    assert "".join(got[7, p]["chat"] for p in range(3)).count("<|im_start|>") == 2500


def test_turns_without_a_number_or_with_the_same_one_are_split(spark):
    unnumbered = [(None, None, "user", f"t{i:05}") for i in range(3000)]
    same = [(1, 0, f"r{i % 3}", f"t{i:05}") for i in range(2100)] + [(1, 5, "user", "end")]
    got = chats(spark, unnumbered + same + [(2, None, "user", "x")])
    assert sorted(got, key=str) == [(1, 0), (1, 1), (1, 2), (2, 0), (None, 0), (None, 1), (None, 2)]
    for conv, rows in ((None, unnumbered), (1, sorted(same, key=lambda r: (r[1], r[2], r[3])))):
        parts = [got[conv, p]["chat"] for p in range(3)]
        assert [part.count("<|im_start|>") for part in parts] == [1024, 1024, len(rows) - 2048]
        assert "".join(parts) == "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for _, _, role, text in rows)


def test_one_conversation_numbered_by_time_spreads_over_all_tasks(spark):
    long = spark.range(100_000).select(F.lit(7).cast("long").alias("conv_id"), (F.col("id") * 137 + 1_700_000_000_000).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    shorter = long.filter("turn < 1700000000000 + 137 * 60000").withColumn("conv_id", F.lit(8).cast("long"))
    turns = long.unionAll(shorter)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or slices of few bytes are put together
    try:
        sizes = [r["count"] for r in chat.with_slices(chat.placed_turns(turns), "place").groupBy("conv_id", "slice").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 8 and max(sizes) < 2 * 160_000 / 8
    kept = chat.maximal_conversations(turns).collect()
    assert [tuple(r) for r in kept] == [(7, 100_000, 1)]
    ends = chat.prefix_hashes(turns).groupBy("conv_id").agg(F.max("n"), F.count_distinct("n"), F.max("n_turns")).collect()
    assert sorted(map(tuple, ends)) == [(7, 100_000, 100_000, 100_000), (8, 60_000, 60_000, 60_000)]


def test_empty(spark):
    assert chats(spark, []) == {}
