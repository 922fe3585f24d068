"""Chat formatting after collapsing cumulative snapshots, with DataFrame functions alone.

A log often holds a conversation again and again as it grows. Each turn is hashed
with its place; exclusive-or of the hashes up to a turn is the rolling hash of the
prefix that ends there (two 64-bit hashes, and the number of turns). A conversation
whose whole hash is a proper prefix of another is dropped by an anti-join; of equal
conversations the smallest id stays. What is left is rendered.

Turns are cut into even slices of one order over all conversations. Prefixes are
rolled, and turns counted, inside a slice and carried over its borders, so a
conversation with a large share of all turns is many groups, however its turns are
numbered, also if they share a number or have none.

Cases: turns are ordered by number, those without one last, and within a number by
role and text; rows repeated whole count once; a null role is ``unknown``, a null
text is empty; a null conversation id is an id like any other; an empty table gives
no rows. Only the four columns are read.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnwatch.session import materialize

#: Turns in a part.
STRETCH = 1024
#: Characters of a text by which even slices are cut.
SLICED_BY = 64
#: Place of turns that have no number.
UNNUMBERED = 1 << 62
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def placed_turns(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id"), F.coalesce(F.col("turn").cast("long"), F.lit(UNNUMBERED)).alias("place"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def with_slices(rows: DataFrame, *order) -> DataFrame:
    """Rows in even slices of one order over all conversations. Written out, as all who carry sums over must see the same cut."""
    return materialize(rows.repartitionByRange("conv_id", *order).withColumn("slice", F.spark_partition_id()), "turn-slices")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Per conversation and place: hashes and turns up to there (a, b, n) and turns in all (n_turns)."""
    rows = placed_turns(turns).select(
        "conv_id", "place", F.xxhash64("place", "role", "text").alias("a"),
        F.xxhash64(F.lit("second"), "text", "role", "place").alias("b")).distinct()
    places = with_slices(rows.groupBy("conv_id", "place").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.count("*").alias("n")), "place")
    slices = places.groupBy("conv_id", "slice").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("n").alias("n"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(
        F.col("conv_id").alias("_conv"), F.col("slice").alias("_slice"),
        *[F.coalesce(function(name).over(earlier), F.lit(0)).alias(f"_{name}") for name, function in (("a", F.bit_xor), ("b", F.bit_xor), ("n", F.sum))],
        F.sum("n").over(whole).alias("n_turns"))
    inside = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = places.select(
        "conv_id", "slice", F.bit_xor("a").over(inside).alias("a"), F.bit_xor("b").over(inside).alias("b"), F.sum("n").over(inside).alias("n"))
    joined = rolled.join(carried, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slice") == F.col("_slice")))
    return joined.select(
        "conv_id", F.col("a").bitwiseXOR(F.col("_a")).alias("a"), F.col("b").bitwiseXOR(F.col("_b")).alias("b"),
        (F.col("n") + F.col("_n")).alias("n"), "n_turns")


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of conversations that are no proper prefix of another, each once."""
    prefixes = materialize(prefix_hashes(turns), "turn-prefixes")
    proper = prefixes.filter(F.col("n") < F.col("n_turns")).select("a", "b", "n").distinct()
    whole = prefixes.filter(F.col("n") == F.col("n_turns")).groupBy("a", "b", "n").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    return whole.join(proper, ["a", "b", "n"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template; its marks inside a text are broken up, so that a text can't open or close a turn."""
    safe = F.replace(text, F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(F.lit(OPEN), role, F.lit("\n"), safe, F.lit(CLOSE), F.lit("\n"))


def with_parts(turns: DataFrame) -> DataFrame:
    """Distinct placed turns with their part: in the order of a conversation, the first ``STRETCH`` turns have part 0, and so on."""
    sliced = with_slices(turns, "place", F.substring("role", 1, SLICED_BY), F.substring("text", 1, SLICED_BY))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = sliced.groupBy("conv_id", "slice").agg(F.count("*").alias("n")).select(
        F.col("conv_id").alias("_before"), F.col("slice").alias("_slice"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    inside = Window.partitionBy("conv_id", "slice").orderBy("place", "role", "text")
    counted = sliced.withColumn("number", F.row_number().over(inside))
    joined = counted.join(before, F.col("conv_id").eqNullSafe(F.col("_before")) & (F.col("slice") == F.col("_slice")))
    return joined.withColumn("part", F.floor((F.col("n") + F.col("number") - 1) / STRETCH)).drop("_before", "_slice", "n", "number", "slice")


def format_chats(turns: DataFrame) -> DataFrame:
    """Maximal conversations in the chat template: conv_id, part, n_turns, n_copies, chat.

    A part holds ``STRETCH`` turns, the last one what is left; nearly all conversations have one.
    """
    chosen = maximal_conversations(turns).withColumnRenamed("conv_id", "_conv")
    rows = placed_turns(turns).distinct().join(chosen, F.col("conv_id").eqNullSafe(F.col("_conv")))
    ordered = F.array_sort(F.collect_list(F.struct("place", "role", "text")))
    parts = with_parts(rows).groupBy("conv_id", "part", "n_turns", "n_copies").agg(ordered.alias("turns"))
    chat = F.array_join(F.transform("turns", lambda turn: rendered(turn["role"], turn["text"])), "")
    return parts.select("conv_id", "part", "n_turns", "n_copies", chat.alias("chat"))


ORACLE_SQL = f"""
WITH turns AS (
  SELECT DISTINCT conv_id, coalesce(turn, {UNNUMBERED}) AS place, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), shown AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY place, role, text) - 1) // {STRETCH} AS part,
         '{OPEN}' || role || chr(10) || replace(text, '<|im_', '<| im_') || '{CLOSE}' || chr(10) AS line FROM turns
), upto AS (
  SELECT conv_id, place, string_agg(place || '/' || line, '' ORDER BY place, role, text) OVER w AS prefix,
         count(*) OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM shown WINDOW w AS (PARTITION BY conv_id ORDER BY place)
), whole AS (
  SELECT prefix, n_turns, min(conv_id) AS conv_id, count(DISTINCT conv_id) AS n_copies FROM upto WHERE n = n_turns GROUP BY ALL
), kept AS (
  SELECT * FROM whole WHERE NOT EXISTS (SELECT 1 FROM upto WHERE upto.prefix = whole.prefix AND upto.n < upto.n_turns)
)
SELECT kept.conv_id, part, n_turns, n_copies, string_agg(line, '' ORDER BY place, role, text) AS chat
FROM kept JOIN shown ON shown.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY ALL
"""
