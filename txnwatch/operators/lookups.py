"""Left lookups that hold up when a few keys own much of the fact table."""

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000
#: A key is hot from one row in so many on, which also bounds how many there are.
HOT_KEYS = 1000
#: Salts are hashed to partitions, so several for each are needed to fill all evenly.
SALTS_PER_PARTITION = 8


def hot_keys(counts: DataFrame, key: str, total: int, table_rows: int) -> list:
    """Keys owning at least a thousandth of ``total`` rows, given per-key ``n``.

    At most a thousand keys can qualify, which bounds what reaches the driver.
    None are looked for when the table is small enough to be broadcast.
    """
    if table_rows <= BROADCAST_ROWS:
        return []
    return [row[0] for row in counts.filter(F.col("n") * HOT_KEYS >= total).select(key).collect()]


def lookup(
    facts: DataFrame, table: DataFrame, key: str, hot: list, table_rows: int, few_facts: bool = False
) -> DataFrame:
    """Left join of ``facts`` to a table with one row per ``key``.

    A table counted and found small is broadcast. So is, for facts counted and
    found few, the part of the table that they ask for. Otherwise rows of hot keys
    and rows without a key are spread over several salts for each shuffle partition,
    by their content, and the few matching table rows repeated; keys that have
    become hot since are left to the adaptive skew join.
    """
    if table_rows <= BROADCAST_ROWS:
        return facts.join(F.broadcast(table), key, "left")
    if few_facts:
        wanted = facts.select(key).distinct()
        return facts.join(F.broadcast(table.join(F.broadcast(wanted), key, "left_semi")), key, "left")
    salts = SALTS_PER_PARTITION * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    salted = facts.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, spread).otherwise(0))
    repeats = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = table.withColumn("_salt", F.explode(repeats))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")
