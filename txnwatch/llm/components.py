"""Connected components of links as repeated DataFrame joins, with stored tables between rounds."""

from pyspark.sql import DataFrame, functions as F

from txnwatch.session import materialize


def _lowest(links: DataFrame) -> DataFrame:
    """Per ``u``, the smallest of itself and its neighbours ``v``; combined per task first."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that is linked and isn't its component's smallest.

    ``links`` holds longs u and v. Each round points neighbours above a node to the
    smallest around it, then those below (large star, small star), until nothing
    changes; rounds grow with the logarithm of a component's size.
    """
    edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "links")
        lowest = _lowest(large)
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(lowest.select("u", F.col("m").alias("v")))
        edges = materialize(small.filter("u <> v").distinct(), "links")
