"""Cutting long timelines so that no key or clock is handled by one task."""

from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F


def with_halo(df: DataFrame, at: Column, length: int, reach: int) -> DataFrame:
    """Assign rows to time chunks, repeating into the next chunk those it looks back to.

    Adds ``_chunk`` and ``_own``; a trailing window of at most ``reach`` within a
    chunk then sees everything it needs, and rows that are not ``_own`` are
    dropped after it. Only ``reach / length`` of the rows are repeated.
    """
    if reach > length:
        raise ValueError("a chunk must be at least as long as the look-back")
    chunk = F.floor(at / F.lit(length))
    near_end = at >= (chunk + 1) * F.lit(length) - F.lit(reach)
    places = F.array_compact(F.array(chunk, F.when(near_end, chunk + 1)))
    return df.withColumn("_chunk", F.explode(places)).withColumn("_own", F.col("_chunk") == chunk)


def trailing(at: Column, reach: int, *keys: str):
    """Window over the last ``reach`` units up to now, ties included, within a chunk."""
    return Window.partitionBy(*keys, "_chunk").orderBy(at).rangeBetween(-reach, 0)


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_chunk", "_own")


def in_windows(df: DataFrame, time: str, seconds: int, slide_seconds: int, *keys: str, **counts: Column) -> DataFrame:
    """``counts`` per sliding window (``slot``) and keys; table or stream with a watermark.

    Every row is counted in one pane, the longest stretch of which both the slide and the window are made up; only the
    panes' counts are repeated for the windows they lie in.
    """
    pane = f"{gcd(seconds, slide_seconds)} seconds"
    panes = df.groupBy(F.window(time, pane).alias("pane"), *keys).agg(*[count.alias(name) for name, count in counts.items()])
    if pane == f"{seconds} seconds":
        return panes.withColumnRenamed("pane", "slot")
    slot = F.window("pane", f"{seconds} seconds", f"{slide_seconds} seconds").alias("slot")
    return panes.groupBy(slot, *keys).agg(*[F.sum(name).alias(name) for name in counts])
