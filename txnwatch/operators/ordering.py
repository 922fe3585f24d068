"""Totals and quantiles along a global order, without a single-task window."""

from pyspark.sql import DataFrame, Window, functions as F

from txnwatch.session import materialize


def running_totals(df: DataFrame, order: str, sums: list[str], groups: list[str] | None = None) -> DataFrame:
    """Add ``<name>_upto`` and ``<name>_total`` for each of ``sums``.

    The first is the sum over rows up to this one, the second over all rows.

    Rows must be unique on (groups, order), so callers aggregate first. Spark
    cuts the order into even slices; each slice is summed, the slice sums (one
    row per slice and group) are accumulated, and rows only need the total of the
    slices before theirs. The slices are written out because both steps must see
    the same cut.
    """
    groups = groups or []
    sliced = materialize(
        df.repartitionByRange(*groups, order).withColumn("_slice", F.spark_partition_id()), "slices"
    )
    per_slice = sliced.groupBy(*groups, "_slice").agg(*[F.sum(name).alias(name) for name in sums])
    everything = Window.partitionBy(*groups)
    earlier = everything.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *groups, "_slice",
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}_before") for name in sums],
        *[F.sum(name).over(everything).alias(f"{name}_total") for name in sums],
    )
    within = (
        Window.partitionBy(*groups, "_slice").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return sliced.join(offsets, [*groups, "_slice"]).select(
        *df.columns,
        *[(F.sum(name).over(within) + F.col(f"_{name}_before")).alias(f"{name}_upto") for name in sums],
        *[f"{name}_total" for name in sums],
    )


def _covers(place, weight: str):
    """Whether a value repeated ``weight`` times occupies the 0-based ``place``."""
    upto = F.col(f"{weight}_upto")
    return (upto - F.col(weight) <= place) & (upto > place)


def value_at(counted: DataFrame, value: str, place: int, weight: str = "n"):
    """The value at ``place`` of the sorted rows, each repeated ``weight`` times."""
    ranked = running_totals(counted.select(value, weight), value, [weight])
    return ranked.agg(F.max(F.when(_covers(F.lit(place), weight), F.col(value)))).first()[0]


def quantile(counted: DataFrame, value: str, q: float, weight: str = "n") -> float | None:
    """Exact quantile, interpolated linearly, of values seen ``weight`` times each.

    The built-in aggregate would hold all distinct values in one task.
    """
    ranked = running_totals(counted.select(value, weight), value, [weight])
    last = F.col(f"{weight}_total") - 1
    position = last * F.lit(q)
    low, high = F.floor(position), F.least(F.floor(position) + 1, last)
    found = ranked.agg(
        F.max(F.when(_covers(low, weight), F.col(value))).alias("low"),
        F.max(F.when(_covers(high, weight), F.col(value))).alias("high"),
        F.max(position - F.floor(position)).alias("part"),
    ).first()
    if found["low"] is None:
        return None
    return found["low"] + (found["high"] - found["low"]) * found["part"]
