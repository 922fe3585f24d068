"""Learning feature statistics and applying them."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnwatch.functions.scalar import hour_angle, hour_of, indicator, zscore
from txnwatch.operators.lookups import hot_keys, lookup
from txnwatch.schemas import DEFAULT_USER, FEATURE_STATS, FEATURES, STD_FLOOR
from txnwatch.session import materialize


@dataclass
class FeatureState:
    """Three numbers, two lookup tables, and what is known about their sizes."""

    amount_mean: float
    amount_std: float
    merchant_freq_fallback: float
    n_rows: int
    n_categories: int
    n_users: int
    hot_users: list
    hot_categories: list
    merchant_freq: DataFrame = field(repr=False)
    user_home: DataFrame = field(repr=False)

    def stats(self, spark: SparkSession) -> DataFrame:
        values = tuple(getattr(self, name) for name in FEATURE_STATS.names)
        return spark.createDataFrame([values], FEATURE_STATS)


def _log_moments() -> list[Column]:
    log_amount = F.log1p(F.col("amount").cast("double"))
    return [F.count("*").alias("n"), F.count(log_amount).alias("n_amount"), F.avg(log_amount).alias("mean"), F.var_pop(log_amount).alias("variance")]


def category_moments(df: DataFrame, *groups: str) -> DataFrame:
    """Row count and log-amount moments per category (a NULL category included), and per ``groups`` if given.

    One pass over the data serves both the amount statistics and the category
    frequencies; everything after it works on one row per category.
    """
    return df.groupBy(*groups, "merchant_category").agg(*_log_moments())


def merged_moments(parts: DataFrame, *groups: str) -> DataFrame:
    """Moments of several parts of the data as those of the whole: one row per category, and per ``groups`` if given."""
    weight = F.col("n_amount")
    sums = parts.groupBy(*groups, "merchant_category").agg(
        F.sum("n").alias("n"),
        F.sum(weight).alias("n_amount"),
        F.sum(weight * F.col("mean")).alias("_total"),
        F.sum(weight * (F.col("variance") + F.col("mean") * F.col("mean"))).alias("_squares"),
    )
    mean = F.try_divide(F.col("_total"), weight)
    variance = F.greatest(F.try_divide(F.col("_squares"), weight) - mean * mean, F.lit(0.0))
    return sums.select(
        *groups, "merchant_category", "n", "n_amount", mean.alias("mean"), F.when(weight > 0, variance).alias("variance"))


def overall_statistics(moments: DataFrame) -> DataFrame:
    """One row: amount mean and floored sample deviation, and category totals.

    The squared deviation of the whole is the deviation inside the categories
    plus the deviation between their means. A single amount, or equal amounts,
    give the floor.
    """
    known = F.col("merchant_category").isNotNull()
    parts = moments.agg(
        F.sum("n").alias("n_rows"),
        F.sum("n_amount").alias("weight"),
        F.sum(F.col("n_amount") * F.col("mean")).alias("total"),
        F.sum(F.col("n_amount") * F.col("variance")).alias("within"),
        F.sum(F.col("n_amount") * F.col("mean") * F.col("mean")).alias("squares"),
        F.count_if(known).alias("n_categories"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_categorised"),
        F.min(F.when(known, F.col("n"))).alias("n_rarest"),
    )
    mean = F.try_divide(F.col("total"), F.col("weight"))
    deviation = F.col("within") + F.greatest(F.col("squares") - F.col("total") * mean, F.lit(0.0))
    std = F.sqrt(F.try_divide(deviation, F.col("weight") - 1))
    return parts.select(
        mean.alias("amount_mean"),
        F.greatest(std, F.lit(STD_FLOOR)).alias("amount_std"),
        F.try_divide(F.col("n_rarest"), F.col("n_categorised")).alias("merchant_freq_fallback"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        "n_categories",
        "n_categorised",
        F.coalesce("weight", F.lit(0)).alias("weight"),
    )


def merchant_frequency(moments: DataFrame, n_categorised: int) -> DataFrame:
    """Share of each known category among rows that have one."""
    return moments.filter("merchant_category IS NOT NULL").select(
        "merchant_category", "n", (F.col("n") / F.lit(n_categorised)).alias("freq")
    )


def _with_places(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` with user and country, and whether a row has both and is not labelled anomalous; none does if either column is absent."""
    if not {"user_id", "country"} <= set(df.columns):
        df = df.withColumns({"user_id": F.lit(None).cast("string"), "country": F.lit(None).cast("string")})
    normal = F.lit(True)
    if "is_anomaly" in df.columns:
        normal = ~F.coalesce("is_anomaly", F.lit(False))
    return df, normal & F.col("user_id").isNotNull() & F.col("country").isNotNull()


def normal_country_counts(df: DataFrame, *groups: str) -> DataFrame:
    """Rows not labelled anomalous per user and country, and per ``groups`` if given; none if either column is absent."""
    df, counts = _with_places(df)
    return df.filter(counts).groupBy(*groups, "user_id", "country").agg(F.count("*").alias("n"))


def moments_and_counts(df: DataFrame, *groups: str) -> tuple[DataFrame, DataFrame]:
    """:func:`category_moments` and :func:`normal_country_counts` of one scan, whose groups are stored."""
    df, counts = _with_places(df)
    moments = [*groups, "merchant_category"]
    rows = df.select(*moments, "amount", "user_id", "country", counts.alias("_counts"))
    both = rows.groupingSets([[F.col(name) for name in moments], [F.col(name) for name in (*groups, "user_id", "country")]], *moments, "user_id", "country")
    parts = materialize(both.agg(
        *_log_moments(), F.count_if("_counts").alias("_n_normal"), (F.grouping("merchant_category") == 0).alias("_is_moments")), "moments-and-counts")
    countries = parts.filter(~F.col("_is_moments") & (F.col("_n_normal") > 0))
    return (parts.filter("_is_moments").select(*moments, "n", "n_amount", "mean", "variance"),
            countries.select(*groups, "user_id", "country", F.col("_n_normal").alias("n")))


def merged_counts(parts: DataFrame, *groups: str) -> DataFrame:
    """Counts per user and country of several parts of the data as those of the whole."""
    return parts.groupBy(*groups, "user_id", "country").agg(F.sum("n").alias("n"))


def home_countries(df: DataFrame) -> DataFrame:
    """Most frequent country per user over rows not labelled anomalous.

    An unknown label counts as normal, ties go to the smallest country, and
    rows without user or country are ignored. Counting by (user, country) first
    is combined map-side, so a user with a third of all rows moves a few rows.
    """
    return most_frequent_country(normal_country_counts(df))


def most_frequent_country(counts: DataFrame) -> DataFrame:
    return counts.groupBy("user_id").agg(
        F.min_by("country", F.struct(-F.col("n"), F.col("country"))).alias("home_country"),
        F.sum("n").alias("n"),
    )


def fit_features(df: DataFrame) -> FeatureState:
    """Two scans of ``df``: one per category, one per (user, country).

    Both results are written out, so that applying the state never repeats them.
    """
    return state_from(category_moments(df), normal_country_counts(df))[0]


def state_from(moments: DataFrame, countries: DataFrame) -> tuple[FeatureState, int]:
    """The state from moments per category and counts per (user, country), and how many amounts it rests on."""
    moments = materialize(moments, "category-moments")
    overall = overall_statistics(moments).first()
    n_rows = overall["n_rows"]
    frequency = merchant_frequency(moments, overall["n_categorised"])
    homes = materialize(most_frequent_country(countries), "user-home")
    n_users = homes.count()
    state = FeatureState(
        amount_mean=overall["amount_mean"],
        amount_std=overall["amount_std"],
        merchant_freq_fallback=overall["merchant_freq_fallback"],
        n_rows=n_rows,
        n_categories=overall["n_categories"],
        n_users=n_users,
        hot_users=hot_keys(homes, "user_id", n_rows, n_users),
        hot_categories=hot_keys(frequency, "merchant_category", n_rows, overall["n_categories"]),
        merchant_freq=frequency.select("merchant_category", "freq"),
        user_home=homes.select("user_id", "home_country"),
    )
    return state, overall["weight"]


def transform(df: DataFrame, state: FeatureState, few_rows: bool = False) -> DataFrame:
    """Add the feature columns, all 32-bit floats, in their fixed order.

    An ``hour`` column, where present and not NULL, overrides the timestamp. The
    default user stands in for all that gave none, so it counts as hot.
    ``few_rows`` says that ``df`` was counted and may be broadcast.
    """
    hour = hour_of(override="hour" if "hour" in df.columns else None)
    found = lookup(df, state.merchant_freq, "merchant_category", state.hot_categories, state.n_categories, few_rows)
    found = lookup(found, state.user_home, "user_id", [*state.hot_users, DEFAULT_USER], state.n_users, few_rows)
    found = found.withColumn("_angle", hour_angle(hour))
    values = (
        zscore(F.log1p(F.col("amount").cast("double")), state.amount_mean, state.amount_std),
        F.sin("_angle"),
        F.cos("_angle"),
        F.coalesce("freq", F.lit(state.merchant_freq_fallback)),
        indicator(F.coalesce("home_country", F.lit("")) == F.col("country")),
    )
    columns = [value.cast("float").alias(name) for name, value in zip(FEATURES, values)]
    return found.select(*df.columns, *columns)
