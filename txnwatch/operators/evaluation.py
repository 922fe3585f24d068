"""Quality against labels.

Everything works on a *profile*: row counts per (score, label, type). A forest
score takes few distinct values next to the number of rows, so one grouped pass
shrinks the data for every metric that follows.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnwatch.functions.scalar import ratio
from txnwatch.operators.ordering import running_totals
from txnwatch.schemas import ANOMALY_TYPES


def profile(scored: DataFrame) -> DataFrame:
    """Counts per distinct (score, is_anomaly, anomaly_type); unlabelled rows left out."""
    if "is_anomaly" not in scored.columns:
        raise ValueError("evaluation needs an is_anomaly column")
    kind = "anomaly_type" if "anomaly_type" in scored.columns else F.lit(None).cast("string").alias("anomaly_type")
    return (
        scored.filter(F.col("is_anomaly").isNotNull() & F.col("score").isNotNull())
        .select("score", "is_anomaly", kind)
        .groupBy("score", "is_anomaly", "anomaly_type")
        .agg(F.count("*").alias("n"))
    )


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def confusion(counted: DataFrame, threshold: float) -> DataFrame:
    flagged, truth = F.col("score") < threshold, F.col("is_anomaly")
    return counted.agg(
        _rows_where(~truth & ~flagged).alias("tn"),
        _rows_where(~truth & flagged).alias("fp"),
        _rows_where(truth & ~flagged).alias("fn"),
        _rows_where(truth & flagged).alias("tp"),
    )


def precision(tp, fp) -> Column:
    return ratio(tp, tp + fp)


def f_score(tp, fp, fn) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)


def holdout_metrics(matrix: DataFrame) -> DataFrame:
    """Summary, precision, recall and F1 from a confusion matrix; 0 where undefined."""
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    rows = tn + fp + fn + tp
    return matrix.select(
        rows.alias("n_holdout"),
        (fn + tp).alias("n_anomalies_true"),
        (fp + tp).alias("n_anomalies_pred"),
        F.round(ratio(fn + tp, rows), 4).alias("anomaly_rate_true"),
        F.round(precision(tp, fp), 4).alias("precision"),
        F.round(precision(tp, fn), 4).alias("recall"),
        F.round(f_score(tp, fp, fn), 4).alias("f1"),
        "tn", "fp", "fn", "tp",
    )


def recall_by_type(counted: DataFrame, threshold: float) -> DataFrame:
    """One row per known type; NULL recall for a type without rows."""
    spark = counted.sparkSession
    found = counted.filter(F.col("anomaly_type").isin(*ANOMALY_TYPES)).groupBy("anomaly_type").agg(
        F.sum("n").alias("n_rows"),
        _rows_where(F.col("is_anomaly")).alias("n_true"),
        _rows_where(F.col("is_anomaly") & (F.col("score") < threshold)).alias("n_hit"),
    )
    types = spark.createDataFrame([(name,) for name in ANOMALY_TYPES], "anomaly_type string")
    recall = F.when(F.col("n_rows") > 0, F.round(ratio(F.col("n_hit"), F.col("n_true")), 4))
    return types.join(found, "anomaly_type", "left").select(
        "anomaly_type", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), recall.alias("recall")
    )


def per_type_recall(counted: DataFrame, threshold: float) -> DataFrame:
    """The same three recalls as one row of columns."""
    flagged = F.col("score") < threshold
    columns = []
    for name in ANOMALY_TYPES:
        of_type = F.col("anomaly_type") == name
        hit, true = _rows_where(of_type & F.col("is_anomaly") & flagged), _rows_where(of_type & F.col("is_anomaly"))
        columns.append(F.when(_rows_where(of_type) > 0, F.round(ratio(hit, true), 4)).alias(name))
    return counted.agg(*columns)


def by_score(counted: DataFrame, groups: list[str] | None = None) -> DataFrame:
    return counted.groupBy(*(groups or []), "score").agg(
        F.sum("n").alias("n"), _rows_where(F.col("is_anomaly")).alias("tp")
    )


def pr_curve(counted: DataFrame) -> DataFrame:
    """Precision and recall when everything scoring at or below a value is flagged.

    One row per distinct score, most anomalous first.
    """
    return running_totals(by_score(counted), "score", ["n", "tp"]).select(
        F.col("score").alias("threshold"),
        "n", "tp", "n_upto", "tp_upto",
        ratio(F.col("tp_upto"), F.col("n_upto")).alias("precision"),
        ratio(F.col("tp_upto"), F.col("tp_total")).alias("recall"),
    )


def average_precision(counted: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Step-wise area: precision at each distinct score, weighted by recall gained.

    With ``groups``, one value per group. No positives gives 0.
    """
    groups = groups or []
    totals = running_totals(by_score(counted, groups), "score", ["n", "tp"], groups)
    gained = F.sum(F.col("tp") * F.col("tp_upto") / F.col("n_upto"))
    aggregates = [ratio(gained, F.sum("tp")).alias("auprc"), F.sum("n").alias("n"), F.sum("tp").alias("positives")]
    return totals.groupBy(*groups).agg(*aggregates) if groups else totals.agg(*aggregates)


def best_threshold(curve: DataFrame, min_precision: float | None = None) -> DataFrame:
    """Operating point: the highest F1, or the highest recall at a given precision."""
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    points = curve.withColumn("f1", f1)
    goal = "f1"
    if min_precision is not None:
        points, goal = points.filter(F.col("precision") >= min_precision), "recall"
    best = F.max_by(
        F.struct("threshold", "precision", "recall", "f1"), F.struct(F.col(goal), -F.col("threshold"))
    )
    return points.agg(best.alias("best")).select("best.*")


def score_by_class(counted: DataFrame, thresholds: tuple[float, ...] = (0.0, -0.1)) -> DataFrame:
    """Centre and extremes of the score per class, and the share flagged at each threshold.

    For the normal class that share is the false-positive rate, for the
    anomalous class it is the recall.
    """
    shares = [
        ratio(_rows_where(F.col("score") < t), F.sum("n")).alias(f"share_below_{number}")
        for number, t in enumerate(thresholds)
    ]
    return counted.groupBy("is_anomaly").agg(
        F.sum("n").alias("n_rows"),
        F.min("score").alias("min_score"),
        (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_score"),
        F.max("score").alias("max_score"),
        *shares,
    )


def score_histogram(scored: DataFrame, low: float = -0.5, high: float = 0.5, bins: int = 20) -> DataFrame:
    """Rows per score bin; bin 0 and bin ``bins + 1`` hold what lies outside."""
    bin_no = F.width_bucket(F.col("score"), F.lit(low), F.lit(high), F.lit(bins)).cast("int")
    return (
        scored.groupBy(bin_no.alias("bin")).agg(F.count("*").alias("n_rows"))
        .withColumn("bin_start", F.lit(low) + (F.col("bin") - 1) * F.lit((high - low) / bins))
    )


def precision_at_k(scored: DataFrame, k: int, window: str = "1 day", drop: float = 0.1) -> DataFrame:
    """Share of true anomalies among the k worst scores of each window.

    ``has_dropped`` marks a fall of more than ``drop`` against the window before.
    Ranking keeps k rows per window and task before the shuffle.
    """
    slot = F.window("event_time", window)
    timed = scored.select(
        slot.start.alias("window_start"), slot.end.alias("window_end"), "score", "transaction_id", "is_anomaly"
    )
    worst = Window.partitionBy("window_start").orderBy("score", "transaction_id")
    ranked = timed.withColumn("place", F.row_number().over(worst)).filter(F.col("place") <= k)
    per_window = ranked.groupBy("window_start", "window_end").agg(
        F.count("*").alias("n_ranked"),
        F.avg(F.coalesce("is_anomaly", F.lit(False)).cast("double")).alias("precision_at_k"),
    )
    fallen = F.col("previous") - F.col("precision_at_k") > drop
    return _with_previous(per_window, "precision_at_k").withColumn("has_dropped", F.coalesce(fallen, F.lit(False)))


def _with_previous(per_window: DataFrame, value: str) -> DataFrame:
    """Add the value of the adjoining earlier window as ``previous``.

    Each window hands its value to the window that starts where it ends, so no
    global sort and no self-join is needed.
    """
    now = F.struct("window_start", F.col("n_ranked"), F.col(value).alias("now"), F.lit(None).cast("double").alias("before"))
    later = F.struct(
        F.col("window_end").alias("window_start"), F.lit(None).cast("long").alias("n_ranked"),
        F.lit(None).cast("double").alias("now"), F.col(value).alias("before"),
    )
    handed = per_window.select(F.inline(F.array(now, later)))
    return (
        handed.groupBy("window_start")
        .agg(F.max("n_ranked").alias("n_ranked"), F.max("now").alias(value), F.max("before").alias("previous"))
        .filter(F.col("n_ranked").isNotNull())
    )


def rolling_auprc(scored: DataFrame, window: str = "1 day", bound: float = 0.5) -> DataFrame:
    """Average precision per window and whether it calls for a retrain."""
    counted = (
        scored.filter(F.col("is_anomaly").isNotNull())
        .groupBy(F.window("event_time", window).start.alias("window_start"), "score", "is_anomaly")
        .agg(F.count("*").alias("n"))
    )
    return average_precision(counted, ["window_start"]).withColumn("needs_retrain", F.col("auprc") < bound)
