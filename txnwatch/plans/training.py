"""Batch jobs: train, evaluate, retrain."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.functions.scalar import ratio, to_iso
from txnwatch.operators import evaluation as ev
from txnwatch.operators.features import FeatureState, fit_features, transform
from txnwatch.operators.forest import effective_sample, fit_forest
from txnwatch.operators.ordering import quantile, value_at
from txnwatch.operators.scoring import Model, add_raw_score, save_model, score_batch
from txnwatch.operators.statistics import DailyStatistics
from txnwatch.schemas import (
    ANOMALY_TYPES, AUTO_OFFSET, CONTAMINATION, EVALUATION_THRESHOLD, FEATURES, METRICS, N_TREES, SEED,
)
from txnwatch.session import materialize, require_utc
from txnwatch.sources.tables import write_document

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def fit(
    df: DataFrame,
    contamination: float | str = CONTAMINATION,
    n_trees: int = N_TREES,
    seed: int = SEED,
    row_key: str = "transaction_id",
    known: tuple[FeatureState, int] | None = None,
) -> tuple[Model, DataFrame]:
    """A calibrated model, and the counts of raw scores on the data it was fitted to.

    The data is scanned four times: twice for the feature statistics, once for
    the tree samples and once for calibration. The last scan shrinks to one row
    per distinct raw score, from which the offset is an exact quantile.

    ``known`` are the statistics of ``df`` where they are kept already, with the number of
    amounts they rest on; the first two scans are then left out, and statistics that
    rest on other rows than were scored are refused.
    """
    require_utc(df.sparkSession)
    state, n_amounts = known or (fit_features(df), None)
    features = transform(df, state)
    sub_sample = effective_sample(state.n_rows)
    nodes = materialize(fit_forest(features, state.n_rows, n_trees, sub_sample, seed, row_key), "forest")
    model = Model(state, nodes, n_trees, sub_sample, AUTO_OFFSET, str(contamination), seed)
    raw = add_raw_score(features, model.raw_score).filter(F.col("raw").isNotNull())
    counted = materialize(raw.groupBy("raw").agg(F.count("*").alias("n")), "raw-scores")
    if n_amounts is not None:
        n_scored = counted.agg(F.sum("n")).first()[0] or 0
        if n_scored != n_amounts:
            raise ValueError(f"the statistics rest on {n_amounts} amounts, the rows hold {n_scored}; add what is missing")
    if contamination != "auto":
        model.offset = quantile(counted, "raw", contamination)
    return model, counted


def training_summary(df: DataFrame, model: Model, counted: DataFrame, trained_at: datetime) -> DataFrame:
    """One row describing a training run."""
    flagged = F.sum(F.when(F.col("raw") - F.lit(model.offset) < 0, F.col("n")))
    rate = counted.agg(F.round(ratio(flagged, F.sum("n")), 4).alias("rate")).first()["rate"]
    labelled = F.count_if("is_anomaly") if "is_anomaly" in df.columns else F.lit(None).cast("long")
    # two columns at most are read for this
    return df.agg(F.count("*").alias("n_records"), labelled.alias("n_anomalies_in_training")).select(
        F.lit(trained_at).alias("trained_at"),
        "n_records",
        "n_anomalies_in_training",
        F.lit(model.contamination).alias("contamination"),
        F.lit(model.n_trees).alias("n_estimators"),
        F.lit(rate).alias("flagged_rate_training"),
        F.array(*[F.lit(name) for name in FEATURES]).alias("features"),
    )


def train(
    df: DataFrame,
    root: str,
    contamination: float | str = CONTAMINATION,
    n_trees: int = N_TREES,
    seed: int = SEED,
    trained_at: datetime | None = None,
    known: tuple[FeatureState, int] | None = None,
) -> Model:
    """Fit, store as a new version under ``root``, and write the summary beside it."""
    model, counted = fit(df, contamination, n_trees, seed, known=known)
    model.version = save_model(model, root)
    summary = training_summary(df, model, counted, trained_at or datetime.now(timezone.utc))
    write_document(summary, f"{root}/training_summary/version={model.version}")
    return model


def metrics_document(counted: DataFrame, threshold: float, evaluated_at: datetime) -> DataFrame:
    """All metrics of one evaluation as a single nested row, from a profile."""
    matrix, recalls = ev.confusion(counted, threshold), ev.per_type_recall(counted, threshold)
    area = ev.average_precision(counted).select(F.round("auprc", 4)).scalar()
    flat = ev.holdout_metrics(matrix)
    recall_row = recalls.select(F.struct(*ANOMALY_TYPES)).scalar()
    document = flat.select(
        F.lit(threshold).alias("threshold"),
        "n_holdout", "n_anomalies_true", "n_anomalies_pred", "anomaly_rate_true",
        "precision", "recall", "f1",
        area.alias("auprc"),
        F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"),
        recall_row.alias("per_type_recall"),
        F.lit(evaluated_at).cast("timestamp").alias("evaluated_at"),
    )
    return document.select(*METRICS.names)


def evaluate(
    holdout: DataFrame,
    model: Model,
    threshold: float = EVALUATION_THRESHOLD,
    path: str | None = None,
    evaluated_at: datetime | None = None,
) -> DataFrame:
    """Score a labelled holdout once and report on it; written to ``path`` if given."""
    if "is_anomaly" not in holdout.columns:
        raise ValueError("evaluation needs an is_anomaly column")
    counted = materialize(ev.profile(score_batch(holdout, model)), "profile")
    document = metrics_document(counted, threshold, evaluated_at or datetime.now(timezone.utc))
    if path:
        write_document(document, path)
    return document


def stored_as_transactions(stored: DataFrame) -> DataFrame:
    """Stored rows in the shape training reads, with the event time kept."""
    return stored.select(
        "transaction_id", "user_id", F.col("amount").cast("double").alias("amount"), "merchant_category",
        to_iso(F.col("event_time")).alias("timestamp"), "country",
        F.col("ground_truth").alias("is_anomaly"), "anomaly_type", "event_time",
    )


def evaluate_stored(stored: DataFrame) -> DataFrame:
    """Quality of the stored flags against the stored truth; unlabelled rows left out."""
    truth, flagged = F.col("ground_truth"), F.col("is_flagged")
    matrix = stored.filter(truth.isNotNull()).agg(
        F.count_if(~truth & ~flagged).alias("tn"),
        F.count_if(~truth & flagged).alias("fp"),
        F.count_if(truth & ~flagged).alias("fn"),
        F.count_if(truth & flagged).alias("tp"),
    )
    return ev.holdout_metrics(matrix)


def _instant_of_latest(df: DataFrame, n: int, time: str) -> int | None:
    """Microseconds of the ``n``-th row from the end; none if there are no more than ``n`` rows with a time.

    Counting per instant first leaves one row per instant to rank.
    """
    if n < 1:
        raise ValueError("n must be positive")
    counted = df.filter(F.col(time).isNotNull()).groupBy(F.unix_micros(F.col(time)).alias("at")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    return None if total <= n else value_at(counted, "at", total - n)


def latest_rows(df: DataFrame, n: int, time: str = "event_time") -> DataFrame:
    """The last ``n`` rows by time, plus any that tie with the earliest of them; rows without a time are left out."""
    earliest = _instant_of_latest(df, n, time)
    df = df.filter(F.col(time).isNotNull())
    return df if earliest is None else df.filter(F.unix_micros(F.col(time)) >= F.lit(earliest))


def retrain(
    transactions: DataFrame,
    root: str,
    last_n: int | None = None,
    since: datetime | None = None,
    statistics: DailyStatistics | None = None,
    **kwargs,
) -> Model:
    """Refit on recent rows only and publish the next version.

    Streams that hold a :class:`CurrentModel` take it up with their next batch.

    ``statistics``, to which every row of ``transactions`` was added, save the scans for
    the feature statistics but for the day that is cut; with ``last_n`` they also tell
    from which day on rows need to be looked at.
    """
    recent = transactions
    if statistics is not None:
        return _retrain_from(statistics, transactions, root, last_n, since, **kwargs)
    if since is not None:
        recent = recent.filter(F.col("event_time") > F.lit(since))
    if last_n is not None:
        recent = latest_rows(recent, last_n)
    return train(recent, root, **kwargs)


def _retrain_from(statistics: DailyStatistics, transactions: DataFrame, root: str, last_n, since, **kwargs) -> Model:
    first = None
    if since is not None:
        first = (since.replace(tzinfo=timezone.utc) if since.tzinfo is None else since) + timedelta(microseconds=1)
    if last_n is not None:
        if last_n < 1:
            raise ValueError("n must be positive")
        day = statistics.day_holding_last(last_n)
        if day is not None:
            midnight = EPOCH + timedelta(days=day)
            earliest = _instant_of_latest(transactions.filter(F.col("event_time") >= F.lit(midnight)), last_n, "event_time")
            start = midnight if earliest is None else EPOCH + timedelta(microseconds=earliest)
            first = start if first is None else max(first, start)
    recent = transactions.filter(F.col("event_time").isNotNull())
    if first is not None:
        recent = recent.filter(F.col("event_time") >= F.lit(first))
    return train(recent, root, known=statistics.state_since(recent, first), **kwargs)
