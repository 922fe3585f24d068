"""On-demand scoring of requests."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from txnwatch.operators import quality
from txnwatch.operators.scoring import Model, score_batch
from txnwatch.schemas import ALERT_THRESHOLD


def score_requests(
    requests: DataFrame, model: Model, threshold: float = ALERT_THRESHOLD, now: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects) for a table of scoring requests.

    Missing user, country and time take their defaults. An answer has the score
    to six places, the flag, the threshold and the inputs it was computed from.
    """
    checked = quality.check(requests, quality.request_rules(requests.columns))
    filled = quality.with_defaults(quality.valid(checked), now or datetime.now(timezone.utc))
    scored = score_batch(filled, model)
    inputs = [name for name in requests.columns if name not in
              ("amount", "merchant_category", "country", "user_id", "timestamp", "hour")]
    answers = scored.select(
        *inputs,
        F.round("score", 6).alias("score"),
        (F.col("score") < threshold).alias("is_anomaly"),
        F.lit(threshold).alias("threshold"),
        F.struct("amount", "merchant_category", "country", "user_id", "timestamp").alias("features"),
    )
    return answers, quality.rejects(checked)
