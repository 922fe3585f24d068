"""Queries over the sample tables, each beside the SQL that checks it.

The SQL runs on another engine. Where a query needs randomness it therefore uses
MD5-based draws, and where it needs a score it uses either a small fixed forest
or a score that follows from the amount alone.
"""

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.functions import scalar as fn
from txnwatch.operators import evaluation as ev, forest as iforest, quality, reports, velocity as speed
from txnwatch.operators.features import (
    category_moments, fit_features, home_countries, merchant_frequency, overall_statistics, transform,
)
from txnwatch.operators.inject import assigned_home, inject_anomalies, injection_rate, label_counts
from txnwatch.operators.ordering import quantile
from txnwatch.operators.scoring import Model, add_raw_score, flag, load_model, save_model, score_batch
from txnwatch.operators.statistics import DailyStatistics
from txnwatch.plans import serving, training
from txnwatch.schemas import (
    CONTAMINATION, FAR_COUNTRIES, FEATURES, FOREST_NODE, HOME_COUNTRIES, ODD_HOURS, REQUEST, SPIKE_RANGE, TRANSACTION,
)
from txnwatch.session import scratch_path
from txnwatch.sources.adapters import events_as_transactions, purchases_by_country, stream_closed_events, stream_events, table
from txnwatch.sources.streams import decode, identified, read_files, with_lag
from txnwatch.sources.tables import (
    read_metrics, read_stored_alerts, read_stored_transactions, read_transactions, to_message, write_document,
)
from txnwatch.streaming import pipeline, stateful
from txnwatch.streaming.sinks import (
    ScoringSink, as_alert_messages, as_alerts, as_stored_transactions, first_of_each, suppress_known,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

AS_OF = datetime(2024, 1, 15, tzinfo=timezone.utc)
FIXED_TIME = datetime(2024, 2, 1, tzinfo=timezone.utc)
DAY_MINUTES = 1440


def query(sql: str | None = None):
    """Register a query under its own name, with its check where SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


# --- shared inputs -----------------------------------------------------------

TX = """
tx AS (
  SELECT CAST(e.event_id AS VARCHAR) AS transaction_id, 'u_' || e.user_id AS user_id, e.value AS amount,
         e.event_type AS merchant_category, strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
         n.n_name AS country, date_trunc('second', e.ts) AS at
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""


def _u(name: str) -> str:
    return f"(CAST('0x' || substr(md5(transaction_id || '|{name}'), 1, 8) AS BIGINT) / 4294967296.0)"


LABELLED = TX + f""",
kinds AS (
  SELECT *, CASE WHEN {_u('select')} < 0.025
              THEN ['amount_spike', 'geo_jump', 'odd_hour_burst'][CAST(floor({_u('type')} * 3) AS INT) + 1] END AS kind
  FROM tx
),
labelled AS (
  SELECT transaction_id, user_id,
         CASE WHEN kind = 'amount_spike' THEN round(amount * (10 + 40 * {_u('multiplier')}), 2) ELSE amount END AS amount,
         merchant_category,
         CASE WHEN kind = 'odd_hour_burst' THEN
              substr("timestamp", 1, 11) || lpad(CAST(2 + CAST(floor({_u('hour')} * 3) AS INT) AS VARCHAR), 2, '0')
              || ':' || lpad(CAST(CAST(floor({_u('minute')} * 60) AS INT) AS VARCHAR), 2, '0')
              || ':' || lpad(CAST(CAST(floor({_u('second')} * 60) AS INT) AS VARCHAR), 2, '0') || 'Z'
              ELSE "timestamp" END AS "timestamp",
         CASE WHEN kind = 'geo_jump' THEN ['JP', 'SG', 'AU', 'ZA'][CAST(floor({_u('country')} * 4) AS INT) + 1]
              ELSE country END AS country,
         kind IS NOT NULL AS is_anomaly, kind AS anomaly_type
  FROM kinds
)"""

STORED = LABELLED + """,
st AS (SELECT avg(ln(1 + amount)) AS m, greatest(coalesce(stddev_samp(ln(1 + amount)), 0), 1e-6) AS s FROM labelled),
stored AS (
  SELECT l.*, CAST(replace(replace("timestamp", 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_time,
         round(0.2 - abs((ln(1 + amount) - st.m) / st.s) / 10, 6) AS score
  FROM labelled l CROSS JOIN st
),
flagged AS (SELECT *, score < 0 AS is_flagged FROM stored),
alerts AS (SELECT * FROM flagged WHERE is_flagged)"""


def _iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%SZ')"


def md5_draws(key: str = "transaction_id"):
    def draw(name: str):
        digits = F.substring(F.md5(F.concat(F.col(key), F.lit(f"|{name}"))), 1, 8)
        return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)

    return draw


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject_anomalies(events_as_transactions(spark, sf_dir), draw=md5_draws())


def amount_scored(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Labelled transactions with a score that falls as the amount gets unusual."""
    fitted_on = labelled(spark, sf_dir)
    rows = fitted_on if rows is None else rows
    overall = overall_statistics(category_moments(fitted_on)).first()
    z = fn.zscore(F.log1p("amount"), overall["amount_mean"], overall["amount_std"])
    scored = rows.withColumn("score", F.round(0.2 - F.abs(z) / 10, 6))
    return flag(scored, 0.0).withColumn("event_time", fn.to_event_time())


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as the transactions table holds them, processed when they happened."""
    rows = as_stored_transactions(amount_scored(spark, sf_dir), FIXED_TIME)
    return rows.withColumn("processed_at", F.col("event_time"))


def with_iso(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: fn.to_iso(F.col(name)) for name in columns})


# --- scan, decode, validate --------------------------------------------------

@query("WITH " + TX + """
SELECT transaction_id, user_id, amount, merchant_category, "timestamp", country FROM tx""")
def canonical_events(spark, sf_dir):
    return events_as_transactions(spark, sf_dir).drop("is_anomaly", "anomaly_type")


def _messages(rows: DataFrame) -> DataFrame:
    """Events as JSON text, one kind of damage per event type and hour."""
    text = fn.json_message(TRANSACTION.names)
    hour = fn.hour_of()
    damaged = (
        F.when(hour == 1, F.lit("{bad"))
        .when(hour == 2, F.regexp_replace(text, r"^\{", '{"extra":1,'))
        .when(hour == 3, F.regexp_replace(text, r'"amount":[0-9.]+', '"amount":"abc"'))
        .when(hour == 4, F.regexp_replace(text, r'"transaction_id":"[0-9]+",', ""))
        .when(hour == 5, F.regexp_replace(text, r'"amount":', '"amount":-'))
        .when(hour == 6, F.regexp_replace(text, r'"timestamp":"[^"]*"', '"timestamp":"soon"'))
        .otherwise(text)
    )
    return rows.select(damaged.alias("value"))


DAMAGED = TX + """,
d AS (SELECT *, CAST(substr("timestamp", 12, 2) AS INT) AS h FROM tx)"""


@query("WITH " + DAMAGED + """
SELECT transaction_id, user_id, CASE WHEN h = 3 THEN NULL WHEN h = 5 THEN -amount ELSE amount END AS amount,
       merchant_category, CASE WHEN h = 6 THEN 'soon' ELSE "timestamp" END AS "timestamp", country
FROM d WHERE h NOT IN (1, 4)""")
def json_decode(spark, sf_dir):
    messages = _messages(events_as_transactions(spark, sf_dir))
    return identified(decode(messages)).drop("is_anomaly", "anomaly_type", "ingest_ts")


@query("WITH " + DAMAGED + """,
broken AS (
  SELECT unnest(CASE h WHEN 1 THEN ['missing_transaction_id', 'missing_user_id', 'missing_amount',
                                    'missing_merchant_category', 'missing_country', 'bad_timestamp']
                       WHEN 3 THEN ['missing_amount'] WHEN 4 THEN ['missing_transaction_id']
                       WHEN 5 THEN CASE WHEN amount >= 1 THEN ['amount_not_scorable'] ELSE [] END WHEN 6 THEN ['bad_timestamp'] ELSE [] END) AS reason FROM d)
SELECT reason, count(*) AS n_rows FROM broken GROUP BY reason""")
def rejects_by_reason(spark, sf_dir):
    decoded = decode(_messages(events_as_transactions(spark, sf_dir)))
    return quality.rejects_by_reason(decoded, quality.stream_rules())


@query("WITH " + TX + """
SELECT count(*) AS n_rows, count(DISTINCT transaction_id) AS n_distinct_keys,
       (SELECT count(*) FROM (SELECT transaction_id FROM tx GROUP BY 1 HAVING count(*) > 1)) AS n_duplicated_keys,
       count(*) FILTER (WHERE amount IS NOT NULL AND country IS NOT NULL AND merchant_category IS NOT NULL
                          AND user_id IS NOT NULL AND "timestamp" IS NOT NULL) AS n_complete,
       count(*) FILTER (WHERE amount > 0) AS n_positive_amount,
       count(*) FILTER (WHERE regexp_matches("timestamp", '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}Z$')) AS n_iso_timestamp,
       count(*) FILTER (WHERE merchant_category IN ('view', 'click', 'purchase')) AS n_known_category,
       CAST(0 AS BIGINT) AS n_labelled
FROM tx""")
def quality_summary(spark, sf_dir):
    return quality.quality_summary(events_as_transactions(spark, sf_dir), ["view", "click", "purchase"])


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests with gaps and errors that follow from the event type."""
    rows = events_as_transactions(spark, sf_dir)
    kind, hour = F.col("merchant_category"), fn.hour_of()
    return rows.select(
        F.col("transaction_id").alias("request_id"),
        F.when(hour == 0, None).when(hour == 1, -F.col("amount")).otherwise(F.col("amount")).alias("amount"),
        F.when(hour != 2, kind).alias("merchant_category"),
        F.when(kind == "view", "").when(kind != "click", F.col("timestamp")).alias("timestamp"),
        F.when(kind == "purchase", hour + 1).alias("hour"),
        F.when(kind != "signup", F.col("user_id")).alias("user_id"),
        F.when(kind != "error", F.col("country")).alias("country"),
    ).select("request_id", *REQUEST.names)


REQUESTS = TX + """,
r AS (
  SELECT transaction_id AS request_id, CAST(substr("timestamp", 12, 2) AS INT) AS h, merchant_category AS kind, *
  FROM tx
)"""


@query("WITH " + REQUESTS + """
SELECT request_id, amount, merchant_category,
       CASE WHEN kind IN ('view', 'click') THEN '2024-01-15T00:00:00Z' ELSE "timestamp" END AS "timestamp",
       CASE WHEN kind = 'purchase' THEN h + 1 END AS hour,
       CASE WHEN kind = 'signup' THEN 'u_0000' ELSE user_id END AS user_id,
       CASE WHEN kind = 'error' THEN 'US' ELSE country END AS country
FROM r WHERE h NOT IN (0, 1, 2) AND amount > 0 AND NOT (kind = 'purchase' AND h = 23)""")
def accepted_requests(spark, sf_dir):
    requests = _requests(spark, sf_dir)
    checked = quality.check(requests, quality.request_rules(requests.columns))
    return quality.with_defaults(quality.valid(checked), AS_OF)


@query("WITH " + REQUESTS + """,
broken AS (
  SELECT unnest([CASE WHEN h = 0 THEN 'missing_amount' WHEN h = 1 OR amount <= 0 THEN 'amount_not_positive' END,
                 CASE WHEN h = 2 THEN 'missing_merchant_category' END,
                 CASE WHEN kind = 'purchase' AND h = 23 THEN 'hour_out_of_range' END]) AS reason FROM r)
SELECT reason, count(*) AS n_rows FROM broken WHERE reason IS NOT NULL GROUP BY reason""")
def rejected_requests(spark, sf_dir):
    requests = _requests(spark, sf_dir)
    return quality.rejects_by_reason(requests, quality.request_rules(requests.columns))


@query("""
SELECT CAST(event_id AS VARCHAR) AS transaction_id,
       CASE event_type WHEN 'click' THEN TRUE WHEN 'purchase' THEN FALSE WHEN 'signup' THEN FALSE END AS is_anomaly
FROM events""")
def label_states(spark, sf_dir):
    kind = F.col("event_type")
    number = F.when(kind == "click", 1.0).when(kind.isin("purchase", "signup"), 0.0).when(kind == "error", float("nan"))
    rows = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("transaction_id"), number.alias("is_anomaly"))
    return quality.normalize_labels(rows)


@query("""
SELECT CAST(event_id AS VARCHAR) AS transaction_id, item FROM (
  SELECT event_id, unnest(list_filter(list_transform(string_split(event_type || ' , ,' || user_id, ','),
                                                     lambda x: trim(x)), lambda x: x <> '')) AS item FROM events)""")
def split_lists(spark, sf_dir):
    text = F.concat("event_type", F.lit(" , ,"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"), F.explode(fn.split_list(text)).alias("item")
    )


@query("WITH " + LABELLED + """
SELECT user_id AS "key",
  '{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"merchant_category":"' || merchant_category || '","timestamp":"' || "timestamp" || '","country":"' || country
  || '","is_anomaly":' || CASE WHEN is_anomaly THEN 'true' ELSE 'false' END
  || ',"anomaly_type":' || coalesce('"' || anomaly_type || '"', 'null') || '}' AS "value"
FROM labelled""")
def transaction_messages(spark, sf_dir):
    return to_message(labelled(spark, sf_dir), "user_id", TRANSACTION.names)


# --- labelled anomalies ------------------------------------------------------

@query("WITH " + LABELLED + " SELECT * FROM labelled")
def inject_labels(spark, sf_dir):
    return labelled(spark, sf_dir)


@query("WITH " + LABELLED + """
SELECT count(*) AS sent, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       round(100.0 * count(*) FILTER (WHERE is_anomaly) / count(*), 2) AS observed_rate_pct FROM labelled""")
def observed_injection_rate(spark, sf_dir):
    return injection_rate(labelled(spark, sf_dir))


@query("WITH " + LABELLED + " SELECT is_anomaly, count(*) AS n FROM labelled GROUP BY is_anomaly")
def injected_label_counts(spark, sf_dir):
    return label_counts(labelled(spark, sf_dir))


@query("WITH " + LABELLED + """
SELECT transaction_id, user_id, amount, merchant_category, "timestamp", country FROM labelled""")
def public_transactions(spark, sf_dir):
    return quality.strip_labels(labelled(spark, sf_dir))


@query("""SELECT count(*) AS n_rows, TRUE AS rate_is_near, CAST(0 AS BIGINT) AS unlabelled_changes, CAST(0 AS BIGINT) AS spikes_out_of_range,
       CAST(0 AS BIGINT) AS jumps_not_far, CAST(0 AS BIGINT) AS bursts_at_other_hours, CAST(3 AS BIGINT) AS n_types FROM events""")
def hashed_injection(spark, sf_dir):
    """Spark's own hash has no SQL counterpart; what every choice of rows must satisfy has."""
    before = events_as_transactions(spark, sf_dir).withColumns({
        "amount_before": F.col("amount"), "country_before": F.col("country"), "timestamp_before": F.col("timestamp")})
    after, kind, same = inject_anomalies(before), F.col("anomaly_type"), lambda c: F.col(c).eqNullSafe(F.col(f"{c}_before"))
    # amounts of zero have no multiple, those below zero turn the bounds round
    bounds = [F.col("amount_before") * factor for factor in SPIKE_RANGE]
    in_range = F.col("amount").between(F.least(*bounds) - 0.01, F.greatest(*bounds) + 0.01)
    first, last = ODD_HOURS
    return after.agg(
        F.count("*").alias("n_rows"),
        (F.abs(F.avg(kind.isNotNull().cast("double")) - CONTAMINATION) < 0.02).alias("rate_is_near"),
        F.count_if(kind.isNull() & ~(same("amount") & same("country") & same("timestamp"))).alias("unlabelled_changes"),
        F.count_if((kind == "amount_spike") & ~in_range).alias("spikes_out_of_range"),
        F.count_if((kind == "geo_jump") & ~F.col("country").isin(*FAR_COUNTRIES)).alias("jumps_not_far"),
        F.count_if((kind == "odd_hour_burst") & ~fn.hour_of().between(first, last)).alias("bursts_at_other_hours"),
        F.count_distinct(kind).alias("n_types"),
    )


@query("WITH " + TX + """
SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, CAST(0 AS BIGINT) AS users_with_several_homes,
       TRUE AS homes_are_known FROM tx""")
def assigned_homes(spark, sf_dir):
    rows = events_as_transactions(spark, sf_dir).withColumn("home", assigned_home())
    per_user = rows.groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_distinct("home").alias("homes"), F.min(F.col("home").isin(*HOME_COUNTRIES)).alias("known"))
    return per_user.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_users"), F.count_if(F.col("homes") != 1).alias("users_with_several_homes"),
        F.min("known").alias("homes_are_known"))


@query("WITH " + TX + """
SELECT transaction_id, CAST(3 + CAST(transaction_id AS BIGINT) % 7 AS DOUBLE) AS lag_seconds FROM tx""")
def ingest_lag(spark, sf_dir):
    """The broker time of each message is put a few seconds after its event."""
    rows = timed(spark, sf_dir)
    late = F.col("event_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), 3 + F.col("transaction_id").cast("long") % 7)
    messages = rows.select(fn.json_message(TRANSACTION.names).alias("value"), late.alias("timestamp"))
    return with_lag(decode(messages)).select("transaction_id", "lag_seconds")


# --- features ----------------------------------------------------------------

@query("WITH " + LABELLED + """
SELECT round(avg(ln(1 + amount)), 6) AS amount_mean,
       round(greatest(coalesce(stddev_samp(ln(1 + amount)), 0), 1e-6), 6) AS amount_std,
       (SELECT round(min(n) * 1.0 / sum(n), 6) FROM
          (SELECT count(*) AS n FROM labelled WHERE merchant_category IS NOT NULL GROUP BY merchant_category)) AS merchant_freq_fallback,
       count(*) AS n_rows
FROM labelled""")
def feature_stats(spark, sf_dir):
    return overall_statistics(category_moments(labelled(spark, sf_dir))).select(
        F.round("amount_mean", 6).alias("amount_mean"),
        F.round("amount_std", 6).alias("amount_std"),
        F.round("merchant_freq_fallback", 6).alias("merchant_freq_fallback"),
        "n_rows",
    )


@query("WITH " + LABELLED + """
SELECT merchant_category, round(count(*) * 1.0 / (SELECT count(merchant_category) FROM labelled), 6) AS freq
FROM labelled WHERE merchant_category IS NOT NULL GROUP BY merchant_category""")
def merchant_frequencies(spark, sf_dir):
    moments = category_moments(labelled(spark, sf_dir))
    total = overall_statistics(moments).first()["n_categorised"]
    return merchant_frequency(moments, total).select("merchant_category", F.round("freq", 6).alias("freq"))


HOMES = """
SELECT user_id, country AS home_country, CAST(total AS BIGINT) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, country) AS place,
         sum(c) OVER (PARTITION BY user_id) AS total FROM counts) WHERE place = 1"""


@query("""WITH counts AS (
  SELECT 'u_' || o_custkey AS user_id, n_name AS country, count(*) AS c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)""" + HOMES)
def buyer_home_country(spark, sf_dir):
    return home_countries(purchases_by_country(spark, sf_dir))


@query("WITH " + LABELLED + """,
counts AS (SELECT user_id, country, count(*) AS c FROM labelled
           WHERE NOT is_anomaly AND user_id IS NOT NULL AND country IS NOT NULL GROUP BY 1, 2)""" + HOMES)
def user_home_country(spark, sf_dir):
    return home_countries(labelled(spark, sf_dir))


FEATURED = STORED + """,
freqs AS (SELECT merchant_category, count(*) * 1.0 / (SELECT count(merchant_category) FROM labelled) AS freq
          FROM labelled WHERE merchant_category IS NOT NULL GROUP BY merchant_category),
homes AS (
  SELECT user_id, country AS home FROM (
    SELECT user_id, country, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, country) AS place
    FROM labelled WHERE NOT is_anomaly AND country IS NOT NULL GROUP BY user_id, country) WHERE place = 1),
featured AS (
  SELECT l.*, CAST((ln(1 + amount) - st.m) / st.s AS FLOAT) AS amount_log_zscore,
         CAST(sin(coalesce(TRY_CAST(substr("timestamp", 12, 2) AS INT), 12) * (2 * pi()) / 24) AS FLOAT) AS hour_sin,
         CAST(cos(coalesce(TRY_CAST(substr("timestamp", 12, 2) AS INT), 12) * (2 * pi()) / 24) AS FLOAT) AS hour_cos,
         CAST(coalesce(f.freq, (SELECT min(freq) FROM freqs)) AS FLOAT) AS merchant_freq,
         CAST(coalesce(coalesce(h.home, '') = l.country, FALSE) AS FLOAT) AS is_home_country
  FROM labelled l CROSS JOIN st LEFT JOIN freqs f USING (merchant_category) LEFT JOIN homes h USING (user_id)
)"""


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(F.col(name).cast("double"), places) for name in columns})


@query("WITH " + FEATURED + " SELECT transaction_id, " + ", ".join(
    f"round(CAST({name} AS DOUBLE), 5) AS {name}" for name in FEATURES) + " FROM featured")
def feature_matrix(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    features = transform(rows, fit_features(rows)).select("transaction_id", *FEATURES)
    return _rounded(features, *FEATURES, places=5)


# A three-tree forest small enough to write down: tree, node, left, right,
# feature, split, size, depth.
FIXED_FOREST = [
    (0, 0, 1, 2, 0, 1.5, 256, 0), (0, 1, -1, -1, -1, None, 200, 1), (0, 2, 3, 4, 4, 0.5, 56, 1),
    (0, 3, -1, -1, -1, None, 3, 2), (0, 4, -1, -1, -1, None, 53, 2),
    (1, 0, 1, 2, 1, 0.25, 256, 0), (1, 1, 3, 4, 0, -0.75, 150, 1), (1, 2, 5, 6, 2, 0.1, 106, 1),
    (1, 3, -1, -1, -1, None, 30, 2), (1, 4, -1, -1, -1, None, 120, 2),
    (1, 5, -1, -1, -1, None, 1, 2), (1, 6, -1, -1, -1, None, 105, 2),
    (2, 0, 1, 2, 3, 0.2001, 256, 0), (2, 1, -1, -1, -1, None, 128, 1), (2, 2, 3, 4, 0, 2.75, 128, 1),
    (2, 3, -1, -1, -1, None, 127, 2), (2, 4, -1, -1, -1, None, 1, 2),
]


def _c(n: int) -> str:
    return "0.0" if n < 2 else f"(2 * (ln({n} - 1) + 0.5772156649) - 2 * ({n} - 1.0) / {n})"


FOREST_SCORED = FEATURED + f""",
paths AS (
  SELECT *,
    CASE WHEN amount_log_zscore <= 1.5 THEN 1 + {_c(200)} WHEN is_home_country <= 0.5 THEN 2 + {_c(3)} ELSE 2 + {_c(53)} END
    + CASE WHEN hour_sin <= 0.25 THEN CASE WHEN amount_log_zscore <= -0.75 THEN 2 + {_c(30)} ELSE 2 + {_c(120)} END
           WHEN hour_cos <= 0.1 THEN 2 + {_c(1)} ELSE 2 + {_c(105)} END
    + CASE WHEN merchant_freq <= 0.2001 THEN 1 + {_c(128)} WHEN amount_log_zscore <= 2.75 THEN 2 + {_c(127)}
           ELSE 2 + {_c(1)} END AS total
  FROM featured
),
forest AS (SELECT *, -pow(2, -(total / 3) / {_c(256)}) + 0.5 AS score FROM paths)"""


def fixed_model(spark: SparkSession, rows: DataFrame) -> Model:
    nodes = spark.createDataFrame(FIXED_FOREST, FOREST_NODE)
    return Model(fit_features(rows), nodes, 3, 256, -0.5, "auto", 0)


@query("WITH " + FOREST_SCORED + """
SELECT transaction_id, round(score, 6) AS score, score < -0.1 AS is_flagged,
       CASE WHEN score < 0 THEN -1 ELSE 1 END AS predicted FROM forest""")
def fixed_forest_score(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    scored = flag(score_batch(rows, fixed_model(spark, rows)), -0.1)
    return scored.select(
        "transaction_id", F.round("score", 6).alias("score"), "is_flagged",
        iforest.predicted_class(F.col("score")).alias("predicted"),
    )


@query("WITH " + FOREST_SCORED + " SELECT transaction_id, round(score - 0.5, 6) AS raw FROM forest")
def sql_registered_score(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    model = fixed_model(spark, rows)
    spark.udf.register("anomaly_score", model.raw_score)
    features = transform(rows, model.state)
    return features.selectExpr("transaction_id", f"round(anomaly_score({', '.join(FEATURES)}), 6) AS raw")


@query("WITH " + FOREST_SCORED + f"""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE score < -0.1) AS n_flagged, round(min(score), 6) AS min_score FROM forest""")
def batch_metrics(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return flag(score_batch(rows, fixed_model(spark, rows)), -0.1).agg(
        F.count("*").alias("n_rows"), F.count_if("is_flagged").alias("n_flagged"), F.round(F.min("score"), 6).alias("min_score")
    )


# --- stored tables and alerts ------------------------------------------------

@query("WITH " + STORED + f"""
SELECT transaction_id, user_id, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount, merchant_category,
       {_iso('event_time')} AS event_time, country, score, is_flagged, is_anomaly AS ground_truth, anomaly_type
FROM flagged""")
def stored_transactions(spark, sf_dir):
    rows = stored(spark, sf_dir).drop("processed_at").withColumn("amount", F.col("amount").cast("double"))
    return with_iso(rows, "event_time")


@query("WITH " + STORED + f"""
SELECT transaction_id, user_id, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount, merchant_category,
       {_iso('event_time')} AS event_time, country, score, anomaly_type, {_iso('event_time')} AS alerted_at
FROM alerts""")
def flagged_alerts(spark, sf_dir):
    rows = as_alerts(stored(spark, sf_dir)).withColumn("amount", F.col("amount").cast("double"))
    return with_iso(rows, "event_time", "alerted_at")


@query("WITH " + STORED + """
SELECT transaction_id AS "key",
  '{"transaction_id":"' || transaction_id || '","user_id":"' || user_id || '","amount":' || CAST(amount AS VARCHAR)
  || ',"merchant_category":"' || merchant_category || '","timestamp":"' || "timestamp" || '","country":"' || country
  || '","score":' || CAST(round(score, 2) + 0.0 AS VARCHAR) || ',"anomaly_type":' || coalesce('"' || anomaly_type || '"', 'null') || '}' AS "value"
FROM alerts""")
def alert_messages(spark, sf_dir):
    rows = amount_scored(spark, sf_dir).filter("is_flagged")
    return as_alert_messages(rows.withColumn("score", F.round("score", 2)))


@query("WITH " + STORED + ' SELECT transaction_id AS "key", score FROM alerts')
def alert_message_scores(spark, sf_dir):
    """The score as the messages carry it, with all its digits."""
    sent = as_alert_messages(amount_scored(spark, sf_dir).filter("is_flagged"))
    return sent.select("key", F.get_json_object("value", "$.score").cast("double").alias("score"))


ALERT_PAGE = f"""SELECT transaction_id, user_id, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount, merchant_category,
       {_iso('event_time')} AS event_time, country, score, anomaly_type, {_iso('event_time')} AS alerted_at FROM """


@query("WITH " + STORED + ", stored_page AS (SELECT * FROM alerts WHERE event_time > TIMESTAMP '2024-01-05 00:00:00'"
       " AND score <= -0.01 ORDER BY event_time DESC, transaction_id LIMIT 50 OFFSET 20) " + ALERT_PAGE + "stored_page")
def alerts_page(spark, sf_dir):
    alerts = as_alerts(stored(spark, sf_dir))
    found = reports.list_alerts(alerts, 50, 20, since=datetime(2024, 1, 5, tzinfo=timezone.utc), max_score=-0.01)
    return with_iso(found, "event_time", "alerted_at")


@query("WITH " + STORED + ", typed AS (SELECT * FROM alerts WHERE anomaly_type = 'amount_spike'"
       " ORDER BY event_time DESC, transaction_id LIMIT 200) " + ALERT_PAGE + "typed")
def alerts_of_type(spark, sf_dir):
    found = reports.list_alerts(as_alerts(stored(spark, sf_dir)), 200, anomaly_type="amount_spike")
    return with_iso(found, "event_time", "alerted_at")


@query("WITH " + STORED + ", feed AS (SELECT * FROM alerts ORDER BY event_time DESC, transaction_id LIMIT 30) "
       + ALERT_PAGE + "feed")
def latest_feed(spark, sf_dir):
    return with_iso(reports.latest_feed(as_alerts(stored(spark, sf_dir))), "event_time", "alerted_at")


@query("WITH " + STORED + """
SELECT transaction_id, score, anomaly_type FROM alerts ORDER BY score, transaction_id LIMIT 25""")
def alerts_worst_k(spark, sf_dir):
    return reports.worst_alerts(as_alerts(stored(spark, sf_dir)), 25).select("transaction_id", "score", "anomaly_type")


LISTED = f"SELECT transaction_id, {_iso('event_time')} AS event_time, score, is_flagged FROM flagged"


@query("WITH " + STORED + LISTED + " ORDER BY event_time DESC, transaction_id LIMIT 50")
def latest_transactions(spark, sf_dir):
    found = reports.latest_transactions(stored(spark, sf_dir), 50)
    return with_iso(found.select("transaction_id", "event_time", "score", "is_flagged"), "event_time")


@query("WITH " + STORED + LISTED + " WHERE is_flagged ORDER BY event_time DESC, transaction_id LIMIT 50 OFFSET 50")
def flagged_listing(spark, sf_dir):
    found = reports.flagged_transactions(stored(spark, sf_dir), 50, 50)
    return with_iso(found.select("transaction_id", "event_time", "score", "is_flagged"), "event_time")


@query("WITH " + STORED + """
SELECT transaction_id, score, score < 0.05 AS is_flagged FROM flagged""")
def reflagged(spark, sf_dir):
    return flag(stored(spark, sf_dir), 0.05).select("transaction_id", "score", "is_flagged")


@query("WITH " + STORED + f"""
SELECT substr(transaction_id, 1, 8) AS tx, transaction_id, user_id, merchant_category, country,
       '$' || format('{{:,.2f}}', amount) AS amount_text, format('{{:.4f}}', score) AS score_text,
       CASE WHEN score < -0.3 THEN 'high' WHEN score < -0.2 THEN 'medium' ELSE 'low' END AS severity,
       CASE anomaly_type WHEN 'amount_spike' THEN 'spike' WHEN 'geo_jump' THEN 'geo' WHEN 'odd_hour_burst' THEN 'hour'
            ELSE '?' END AS type_label
FROM alerts""")
def alert_lines(spark, sf_dir):
    return reports.alert_lines(as_alerts(stored(spark, sf_dir)))


@query("WITH " + STORED + f"""
SELECT transaction_id, event_time > TIMESTAMP '2024-01-15 00:00:00' AS is_new FROM alerts""")
def newly_seen_alerts(spark, sf_dir):
    alerts = as_alerts(stored(spark, sf_dir))
    later = reports.matching(alerts, since=AS_OF).select("transaction_id")
    earlier = alerts.join(later, "transaction_id", "left_anti")
    return reports.new_rows(alerts, earlier).select("transaction_id", "is_new")


@query("WITH " + STORED + """
SELECT anomaly_type, count(*) AS n_alerts FROM alerts
WHERE event_time > TIMESTAMP '2024-01-05 00:00:00' AND anomaly_type IS NOT NULL GROUP BY anomaly_type""")
def alerts_by_type(spark, sf_dir):
    alerts = as_alerts(stored(spark, sf_dir))
    return reports.alerts_by_type(alerts, datetime(2024, 1, 5, tzinfo=timezone.utc))


@query("WITH " + STORED + """,
t AS (SELECT count(*) AS n FROM flagged WHERE event_time > TIMESTAMP '2024-01-14 00:00:00' AND event_time <= TIMESTAMP '2024-01-15 00:00:00'),
a AS (SELECT * FROM alerts WHERE event_time > TIMESTAMP '2024-01-14 00:00:00' AND event_time <= TIMESTAMP '2024-01-15 00:00:00')
SELECT 1440 AS window_minutes, (SELECT n FROM t) AS total_transactions, count(*) AS total_alerts,
       coalesce(round(count(*) * 1.0 / nullif((SELECT n FROM t), 0), 6), 0.0) AS anomaly_rate,
       count(*) FILTER (WHERE anomaly_type = 'amount_spike') AS amount_spike,
       count(*) FILTER (WHERE anomaly_type = 'geo_jump') AS geo_jump,
       count(*) FILTER (WHERE anomaly_type = 'odd_hour_burst') AS odd_hour_burst,
       printf('%.2f%%', 100 * coalesce(round(count(*) * 1.0 / nullif((SELECT n FROM t), 0), 6), 0.0)) AS rate_text
FROM a""")
def stats_report(spark, sf_dir):
    rows = stored(spark, sf_dir)
    report = reports.stats_report(rows, as_alerts(rows), AS_OF, DAY_MINUTES)
    return reports.with_rate_text(report).select("*", "by_type.*").drop("by_type", "model_metrics")


@query("WITH " + STORED + """,
marks AS (SELECT CAST(floor(epoch(event_time) / 5) AS BIGINT) * 5 + 5 AS t, 1 AS x, 0 AS a FROM flagged
          UNION ALL SELECT CAST(floor(epoch(event_time) / 5) AS BIGINT) * 5 + 5, 0, 1 FROM alerts),
steps AS (SELECT t, sum(x) AS x, sum(a) AS a FROM marks GROUP BY t),
summed AS (SELECT t, sum(x) OVER w AS x, sum(a) OVER w AS a FROM steps
           WINDOW w AS (ORDER BY t RANGE BETWEEN 595 PRECEDING AND CURRENT ROW))
SELECT strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS sampled_at, CAST(x AS BIGINT) AS total_transactions,
       CAST(a AS BIGINT) AS total_alerts, coalesce(round(a * 1.0 / nullif(x, 0), 6), 0.0) AS anomaly_rate FROM summed""")
def rate_series(spark, sf_dir):
    rows = stored(spark, sf_dir)
    return with_iso(reports.rate_series(rows, as_alerts(rows)), "sampled_at")


@query("WITH " + STORED + """,
polls AS (SELECT TIMESTAMP '2024-01-15 00:00:00' - to_seconds(5 * unnest(range(72))) AS t),
counted AS (
  SELECT t, (SELECT count(*) FROM flagged WHERE event_time > t - INTERVAL 10 MINUTE AND event_time <= t) AS x,
         (SELECT count(*) FROM alerts WHERE event_time > t - INTERVAL 10 MINUTE AND event_time <= t) AS a FROM polls)
SELECT strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS sampled_at, x AS total_transactions, a AS total_alerts,
       coalesce(round(a * 1.0 / nullif(x, 0), 6), 0.0) AS anomaly_rate FROM counted""")
def latest_rates(spark, sf_dir):
    rows = stored(spark, sf_dir)
    return with_iso(reports.latest_rates(rows, as_alerts(rows), AS_OF), "sampled_at")


def _rate_windows(where: str = "") -> str:
    return "WITH " + STORED + f""",
slots AS (
  SELECT is_flagged, make_timestamp((CAST(floor(epoch(event_time) / 900) AS BIGINT) * 900 - 900 * k) * 1000000) AS window_start
  FROM flagged CROSS JOIN range(4) g(k)
),
counted AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS x,
                   count(*) FILTER (WHERE is_flagged) AS a FROM slots GROUP BY window_start)
SELECT {_iso('window_start')} AS window_start, {_iso('window_end')} AS window_end, x AS total_transactions,
       a AS total_alerts, round(a * 1.0 / x, 6) AS anomaly_rate FROM counted {where}"""


@query(_rate_windows())
def windowed_rates(spark, sf_dir):
    rows = reports.windowed_rates(amount_scored(spark, sf_dir), window="1 hour", slide="15 minutes")
    return with_iso(rows, "window_start", "window_end")


# --- evaluation --------------------------------------------------------------

MATRIX = STORED + """,
matrix AS (
  SELECT count(*) FILTER (WHERE NOT is_anomaly AND score >= 0) AS tn, count(*) FILTER (WHERE NOT is_anomaly AND score < 0) AS fp,
         count(*) FILTER (WHERE is_anomaly AND score >= 0) AS fn, count(*) FILTER (WHERE is_anomaly AND score < 0) AS tp
  FROM stored
),
metrics AS (
  SELECT tn + fp + fn + tp AS n_holdout, fn + tp AS n_anomalies_true, fp + tp AS n_anomalies_pred,
         round((fn + tp) * 1.0 / (tn + fp + fn + tp), 4) AS anomaly_rate_true,
         coalesce(round(tp * 1.0 / nullif(tp + fp, 0), 4), 0.0) AS precision,
         coalesce(round(tp * 1.0 / nullif(tp + fn, 0), 4), 0.0) AS recall,
         coalesce(round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 4), 0.0) AS f1, tn, fp, fn, tp
  FROM matrix
)"""

CURVE = STORED + """,
points AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE is_anomaly) AS tp FROM stored GROUP BY score),
curve AS (
  SELECT score, n, tp, CAST(sum(n) OVER w AS BIGINT) AS n_upto, CAST(sum(tp) OVER w AS BIGINT) AS tp_upto,
         sum(tp) OVER () AS positives
  FROM points WINDOW w AS (ORDER BY score)
)"""


def profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.profile(amount_scored(spark, sf_dir))


@query("WITH " + MATRIX + " SELECT * FROM matrix")
def holdout_confusion(spark, sf_dir):
    return ev.confusion(profiled(spark, sf_dir), 0.0)


@query("WITH " + MATRIX + " SELECT * FROM metrics")
def precision_recall_f1(spark, sf_dir):
    return ev.holdout_metrics(ev.confusion(profiled(spark, sf_dir), 0.0))


@query("WITH " + MATRIX + " SELECT * FROM metrics")
def stored_evaluation(spark, sf_dir):
    return training.evaluate_stored(stored(spark, sf_dir))


@query("WITH " + CURVE + """
SELECT round(sum(tp * 1.0 * tp_upto / n_upto) / sum(tp), 6) AS auprc, CAST(sum(n) AS BIGINT) AS n,
       CAST(sum(tp) AS BIGINT) AS positives FROM curve""")
def average_precision(spark, sf_dir):
    return _rounded(ev.average_precision(profiled(spark, sf_dir)), "auprc")


@query("WITH " + CURVE + """
SELECT score AS threshold, n, tp, n_upto, tp_upto, round(tp_upto * 1.0 / n_upto, 6) AS precision,
       round(tp_upto * 1.0 / positives, 6) AS recall FROM curve""")
def pr_curve(spark, sf_dir):
    return _rounded(ev.pr_curve(profiled(spark, sf_dir)), "precision", "recall")


@query("WITH " + CURVE + """,
scored AS (SELECT score, tp_upto * 1.0 / n_upto AS p, tp_upto * 1.0 / positives AS r FROM curve)
SELECT score AS threshold, round(p, 6) AS precision, round(r, 6) AS recall,
       round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1
FROM scored ORDER BY coalesce(2 * p * r / nullif(p + r, 0), 0) DESC, score LIMIT 1""")
def best_threshold(spark, sf_dir):
    return _rounded(ev.best_threshold(ev.pr_curve(profiled(spark, sf_dir))), "precision", "recall", "f1")


@query("WITH " + STORED + """
SELECT t.anomaly_type, count(s.score) AS n_rows,
       round(count(*) FILTER (WHERE s.is_anomaly AND s.score < 0) * 1.0 / nullif(count(s.score), 0), 4) AS recall
FROM (VALUES ('amount_spike'), ('geo_jump'), ('odd_hour_burst')) t(anomaly_type)
     LEFT JOIN stored s ON s.anomaly_type = t.anomaly_type GROUP BY t.anomaly_type""")
def recall_by_type(spark, sf_dir):
    return ev.recall_by_type(profiled(spark, sf_dir), 0.0)


METRICS_DOCUMENT = MATRIX[len(STORED):] + """,
curve AS (SELECT n, tp, sum(n) OVER (ORDER BY score) AS n_upto, sum(tp) OVER (ORDER BY score) AS tp_upto FROM
            (SELECT score, count(*) AS n, count(*) FILTER (WHERE is_anomaly) AS tp FROM stored GROUP BY score)),
recalls AS (
  SELECT round(count(*) FILTER (WHERE anomaly_type = 'amount_spike' AND score < 0) * 1.0
               / nullif(count(*) FILTER (WHERE anomaly_type = 'amount_spike'), 0), 4) AS amount_spike,
         round(count(*) FILTER (WHERE anomaly_type = 'geo_jump' AND score < 0) * 1.0
               / nullif(count(*) FILTER (WHERE anomaly_type = 'geo_jump'), 0), 4) AS geo_jump,
         round(count(*) FILTER (WHERE anomaly_type = 'odd_hour_burst' AND score < 0) * 1.0
               / nullif(count(*) FILTER (WHERE anomaly_type = 'odd_hour_burst'), 0), 4) AS odd_hour_burst FROM stored)
SELECT CAST(0.0 AS DOUBLE) AS threshold, m.*, round((SELECT sum(tp * 1.0 * tp_upto / n_upto) / sum(tp) FROM curve), 4) AS auprc,
       r.amount_spike, r.geo_jump, r.odd_hour_burst FROM metrics m CROSS JOIN recalls r"""


@query("WITH " + STORED + METRICS_DOCUMENT)
def metrics_document(spark, sf_dir):
    document = training.metrics_document(profiled(spark, sf_dir), 0.0, FIXED_TIME)
    return document.select("*", "confusion_matrix.*", "per_type_recall.*").drop(
        "confusion_matrix", "per_type_recall", "evaluated_at")


@query("WITH " + STORED + METRICS_DOCUMENT[:METRICS_DOCUMENT.rindex("SELECT CAST(0.0")].rstrip() + """,
document AS (""" + METRICS_DOCUMENT[METRICS_DOCUMENT.rindex("SELECT CAST(0.0"):] + """)
SELECT 1440 AS window_minutes, threshold, n_holdout, n_anomalies_true, n_anomalies_pred, anomaly_rate_true, "precision", recall, f1, auprc,
       tn, fp, fn, tp, amount_spike, geo_jump, odd_hour_burst FROM document""")
def stats_report_metrics(spark, sf_dir):
    """The report with the newest of two metrics documents in it."""
    rows = stored(spark, sf_dir)
    counted = profiled(spark, sf_dir)
    both = [training.metrics_document(counted, threshold, FIXED_TIME + timedelta(hours=hours)) for threshold, hours in ((-0.1, 0), (0.0, 1))]
    report = reports.stats_report(rows, as_alerts(rows), AS_OF, DAY_MINUTES, both[0].unionAll(both[1]))
    return report.select("window_minutes", "model_metrics.*").select("*", "confusion_matrix.*", "per_type_recall.*").drop(
        "confusion_matrix", "per_type_recall", "evaluated_at")


@query("WITH " + STORED + """
SELECT is_anomaly, count(*) AS n_rows, min(score) AS min_score, round(avg(score), 6) AS mean_score, max(score) AS max_score,
       round(count(*) FILTER (WHERE score < 0) * 1.0 / count(*), 6) AS share_below_0,
       round(count(*) FILTER (WHERE score < -0.1) * 1.0 / count(*), 6) AS share_below_1
FROM stored GROUP BY is_anomaly""")
def score_by_class(spark, sf_dir):
    shares = ev.score_by_class(profiled(spark, sf_dir))
    return _rounded(shares, "mean_score", "share_below_0", "share_below_1")


@query("WITH " + STORED + """
SELECT bin, count(*) AS n_rows, round(CAST(-0.5 + (bin - 1) * 0.05 AS DOUBLE), 6) AS bin_start FROM (
  SELECT CASE WHEN score < -0.5 THEN 0 WHEN score >= 0.5 THEN 21 ELSE CAST(floor((score + 0.5) / 1.0 * 20) AS INT) + 1 END AS bin
  FROM stored) GROUP BY bin""")
def score_histogram(spark, sf_dir):
    return _rounded(ev.score_histogram(stored(spark, sf_dir)), "bin_start")


@query("WITH " + STORED + """,
ranked AS (SELECT *, date_trunc('day', event_time) AS day,
                  row_number() OVER (PARTITION BY date_trunc('day', event_time) ORDER BY score, transaction_id) AS place FROM stored),
daily AS (SELECT day, count(*) AS n_ranked, avg(CASE WHEN is_anomaly THEN 1.0 ELSE 0.0 END) AS p FROM ranked WHERE place <= 10 GROUP BY day)
SELECT strftime(d.day, '%Y-%m-%dT%H:%M:%SZ') AS window_start, d.n_ranked, round(d.p, 6) AS precision_at_k,
       round(b.p, 6) AS previous, coalesce(b.p - d.p > 0.15, FALSE) AS has_dropped
FROM daily d LEFT JOIN daily b ON b.day + INTERVAL 1 DAY = d.day""")
def precision_at_k(spark, sf_dir):
    rows = ev.precision_at_k(amount_scored(spark, sf_dir), 10, "1 day", 0.15)
    return with_iso(_rounded(rows, "precision_at_k", "previous"), "window_start")


@query("WITH " + STORED + """,
points AS (SELECT date_trunc('day', event_time) AS day, score, count(*) AS n, count(*) FILTER (WHERE is_anomaly) AS tp
           FROM stored GROUP BY 1, 2),
curve AS (SELECT *, sum(n) OVER w AS n_upto, sum(tp) OVER w AS tp_upto FROM points WINDOW w AS (PARTITION BY day ORDER BY score))
SELECT strftime(day, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       coalesce(round(sum(tp * 1.0 * tp_upto / n_upto) / nullif(sum(tp), 0), 6), 0.0) AS auprc,
       CAST(sum(n) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS positives,
       coalesce(sum(tp * 1.0 * tp_upto / n_upto) / nullif(sum(tp), 0), 0.0) < 0.3 AS needs_retrain
FROM curve GROUP BY day""")
def rolling_auprc(spark, sf_dir):
    rows = ev.rolling_auprc(amount_scored(spark, sf_dir), "1 day", 0.3)
    return with_iso(_rounded(rows, "auprc"), "window_start")


@query("WITH " + STORED + """
SELECT round(quantile_cont(score, 0.025), 6) AS offset_score,
       round(avg(CASE WHEN score < (SELECT quantile_cont(score, 0.025) FROM stored) THEN 1.0 ELSE 0.0 END), 6) AS flagged_rate
FROM stored""")
def contamination_cutoff(spark, sf_dir):
    counted = amount_scored(spark, sf_dir).groupBy("score").agg(F.count("*").alias("n"))
    cut = quantile(counted, "score", 0.025)
    below = F.sum(F.when(F.col("score") < cut, F.col("n")).otherwise(0))
    return counted.agg(F.round(F.lit(cut), 6).alias("offset_score"), F.round(fn.ratio(below, F.sum("n")), 6).alias("flagged_rate"))


# --- per-user behaviour ------------------------------------------------------

TIMED = LABELLED + """,
timed AS (SELECT *, CAST(replace(replace("timestamp", 'T', ' '), 'Z', '') AS TIMESTAMP) AS event_time FROM labelled)"""

TRAVEL = TIMED + """,
lagged AS (
  SELECT *, lag(event_time) OVER w AS before, lag(country) OVER w AS previous_country FROM timed
  WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id)
)
SELECT transaction_id, user_id, country, epoch(event_time) - epoch(before) AS seconds_since_previous, previous_country,
       coalesce(previous_country <> country, FALSE) AS country_changed,
       coalesce(previous_country <> country AND epoch(event_time) - epoch(before) < 21600, FALSE) AS impossible_travel
FROM lagged"""


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).withColumn("event_time", fn.to_event_time())


def timed_stream(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    events = (stream_closed_events if closed else stream_events)(spark, sf_dir)
    events = events_as_transactions(spark, sf_dir, events)
    return inject_anomalies(events, draw=md5_draws()).withColumn("event_time", fn.to_event_time())


TRAVEL_COLUMNS = ("transaction_id", "user_id", "country", "seconds_since_previous", "previous_country",
                  "country_changed", "impossible_travel")


@query("WITH " + TRAVEL)
def user_gap_travel(spark, sf_dir):
    return speed.gap_and_travel(timed(spark, sf_dir)).select(*TRAVEL_COLUMNS)


@query("WITH " + TIMED + """
SELECT transaction_id, user_id, count(*) OVER w AS n_recent, count(*) OVER w > 2 AS too_fast FROM timed
WINDOW w AS (PARTITION BY user_id ORDER BY event_time RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW)""")
def user_velocity(spark, sf_dir):
    rows = speed.velocity(timed(spark, sf_dir), limit=2, seconds=3600)
    return rows.select("transaction_id", "user_id", "n_recent", "too_fast")


WINDOWED = TIMED + """,
slots AS (
  SELECT user_id, make_timestamp((CAST(floor(epoch(event_time) / 600) AS BIGINT) * 600 - 600 * k) * 1000000) AS window_start
  FROM timed CROSS JOIN range(6) g(k)
),
counted AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS n FROM slots
            GROUP BY window_start, user_id HAVING count(*) > 2)"""


def _slots(where: str = "") -> str:
    return WINDOWED + f" SELECT {_iso('window_start')} AS window_start, {_iso('window_end')} AS window_end, user_id, n FROM counted {where}"


@query("WITH " + _slots())
def windowed_velocity(spark, sf_dir):
    rows = speed.windowed_velocity(timed(spark, sf_dir), limit=2, seconds=3600, slide_seconds=600)
    return with_iso(rows, "window_start", "window_end")


SESSIONS = TIMED + """,
cut AS (SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM timed
        WINDOW w AS (PARTITION BY user_id ORDER BY event_time, transaction_id)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY event_time, transaction_id ROWS UNBOUNDED PRECEDING) AS session FROM cut),
sessions AS (
  SELECT user_id, min(event_time) AS session_start, max(event_time) + INTERVAL 6 HOUR AS session_end, count(*) AS n,
         round(sum(amount), 2) AS total_amount, min(country) <> max(country) AS spans_countries
  FROM numbered GROUP BY user_id, session)"""


def _session_rows(where: str = "") -> str:
    return SESSIONS + f""" SELECT user_id, {_iso('session_start')} AS session_start, {_iso('session_end')} AS session_end, n,
       total_amount, spans_countries FROM sessions {where}"""


@query("WITH " + _session_rows())
def user_sessions(spark, sf_dir):
    rows = speed.sessions(timed(spark, sf_dir), gap="6 hours")
    return with_iso(_rounded(rows, "total_amount", places=2), "session_start", "session_end")


# --- idempotence and streams -------------------------------------------------

@query("WITH " + TIMED + """
SELECT transaction_id, amount, country FROM timed WHERE event_time >= TIMESTAMP '2024-01-15 00:00:00'""")
def idempotent_append(spark, sf_dir):
    rows = timed(spark, sf_dir)
    history = rows.filter(F.col("event_time") < F.lit(AS_OF))
    sent = rows.withColumn("ingest_ts", F.col("event_time"))
    again = sent.withColumns({"ingest_ts": F.col("ingest_ts") + F.expr("INTERVAL 1 SECOND"), "amount": F.col("amount") * 2})
    firsts = first_of_each(sent.unionAll(again))
    return suppress_known(firsts, history, spark.read.parquet(f"{sf_dir}/events.parquet").count()).select(
        "transaction_id", "amount", "country")


@query("WITH " + LABELLED + """
SELECT user_id AS "key", max(CAST(transaction_id AS BIGINT)) AS "offset",
       arg_max(transaction_id, CAST(transaction_id AS BIGINT)) AS "value" FROM labelled GROUP BY user_id""")
def latest_message_per_key(spark, sf_dir):
    topic = labelled(spark, sf_dir).select(
        F.col("user_id").alias("key"), F.col("transaction_id").cast("long").alias("offset"), F.col("transaction_id").alias("value"))
    return stateful.latest_per_key(topic)


@query("WITH " + FOREST_SCORED + """
SELECT transaction_id, user_id, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount, merchant_category,
       "timestamp" AS event_time, country, round(score, 6) AS score, anomaly_type
FROM forest WHERE score < 0.05""")
def stream_scored_alerts(spark, sf_dir):
    model = fixed_model(spark, labelled(spark, sf_dir))
    root = scratch_path(spark, "stream-tables")
    events = timed_stream(spark, sf_dir)
    messages = events.select(fn.json_message(TRANSACTION.names).alias("value"), F.col("event_time").alias("timestamp"))
    query_ = pipeline.start_scoring(
        messages, model, root, scratch_path(spark, "stream-checkpoint"), threshold=0.05, trigger=None, name=None)
    query_.awaitTermination()
    alerts = read_stored_alerts(spark, root).withColumn("amount", F.col("amount").cast("double"))
    kept = with_iso(alerts, "event_time").drop("alerted_at", "stream", "batch_id", "event_date")
    return _rounded(kept, "score")


REPLAYED = FOREST_SCORED + """,
accepted AS (SELECT *, CAST(transaction_id AS BIGINT) % 3 AS part, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS money FROM forest)"""


def _replayed(spark: SparkSession, sf_dir: str) -> str:
    """Tables after three batches, of which the second is replayed and the third repeats rows of the first and holds a broken one."""
    rows = labelled(spark, sf_dir)
    root, model = scratch_path(spark, "replayed-tables"), fixed_model(spark, rows)
    part = F.col("transaction_id").cast("long") % 3
    ready = rows.withColumns({"ingest_ts": F.lit(FIXED_TIME), "raw_value": F.lit(None).cast("string")})
    batches = {
        0: ready.filter(part == 0), 1: ready.filter(part == 1),
        2: ready.filter(part != 1).withColumn("amount", F.when(part == 0, F.col("amount") + 1).otherwise(F.col("amount")))
        .unionByName(ready.filter(part == 1).withColumn("timestamp", F.lit("soon")))}
    days = iter(range(1, 9))
    sink = ScoringSink(model, root, "replay", 0.05, clock=lambda: FIXED_TIME + timedelta(days=next(days)))
    for batch_id in (0, 1, 1, 2, 2):
        sink(batches[batch_id], batch_id)
    return root


@query("WITH " + REPLAYED + """
SELECT transaction_id, user_id, money AS amount, round(score, 6) AS score, score < 0.05 AS is_flagged,
       CASE part WHEN 0 THEN '2024-02-02T00:00:00Z' WHEN 1 THEN '2024-02-03T00:00:00Z' ELSE '2024-02-04T00:00:00Z' END AS processed_at
FROM accepted""")
def stored_after_replay(spark, sf_dir):
    """First writes stand, a replay keeps its time: the transactions table as the live sink left it."""
    kept = read_stored_transactions(spark, _replayed(spark, sf_dir)).withColumn("amount", F.col("amount").cast("double"))
    return with_iso(_rounded(kept, "score"), "processed_at").select(
        "transaction_id", "user_id", "amount", "score", "is_flagged", "processed_at")


@query("WITH " + REPLAYED + """
SELECT 'alert' AS kind, transaction_id FROM accepted WHERE score < 0.05
UNION ALL SELECT 'reject', transaction_id FROM accepted WHERE part = 1""")
def alerts_and_rejects_after_replay(spark, sf_dir):
    root = _replayed(spark, sf_dir)
    alerts = read_stored_alerts(spark, root).select(F.lit("alert").alias("kind"), "transaction_id")
    rejected = spark.read.parquet(f"{root}/rejects").select(F.lit("reject").alias("kind"), "transaction_id")
    return alerts.unionAll(rejected)


@query("WITH " + TX + """ SELECT transaction_id, user_id, amount, merchant_category, "timestamp", country FROM tx""")
def jsonl_scan(spark, sf_dir):
    """Transactions written as JSON lines and scanned with the given schema."""
    path = scratch_path(spark, "jsonl")
    events_as_transactions(spark, sf_dir).write.json(path)
    return read_transactions(spark, path).drop("is_anomaly", "anomaly_type")


@query("WITH " + STORED + METRICS_DOCUMENT)
def metrics_read(spark, sf_dir):
    """The metrics document written, and read back as a report reads it."""
    path = scratch_path(spark, "metrics")
    write_document(training.metrics_document(profiled(spark, sf_dir), 0.0, FIXED_TIME), path)
    return read_metrics(spark, path).select("*", "confusion_matrix.*", "per_type_recall.*").drop(
        "confusion_matrix", "per_type_recall", "evaluated_at")


@query("WITH " + LABELLED + " SELECT transaction_id, CAST(CAST(amount AS DECIMAL(12, 2)) AS DOUBLE) AS amount FROM labelled")
def stream_resume(spark, sf_dir):
    """Half of the files scored, the query stopped, the rest added, and the query started again on its checkpoint."""
    rows = labelled(spark, sf_dir)
    model = fixed_model(spark, rows)
    source, root, checkpoint = (scratch_path(spark, f"resume-{name}") for name in ("source", "tables", "checkpoint"))
    messages = rows.select(fn.json_message(TRANSACTION.names).alias("value"), F.col("transaction_id").cast("long").alias("n"))
    for half in (0, 1):
        messages.filter(F.col("n") % 2 == half).select("value").write.mode("append").parquet(source)
        stream = read_files(spark, source, "value string")
        pipeline.start_scoring(stream, model, root, checkpoint, threshold=0.05, trigger=None, name=None).awaitTermination()
    return read_stored_transactions(spark, root).select("transaction_id", F.col("amount").cast("double").alias("amount"))


@query("WITH " + _slots())
def stream_velocity(spark, sf_dir):
    counts = speed.windowed_velocity(timed_stream(spark, sf_dir, closed=True), limit=2, seconds=3600, slide_seconds=600)
    return with_iso(pipeline.drain_to_files(counts, spark, "velocity"), "window_start", "window_end")


@query("WITH " + _session_rows())
def stream_sessions(spark, sf_dir):
    bursts = speed.sessions(timed_stream(spark, sf_dir, closed=True), gap="6 hours")
    drained = pipeline.drain_to_files(bursts, spark, "sessions")
    return with_iso(_rounded(drained, "total_amount", places=2), "session_start", "session_end")


@query(_rate_windows())
def stream_rate_windows(spark, sf_dir):
    scored = amount_scored(spark, sf_dir, timed_stream(spark, sf_dir, closed=True))
    rates = reports.windowed_rates(scored, window="1 hour", slide="15 minutes")
    return with_iso(pipeline.drain_to_files(rates, spark, "rates"), "window_start", "window_end")


@query("WITH " + TIMED + ' SELECT transaction_id, user_id, "timestamp" FROM timed')
def stream_dedupe(spark, sf_dir):
    sent = timed_stream(spark, sf_dir)
    twice = sent.unionAll(timed_stream(spark, sf_dir))
    once = stateful.once_per_key(twice).select("transaction_id", "user_id", "timestamp")
    return pipeline.drain_to_files(once, spark, "dedupe")


@query("WITH " + TRAVEL)
def stream_geo_velocity(spark, sf_dir):
    moves = stateful.geo_velocity(timed_stream(spark, sf_dir))
    return pipeline.drain_to_files(moves, spark, "geo-velocity").select(*TRAVEL_COLUMNS)


@query("WITH " + LABELLED + """
SELECT count(*) AS sent, count(*) FILTER (WHERE is_anomaly) AS anomalies,
       round(100.0 * count(*) FILTER (WHERE is_anomaly) / count(*), 2) AS observed_rate_pct FROM labelled""")
def stream_injection_rate(spark, sf_dir):
    return pipeline.drain_complete(injection_rate(timed_stream(spark, sf_dir)), spark, "injection-rate")


# --- the trained model (its random trees have no SQL counterpart) ------------

def trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Model, DataFrame]:
    rows = labelled(spark, sf_dir)
    return (rows, *training.fit(rows))


def most_severe(spark: SparkSession, sf_dir: str, k: int = 20) -> DataFrame:
    rows, model, _ = trained(spark, sf_dir)
    return reports.worst_alerts(flag(score_batch(rows, model), 0.0).filter("is_flagged"), k)


def _tree_facts(nodes: DataFrame) -> DataFrame:
    """One row of what every grown forest must satisfy."""
    per_tree = nodes.groupBy("tree_id").agg(
        F.max(F.when(F.col("node_id") == 0, F.col("size"))).alias("root"),
        F.sum(F.when(F.col("left") < 0, F.col("size"))).alias("leaves"), F.max("depth").alias("depth"))
    return per_tree.agg(
        F.count("*").alias("n_trees"), F.min("root").cast("long").alias("smallest_root"), F.max("root").cast("long").alias("largest_root"),
        F.count_if(F.col("leaves") != F.col("root")).alias("trees_that_lose_rows"), (F.max("depth") <= 8).alias("depth_is_bounded"))


TREE_FACTS = """CAST(100 AS BIGINT) AS n_trees, least(256, count(*)) AS smallest_root, least(256, count(*)) AS largest_root,
       CAST(0 AS BIGINT) AS trees_that_lose_rows, TRUE AS depth_is_bounded"""


@query("WITH " + LABELLED + f"""
SELECT {TREE_FACTS}, count(*) AS n_rows, count(*) AS n_scored, TRUE AS scores_in_range, CAST(0 AS BIGINT) AS changed_by_storing FROM labelled""")
def forest_train_score(spark, sf_dir):
    """Train, store, load, score with both. Random trees have no SQL counterpart, their invariants have."""
    rows, model, _ = trained(spark, sf_dir)
    root = scratch_path(spark, "models")
    save_model(model, root)
    loaded = load_model(spark, root)
    both = score_batch(score_batch(rows, model).withColumnRenamed("score", "first_score"), loaded)
    scores = both.agg(
        F.count("*").alias("n_rows"), F.count("score").alias("n_scored"),
        (F.max(F.abs("score")) <= 1).alias("scores_in_range"),
        F.count_if(~F.col("score").eqNullSafe(F.col("first_score"))).alias("changed_by_storing"))
    return _tree_facts(loaded.nodes).join(F.broadcast(scores))


@query("WITH " + FOREST_SCORED + f"""
SELECT count(*) AS n_records, count(*) FILTER (WHERE is_anomaly) AS n_anomalies_in_training, 'auto' AS contamination, 3 AS n_estimators,
       round(count(*) FILTER (WHERE score < 0) * 1.0 / count(*), 4) AS flagged_rate_training, '{",".join(FEATURES)}' AS features,
       '2024-02-01T00:00:00Z' AS trained_at FROM forest""")
def train_summary(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    model = fixed_model(spark, rows)
    raw = add_raw_score(transform(rows, model.state), model.raw_score)
    summary = training.training_summary(rows, model, raw.groupBy("raw").agg(F.count("*").alias("n")), FIXED_TIME)
    return with_iso(summary.withColumn("features", F.array_join("features", ",")), "trained_at")


@query("WITH " + LABELLED + f"""
SELECT count(*) AS n_records, count(*) FILTER (WHERE is_anomaly) AS n_anomalies_in_training, '0.025' AS contamination, CAST(100 AS BIGINT) AS n_estimators,
       TRUE AS flags_as_calibrated, '{",".join(FEATURES)}' AS features, '2024-02-01T00:00:00Z' AS trained_at FROM labelled""")
def trained_summary(spark, sf_dir):
    """The summary that the training job writes beside a forest it has grown."""
    root = scratch_path(spark, "models")
    model = training.train(labelled(spark, sf_dir), root, contamination=0.025, trained_at=FIXED_TIME)
    written = spark.read.json(f"{root}/training_summary/version={model.version}")
    return written.select(
        "n_records", "n_anomalies_in_training", "contamination", "n_estimators",
        F.col("flagged_rate_training").between(0.02, 0.03).alias("flags_as_calibrated"), F.array_join("features", ",").alias("features"),
        F.date_format(F.to_timestamp("trained_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("trained_at"))


@query("WITH " + LABELLED + """
SELECT count(*) AS n_holdout, count(*) FILTER (WHERE is_anomaly) AS n_anomalies_true,
       round(count(*) FILTER (WHERE is_anomaly) * 1.0 / count(*), 6) AS anomaly_rate_true, count(*) AS in_matrix,
       count(*) FILTER (WHERE is_anomaly) AS true_in_matrix, TRUE AS beats_chance, TRUE AS in_bounds FROM labelled""")
def evaluate_forest(spark, sf_dir):
    """The evaluation job on a forest that was grown: what must hold of its report for any forest, and that it finds more than chance."""
    rows, model, _ = trained(spark, sf_dir)
    report = training.evaluate(rows, model, 0.0, evaluated_at=FIXED_TIME)
    cells = [F.col(f"confusion_matrix.{name}") for name in ("tn", "fp", "fn", "tp")]
    return report.select(
        "n_holdout", "n_anomalies_true", F.round(F.col("n_anomalies_true") / F.col("n_holdout"), 6).alias("anomaly_rate_true"),
        (cells[0] + cells[1] + cells[2] + cells[3]).alias("in_matrix"), (cells[2] + cells[3]).alias("true_in_matrix"),
        (F.col("auprc") > 3 * F.col("anomaly_rate_true")).alias("beats_chance"),
        (F.col("precision").between(0, 1) & F.col("recall").between(0, 1) & F.col("f1").between(0, 1)).alias("in_bounds"))


FOREST_STORED = FOREST_SCORED + """,
fixed AS (SELECT * REPLACE (round(score, 9) AS score) FROM forest)"""


@query("WITH " + FOREST_STORED + METRICS_DOCUMENT.replace("FROM stored", "FROM fixed"))
def evaluate_trained(spark, sf_dir):
    """The evaluation job on the forest that SQL can follow."""
    rows = labelled(spark, sf_dir)
    document = training.evaluate(rows, fixed_model(spark, rows), 0.0, evaluated_at=FIXED_TIME)
    return document.select("*", "confusion_matrix.*", "per_type_recall.*").drop(
        "confusion_matrix", "per_type_recall", "evaluated_at")


@query("WITH " + FOREST_SCORED + " SELECT round(quantile_cont(score - 0.5, 0.025), 6) AS calibrated_offset FROM forest")
def calibrated_offset(spark, sf_dir):
    """The calibration step of training, on the forest that SQL can follow."""
    rows = labelled(spark, sf_dir)
    model = fixed_model(spark, rows)
    raw = add_raw_score(transform(rows, model.state), model.raw_score)
    found = quantile(raw.groupBy("raw").agg(F.count("*").alias("n")), "raw", 0.025)
    return spark.createDataFrame([(round(found, 6),)], "calibrated_offset double")


@query("WITH " + TX + f"""
SELECT {TREE_FACTS}, CAST(2 AS INTEGER) AS version, count(*) AS n_recent FROM tx WHERE tx.at > TIMESTAMP '2024-01-15 00:00:00'""")
def retrain_recent(spark, sf_dir):
    rows = timed(spark, sf_dir)
    root = scratch_path(spark, "models")
    training.train(rows, root)
    training.retrain(rows, root, since=AS_OF)
    model = load_model(spark, root)
    return _tree_facts(model.nodes).select("*", F.lit(model.version).alias("version"), F.lit(model.state.n_rows).cast("long").alias("n_recent"))


#: Within a day, so that statistics from there on need some raw rows.
CUT = datetime(2024, 1, 10, 12, 30, tzinfo=timezone.utc)


def kept_statistics(spark: SparkSession, rows: DataFrame) -> DailyStatistics:
    """Daily statistics of all rows: one half, a merge, the other half, and both once more."""
    statistics = DailyStatistics(spark, scratch_path(spark, "statistics"))
    halves = [rows.filter(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == half) for half in (0, 1)]
    statistics.add(halves[0], "first")
    statistics.compact()
    for half, name in ((1, "second"), (0, "first"), (1, "second")):
        statistics.add(halves[half], name)
    return statistics


SINCE_CUT = LABELLED + f""",
recent AS (SELECT * FROM labelled WHERE "timestamp" >= '{CUT:%Y-%m-%dT%H:%M:%SZ}')"""


@query("WITH " + SINCE_CUT + """
SELECT round(avg(ln(1 + amount)), 6) AS amount_mean, round(greatest(coalesce(stddev_samp(ln(1 + amount)), 0), 1e-6), 6) AS amount_std,
       (SELECT round(min(n) * 1.0 / sum(n), 6) FROM
          (SELECT count(*) AS n FROM recent WHERE merchant_category IS NOT NULL GROUP BY merchant_category)) AS merchant_freq_fallback,
       count(*) AS n_rows, count(DISTINCT merchant_category) AS n_categories FROM recent""")
def kept_feature_stats(spark, sf_dir):
    """Feature statistics of recent rows, from what is kept of each day."""
    rows = timed(spark, sf_dir)
    state, _ = kept_statistics(spark, rows).state_since(rows, CUT)
    return state.stats(spark).select(
        *[F.round(name, 6).alias(name) for name in ("amount_mean", "amount_std", "merchant_freq_fallback")],
        *[F.col(name).cast("long").alias(name) for name in ("n_rows", "n_categories")])


@query("WITH " + SINCE_CUT + """,
counts AS (SELECT user_id, country, count(*) AS c FROM recent
           WHERE NOT is_anomaly AND user_id IS NOT NULL AND country IS NOT NULL GROUP BY 1, 2)
SELECT user_id, home_country FROM (""" + HOMES + ")")
def kept_home_countries(spark, sf_dir):
    """Home countries over recent rows, from what is kept of each day."""
    rows = timed(spark, sf_dir)
    return kept_statistics(spark, rows).state_since(rows, CUT)[0].user_home


@query("WITH " + TX + f"""
SELECT {TREE_FACTS}, CAST(1 AS INTEGER) AS version, count(*) AS n_recent FROM tx WHERE tx.at > TIMESTAMP '2024-01-15 00:00:00'""")
def retrain_from_kept(spark, sf_dir):
    """A model refitted on recent rows whose statistics were kept; training refuses statistics that rest on other rows."""
    rows = timed(spark, sf_dir)
    root = scratch_path(spark, "models")
    training.retrain(rows, root, since=AS_OF, statistics=kept_statistics(spark, rows))
    model = load_model(spark, root)
    return _tree_facts(model.nodes).select("*", F.lit(model.version).alias("version"), F.lit(model.state.n_rows).cast("long").alias("n_recent"))


_SCORED_PART = FOREST_SCORED.index("featured AS")


@query("WITH " + FOREST_SCORED[:_SCORED_PART] + REQUESTS[len(TX) + 2:] + """,
accepted AS (
  SELECT request_id, amount, merchant_category, CASE WHEN kind IN ('view', 'click') THEN '2024-01-15T00:00:00Z' ELSE "timestamp" END AS "timestamp",
         CASE WHEN kind = 'purchase' THEN h + 1 END AS hour, CASE WHEN kind = 'signup' THEN 'u_0000' ELSE user_id END AS user_id,
         CASE WHEN kind = 'error' THEN 'US' ELSE country END AS country
  FROM r WHERE h NOT IN (0, 1, 2) AND amount > 0 AND NOT (kind = 'purchase' AND h = 23)
),
""" + FOREST_SCORED[_SCORED_PART:].replace("FROM labelled l", "FROM accepted l").replace("coalesce(TRY_CAST(", "coalesce(l.hour, TRY_CAST(") + """
SELECT request_id, round(score, 6) AS score, score < 0.05 AS is_anomaly, CAST(0.05 AS DOUBLE) AS threshold FROM forest""")
def score_requests(spark, sf_dir):
    model = fixed_model(spark, labelled(spark, sf_dir))
    answers, _ = serving.score_requests(_requests(spark, sf_dir), model, 0.05, AS_OF)
    return answers.drop("features")


@query("WITH " + REQUESTS + """
SELECT request_id, TRUE AS score_in_range, TRUE AS flag_follows_score, CAST(0.05 AS DOUBLE) AS threshold
FROM r WHERE h NOT IN (0, 1, 2) AND amount > 0 AND NOT (kind = 'purchase' AND h = 23)""")
def score_requests_forest(spark, sf_dir):
    """Requests scored by a forest that was grown."""
    _, model, _ = trained(spark, sf_dir)
    answers, _ = serving.score_requests(_requests(spark, sf_dir), model, 0.05, AS_OF)
    return answers.select(
        "request_id", F.col("score").between(-1, 1).alias("score_in_range"),
        (F.col("is_anomaly") == (F.col("score") < 0.05)).alias("flag_follows_score"), "threshold")
