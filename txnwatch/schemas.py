"""Row shapes and fixed values shared by every module."""

from pyspark.sql import types as T

# --- Fixed values (must stay as they are for results to be comparable) -------
FEATURES = ("amount_log_zscore", "hour_sin", "hour_cos", "merchant_freq", "is_home_country")
ANOMALY_TYPES = ("amount_spike", "geo_jump", "odd_hour_burst")
HOME_COUNTRIES = ("US", "CA", "GB", "DE", "FR")
FAR_COUNTRIES = ("JP", "SG", "AU", "ZA")
TYPE_LABELS = {"amount_spike": "spike", "geo_jump": "geo", "odd_hour_burst": "hour"}

ALERT_THRESHOLD = -0.1  # live scoring
EVALUATION_THRESHOLD = 0.0  # the calibrated boundary
CONTAMINATION = 0.025
N_TREES = 100
SUB_SAMPLE = 256
SEED = 42
AUTO_OFFSET = -0.5  # used when contamination is "auto"

FALLBACK_HOUR = 12
STD_FLOOR = 1e-6
SPIKE_RANGE = (10.0, 50.0)
ODD_HOURS = (2, 4)
SEVERITY_HIGH = -0.3
SEVERITY_MEDIUM = -0.2

DEFAULT_USER = "u_0000"
DEFAULT_COUNTRY = "US"
MAX_PAGE = 200
MAX_WINDOW_MINUTES = 1440
FEED_SIZE = 30
RATE_SAMPLES = 72
RATE_STEP_SECONDS = 5
RATE_WINDOW_SECONDS = 600
VELOCITY_LIMIT = 10
VELOCITY_SECONDS = 60

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
# -----------------------------------------------------------------------------

MONEY = T.DecimalType(12, 2)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


TRANSACTION = _struct(
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("amount", T.DoubleType()),
    ("merchant_category", T.StringType()),
    ("timestamp", T.StringType()),
    ("country", T.StringType()),
    ("is_anomaly", T.BooleanType()),
    ("anomaly_type", T.StringType()),
)

REQUEST = _struct(
    ("amount", T.DoubleType()),
    ("merchant_category", T.StringType()),
    ("timestamp", T.StringType()),
    ("hour", T.IntegerType()),
    ("user_id", T.StringType()),
    ("country", T.StringType()),
)

SCORED = _struct(
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("amount", MONEY),
    ("merchant_category", T.StringType()),
    ("event_time", T.TimestampType()),
    ("country", T.StringType()),
    ("score", T.DoubleType()),
    ("is_flagged", T.BooleanType()),
    ("ground_truth", T.BooleanType()),
    ("anomaly_type", T.StringType()),
    ("processed_at", T.TimestampType()),
)

ALERT = _struct(
    ("transaction_id", T.StringType()),
    ("user_id", T.StringType()),
    ("amount", MONEY),
    ("merchant_category", T.StringType()),
    ("event_time", T.TimestampType()),
    ("country", T.StringType()),
    ("score", T.DoubleType()),
    ("anomaly_type", T.StringType()),
    ("alerted_at", T.TimestampType()),
)

# Where a stored row came from; these are partition columns of both tables.
PROVENANCE = _struct(
    ("stream", T.StringType()),
    ("batch_id", T.LongType()),
    ("event_date", T.DateType()),
)

ALERT_MESSAGE_FIELDS = (
    "transaction_id", "user_id", "amount", "merchant_category",
    "timestamp", "country", "score", "anomaly_type",
)

FOREST_NODE = _struct(
    ("tree_id", T.IntegerType()),
    ("node_id", T.IntegerType()),
    ("left", T.IntegerType()),
    ("right", T.IntegerType()),
    ("feature", T.IntegerType()),
    ("split", T.DoubleType()),
    ("size", T.IntegerType()),
    ("depth", T.IntegerType()),
)

FEATURE_STATS = _struct(
    ("amount_mean", T.DoubleType()),
    ("amount_std", T.DoubleType()),
    ("merchant_freq_fallback", T.DoubleType()),
    ("n_rows", T.LongType()),
    ("n_categories", T.LongType()),
    ("n_users", T.LongType()),
    ("hot_users", T.ArrayType(T.StringType())),
    ("hot_categories", T.ArrayType(T.StringType())),
)

FOREST_META = _struct(
    ("n_trees", T.IntegerType()),
    ("sub_sample", T.IntegerType()),
    ("offset", T.DoubleType()),
    ("contamination", T.StringType()),
    ("seed", T.LongType()),
)

CONFUSION = _struct(*[(name, T.LongType()) for name in ("tn", "fp", "fn", "tp")])
PER_TYPE_RECALL = _struct(*[(name, T.DoubleType()) for name in ANOMALY_TYPES])

METRICS = _struct(
    ("threshold", T.DoubleType()),
    ("n_holdout", T.LongType()),
    ("n_anomalies_true", T.LongType()),
    ("n_anomalies_pred", T.LongType()),
    ("anomaly_rate_true", T.DoubleType()),
    ("precision", T.DoubleType()),
    ("recall", T.DoubleType()),
    ("f1", T.DoubleType()),
    ("auprc", T.DoubleType()),
    ("confusion_matrix", CONFUSION),
    ("per_type_recall", PER_TYPE_RECALL),
    ("evaluated_at", T.TimestampType()),
)
