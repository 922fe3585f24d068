"""A fitted model, its stored form, and scoring with it."""

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from txnwatch.operators import forest as iforest
from txnwatch.operators.features import FeatureState, transform
from txnwatch.schemas import FEATURES, FEATURE_STATS, FOREST_META, FOREST_NODE
from txnwatch.session import require_utc


@dataclass
class Model:
    state: FeatureState
    nodes: DataFrame = field(repr=False)
    n_trees: int
    sub_sample: int
    offset: float
    contamination: str
    seed: int
    version: int | None = None
    _raw_score: object = field(default=None, repr=False)
    _shared: object = field(default=None, repr=False)

    @property
    def raw_score(self):
        """The scoring function; the forest is broadcast once per model."""
        if self._raw_score is None:
            compiled = iforest.load_forest(self.nodes, self.sub_sample, self.n_trees)
            self._shared = self.nodes.sparkSession.sparkContext.broadcast(compiled)
            self._raw_score = iforest.raw_score_udf(self._shared)
        return self._raw_score

    def release(self) -> None:
        """Drop the executors' copies of the forest; tasks that still need it fetch it again."""
        if self._shared is not None:
            self._shared.unpersist()


def add_raw_score(features: DataFrame, raw_score) -> DataFrame:
    return features.withColumn("raw", F.when(F.col(FEATURES[0]).isNotNull(), raw_score(*FEATURES)))


def score_batch(df: DataFrame, model: Model, few_rows: bool = False) -> DataFrame:
    """``df`` with a ``score`` column; the features are not kept.

    ``few_rows`` says that ``df`` was counted and is small enough to be broadcast.
    """
    require_utc(df.sparkSession)
    scored = add_raw_score(transform(df, model.state, few_rows), model.raw_score)
    return scored.select(*df.columns, iforest.anomaly_score(F.col("raw"), model.offset).alias("score"))


def flag(df: DataFrame, threshold: float) -> DataFrame:
    """Strictly below the threshold is flagged; also re-flags stored scores."""
    return df.withColumn("is_flagged", F.col("score") < F.lit(threshold))


def register_sql(spark: SparkSession, model: Model, name: str = "anomaly_score") -> None:
    """Make the raw scorer callable from SQL, under ``name``."""
    spark.udf.register(name, model.raw_score)


def save_model(model: Model, root: str) -> int:
    """Write ``root/version=K`` and then announce K, so readers see whole models."""
    spark = model.nodes.sparkSession
    version = (latest_version(spark, root) or 0) + 1
    path = f"{root}/models/version={version}"
    model.state.stats(spark).write.mode("overwrite").parquet(f"{path}/stats")
    model.state.merchant_freq.write.mode("overwrite").parquet(f"{path}/merchant_freq")
    model.state.user_home.write.mode("overwrite").parquet(f"{path}/user_home")
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    meta = [(model.n_trees, model.sub_sample, model.offset, model.contamination, model.seed)]
    spark.createDataFrame(meta, FOREST_META).write.mode("overwrite").parquet(f"{path}/meta")
    spark.createDataFrame([(version,)], "version int").write.mode("append").parquet(f"{root}/versions")
    return version


def latest_version(spark: SparkSession, root: str) -> int | None:
    try:
        return spark.read.schema("version int").parquet(f"{root}/versions").agg(F.max("version")).first()[0]
    except AnalysisException:
        return None


def load_model(spark: SparkSession, root: str, version: int | None = None) -> Model:
    version = version or latest_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no model under {root}")
    path = f"{root}/models/version={version}"
    stats = spark.read.schema(FEATURE_STATS).parquet(f"{path}/stats").first().asDict()
    meta = spark.read.schema(FOREST_META).parquet(f"{path}/meta").first().asDict()
    state = FeatureState(
        **stats,
        merchant_freq=spark.read.schema("merchant_category string, freq double").parquet(f"{path}/merchant_freq"),
        user_home=spark.read.schema("user_id string, home_country string").parquet(f"{path}/user_home"),
    )
    nodes = spark.read.schema(FOREST_NODE).parquet(f"{path}/nodes")
    return Model(state=state, nodes=nodes, version=version, **meta)


class CurrentModel:
    """The newest stored model, looked up again whenever it is asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root, self._model = spark, root, None

    def get(self) -> Model:
        newest = latest_version(self._spark, self._root)
        if self._model is None or self._model.version != newest:
            if self._model is not None:
                self._model.release()
            self._model = load_model(self._spark, self._root, newest)
        return self._model
