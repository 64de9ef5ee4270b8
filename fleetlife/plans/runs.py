"""Run records: parameters, metrics, tags, and how runs are found."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlife.schema import SUBSETS

FINISHED = "FINISHED"

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("subset", T.StringType(), False),
        T.StructField("model_type", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("start_time", T.TimestampNTZType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("features", T.ArrayType(T.StringType())),
    ]
)


def record(spark: SparkSession, run_id, kind, subset, start_time, model_type=None, status=FINISHED, params=None, metrics=None, tags=None, features=None) -> DataFrame:
    """One run as a row."""
    texts = {key: str(value) for key, value in (params or {}).items()}
    values = {key: float(value) for key, value in (metrics or {}).items()}
    row = (run_id, kind, subset, model_type, status, start_time, texts, values, tags or {}, features)
    return spark.createDataFrame([row], RUNS)


def with_names(runs: DataFrame) -> DataFrame:
    """Readable run names: subset and kind, or subset, model, feature set and target."""
    trained = F.format_string("%s-%s-%s-%s", "subset", "model_type", F.col("tags")["feature_set"], F.col("params")["target"])
    return runs.withColumn(
        "run_name", F.when(F.col("kind") == "training", trained).otherwise(F.format_string("%s-%s", "subset", "kind"))
    )


def append(runs: DataFrame, path: str) -> None:
    runs.coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def latest(runs: DataFrame, by=("subset", "model_type")) -> DataFrame:
    """Newest finished run per group; equal start times go to the larger id."""
    finished = runs.where(F.col("status") == FINISHED)
    newest = finished.groupBy(*by).agg(F.max(F.struct("start_time", "run_id")).alias("newest"))
    return newest.select(*by, F.col("newest.run_id").alias("run_id"), F.col("newest.start_time").alias("start_time"))


def find(runs: DataFrame, subset: str, kind: str = "preprocessing", model_type: str | None = None) -> str:
    """Id of the newest finished run of a subset."""
    name = subset.upper()
    if name not in SUBSETS:
        raise ValueError(f"unsupported subset: {subset}")
    if kind not in ("preprocessing", "training"):
        raise ValueError(f"unsupported kind of run: {kind}")
    wanted = runs.where((F.col("subset") == name) & (F.col("kind") == kind))
    if model_type is not None:
        wanted = wanted.where(F.col("model_type") == model_type)
    hit = latest(wanted, ("subset",)).first()
    if hit is None:
        raise ValueError(f"no finished {kind} run for {name}")
    return hit["run_id"]


def resolve(runs: DataFrame) -> DataFrame:
    """Training runs with the preprocessing run they were trained on.

    A training run without one, or whose subset differs, keeps a null there.
    """
    trained = runs.where(F.col("kind") == "training").select(
        F.col("run_id").alias("training_run_id"),
        "subset",
        "model_type",
        F.col("params")["preprocessing_run_id"].alias("wanted"),
        "features",
    )
    prepared = runs.where(F.col("kind") == "preprocessing").select(
        F.col("run_id").alias("preprocessing_run_id"), F.col("subset").alias("prepared_subset")
    )
    matches = (F.col("wanted") == F.col("preprocessing_run_id")) & (F.col("subset") == F.col("prepared_subset"))
    return trained.join(prepared, matches, "left").drop("wanted", "prepared_subset")


def unresolved(runs: DataFrame) -> DataFrame:
    return resolve(runs).where(F.col("preprocessing_run_id").isNull()).select("training_run_id", "subset")


def missing(available: DataFrame, subsets: DataFrame, feature_sets) -> DataFrame:
    """Required (subset, feature_set) pairs without a run; ``feature_sets`` is a list of names."""
    names = F.array(*(F.lit(name) for name in feature_sets))
    required = subsets.select("subset").distinct().withColumn("feature_set", F.explode(names))
    return required.join(available.select("subset", "feature_set").distinct(), ["subset", "feature_set"], "left_anti")


def run_list(**sources: DataFrame) -> DataFrame:
    """Runs from several sources in one list, each with its ``source`` name."""
    listed = None
    for name, frame in sources.items():
        part = frame.withColumn("source", F.lit(name))
        listed = part if listed is None else listed.unionByName(part, allowMissingColumns=True)
    return listed


def metric_series(spark: SparkSession, run_id: str, name: str, values) -> DataFrame:
    """One row per training step."""
    rows = [(run_id, name, step, float(value)) for step, value in enumerate(values, start=1)]
    return spark.createDataFrame(rows, "run_id string, metric string, step int, value double")
