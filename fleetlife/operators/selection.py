"""Column selection learned from training rows: constants, retained sensors, model inputs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.functions.expressions import capped
from fleetlife.schema import PROTECTED, feature_columns, measurements_in, sensors_in


def ranges(names) -> list:
    """Minimum and maximum of each column, as ``lo__`` and ``hi__`` aggregates."""
    return [f(name).alias(f"{side}__{name}") for name in names for side, f in (("lo", F.min), ("hi", F.max))]


def constant_columns(train: DataFrame) -> DataFrame:
    """Per subset, the measurements with one single value, and the sensors that remain.

    One aggregate of minima and maxima. A column that is null throughout is not
    constant.
    """
    names = measurements_in(train.columns)
    return constants_of_ranges(train.groupBy("subset").agg(*ranges(names)), names)


def constants_of_ranges(spans: DataFrame, names) -> DataFrame:
    """Constant and retained columns from per-subset ranges."""

    def picked(wanted, keep):
        flags = [
            F.when(F.coalesce(F.col(f"lo__{name}") == F.col(f"hi__{name}"), F.lit(False)) == keep, F.lit(name))
            for name in wanted
        ]
        return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")

    return spans.select(
        "subset",
        picked(names, True).alias("dropped_feature_columns"),
        picked(sensors_in(names), False).alias("retained_sensor_columns"),
    )


def drop_columns(df: DataFrame, columns) -> DataFrame:
    """Drop learned columns; keys and target are protected."""
    kept = sorted(set(columns) & set(PROTECTED))
    if kept:
        raise ValueError(f"protected columns cannot be removed: {', '.join(kept)}")
    return df.drop(*columns)


def model_ready(df: DataFrame, sensors, extra=()) -> DataFrame:
    """Keys, target, regime and the sensors, in the order models are trained with."""
    return df.select("subset", *extra, "unit_id", "cycle", "RUL", F.col("regime").alias("operating_regime"), *sensors)


def model_inputs(df: DataFrame, features=None) -> DataFrame:
    """Features (a stored list in its order, or all but metadata) and the target."""
    names = feature_columns(df.columns) if features is None else list(features)
    return df.select(*names, "RUL")


def cap_target(df: DataFrame, cap) -> DataFrame:
    return df.withColumn("RUL", capped(F.col("RUL"), cap))


def dense_float_features(df: DataFrame, features) -> DataFrame:
    """Sequence-model inputs: missing features become 0, 32-bit floats."""
    wanted = set(features)
    return df.select(
        *(
            F.coalesce(F.nanvl(F.col(name), F.lit(0.0)), F.lit(0.0)).cast("float").alias(name)
            if name in wanted
            else F.col(name)
            for name in df.columns
        )
    )
