"""Operating regimes: distinct rounded settings, numbered per subset."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.cluster import attach
from fleetlife.functions.expressions import regime_keys
from fleetlife.schema import SETTINGS

KEYS = tuple(f"key_{name}" for name in SETTINGS)


def fit_regimes(train: DataFrame) -> DataFrame:
    """(subset, rounded settings, regime): regimes numbered from 1 in key order."""
    return number_regimes(train.select("subset", *regime_keys()).distinct())


def number_regimes(seen: DataFrame) -> DataFrame:
    """Number the distinct settings of each subset."""
    number = F.dense_rank().over(Window.partitionBy("subset").orderBy(*KEYS))
    return seen.select("subset", *KEYS, number.cast("int").alias("regime"))


def join_regimes(df: DataFrame, mapping: DataFrame, strict=False) -> DataFrame:
    """Left lookup of the regime; null, or with ``strict`` an error of the job, where the
    settings were not seen in training."""
    if "regime" in df.columns:
        raise ValueError("the input already has a regime column")
    found = attach(df.select("*", *regime_keys()), mapping, ["subset", *KEYS], "left")
    if strict:
        settings = F.concat_ws(" ", "subset", *(F.col(k).cast("string") for k in KEYS))
        unseen = F.raise_error(F.concat(F.lit("settings unseen in training: "), settings)).cast("int")
        found = found.withColumn("regime", F.when(F.col("regime").isNull(), unseen).otherwise(F.col("regime")))
    columns = list(df.columns)
    columns.insert(columns.index("cycle") + 1 if "cycle" in columns else 0, "regime")
    return found.select(*columns)


def unseen_regimes(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct setting keys of ``df`` that the mapping does not know."""
    keys = df.select("subset", *regime_keys()).distinct()
    return keys.join(mapping, ["subset", *KEYS], "left_anti")


def assign_regimes(df: DataFrame, mapping: DataFrame, strict=True) -> DataFrame:
    """Regime per row; with ``strict``, unseen settings are an error.

    The lookup itself raises it, when the rows are read: no pass over the rows goes ahead.
    ``unseen_regimes`` lists the settings.
    """
    if strict and not mapping.take(1):
        raise ValueError("the regime mapping is empty")
    return join_regimes(df, mapping, strict)


def regimes_per_subset(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("subset").agg(F.count(F.lit(1)).alias("n_regimes"))
