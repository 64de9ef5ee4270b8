"""Deterministic train / validation split by unit, and checks on splits."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.cluster import attach, settle
from fleetlife.schema import SPLIT_SEED, VALIDATION_FRACTION

FLAG = "is_validation"


def _score(seed: int):
    # The hash depends on the argument type, so both are pinned to int.
    return F.xxhash64(F.col("unit_id").cast("int"), F.lit(seed).cast("int"))


def split_thresholds(df: DataFrame, fraction=VALIDATION_FRACTION, seed=SPLIT_SEED) -> DataFrame:
    """Per subset, the (hash, unit) of the last validation unit in hash order.

    The k-th smallest hash is found by counting hash buckets first, then ranking
    the units of the one bucket the k-th falls into; units are never all sorted.
    A subset with a single unit cannot be split and has nulls.
    """
    if not 0.0 < fraction < 1.0:
        raise ValueError("the validation fraction must lie strictly between 0 and 1")
    units = df.select("subset", "unit_id").distinct().withColumn("score", _score(seed))
    scored = units.withColumn("bucket", F.shiftright("score", 48))
    sizes = scored.groupBy("subset", "bucket").agg(F.count(F.lit(1)).alias("n"))
    subset = Window.partitionBy("subset")
    ranked = sizes.select(
        "subset",
        "bucket",
        "n",
        F.sum("n").over(subset).alias("n_units"),
        F.sum("n").over(subset.orderBy("bucket")).alias("through"),
    )
    wanted = F.least(F.col("n_units") - 1, F.greatest(F.lit(1), F.floor(F.col("n_units") * F.lit(fraction) + 0.5)))
    edge = ranked.withColumn("k", F.greatest(F.lit(1), wanted))
    edge = edge.where((F.col("through") >= F.col("k")) & (F.col("through") - F.col("n") < F.col("k")))
    edge = edge.select("subset", "bucket", "n_units", (F.col("k") - F.col("through") + F.col("n")).alias("rest"))
    in_edge = scored.join(edge, ["subset", "bucket"])
    rank = F.row_number().over(Window.partitionBy("subset").orderBy("score", "unit_id"))
    several = F.col("n_units") > 1
    return (
        in_edge.withColumn("rank", rank)
        .where(F.col("rank") == F.col("rest"))
        .select("subset", F.when(several, F.col("score")).alias("last_score"), F.when(several, F.col("unit_id")).alias("last_unit"))
    )


def flag_validation(df: DataFrame, fraction=VALIDATION_FRACTION, seed=SPLIT_SEED, thresholds: DataFrame | None = None) -> DataFrame:
    """Add ``is_validation``: a comparison per row, the rows do not move."""
    if thresholds is None:
        thresholds = settle(split_thresholds(df, fraction, seed))
        single = thresholds.where(F.col("last_unit").isNull()).take(1)
        if single:
            raise ValueError(f"at least two units are required for a split: {single[0]['subset']}")
    score = _score(seed)
    inside = (score < F.col("last_score")) | ((score == F.col("last_score")) & (F.col("unit_id") <= F.col("last_unit")))
    return attach(df, thresholds, "subset", "left").select(*df.columns, inside.alias(FLAG))


def split_by_unit(df: DataFrame, fraction=VALIDATION_FRACTION, seed=SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(train, validation); the units stay whole."""
    flagged = flag_validation(df, fraction, seed)
    return flagged.where(~F.col(FLAG)).drop(FLAG), flagged.where(F.col(FLAG)).drop(FLAG)


def lost_rows(original: DataFrame, *parts: DataFrame) -> DataFrame:
    """Rows that the parts lose or invent, duplicates counted: one signed count of equal rows."""
    marked = original.withColumn("__n", F.lit(1))
    for part in parts:
        marked = marked.unionByName(part.withColumn("__n", F.lit(-1)))
    balance = marked.groupBy(*original.columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    side = F.when(F.col("__n") > 0, "lost").otherwise("invented")
    copies = F.explode(F.sequence(F.lit(1), F.abs("__n")))
    return balance.select(*original.columns, side.alias("side"), copies.alias("__copy")).drop("__copy")


def shared_units(left: DataFrame, right: DataFrame, keys=("subset", "unit_id")) -> DataFrame:
    """Units present in both parts; empty for a proper split."""
    return left.select(*keys).intersect(right.select(*keys))


def part_counts(df: DataFrame, by) -> DataFrame:
    """Rows and distinct units per group, one aggregate."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("unit_id").alias("n_units"))
