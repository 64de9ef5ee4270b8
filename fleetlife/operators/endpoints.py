"""Evaluation endpoints: simulated cutoffs, official terminal rows, sampled cycles."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.cluster import attach
from fleetlife.functions.expressions import hash_offset
from fleetlife.operators.trajectory import last_rows
from fleetlife.schema import OBSERVED_FRACTION, SPLIT_SEED, TERMINAL_COLUMN, UNIT


def cutoffs(df: DataFrame, seeds=SPLIT_SEED, fraction=OBSERVED_FRACTION, keys=UNIT) -> DataFrame:
    """One pre-failure cutoff cycle per unit and seed, spread by a hash of seed and unit.

    ``seeds`` is one seed or several; per-unit bounds are aggregated once and the
    seeds multiply the (small) bounds, never the telemetry.
    """
    bounds = df.groupBy(*keys).agg(F.min("cycle").alias("__min"), F.max("cycle").alias("__max"))
    first = F.greatest(F.col("__min"), F.ceil(F.col("__max") * F.lit(float(fraction))).cast("int"))
    spans = bounds.select(*keys, first.alias("first_cycle"), (F.col("__max") - first).alias("span"))
    several = [seeds] if isinstance(seeds, int) else list(seeds)
    seeded = spans.withColumn("seed", F.explode(F.array(*(F.lit(seed) for seed in several))))
    offset = F.when(F.col("span") >= 1, hash_offset(F.col("seed"), F.col("unit_id"), F.col("span")))
    return seeded.select(*keys, "seed", "span", (F.col("first_cycle") + offset).alias("cycle"))


def pseudo_endpoints(df: DataFrame, seeds=SPLIT_SEED, fraction=OBSERVED_FRACTION, keys=UNIT) -> DataFrame:
    """The rows at the cutoffs. The join key holds the cycle, so no unit is hot."""
    chosen = cutoffs(df, seeds, fraction, keys).where(F.col("cycle").isNotNull()).drop("span")
    return df.join(chosen, [*keys, "cycle"])


def endpoint_violations(df: DataFrame, seeds=SPLIT_SEED, fraction=OBSERVED_FRACTION, keys=UNIT) -> DataFrame:
    """Units too short for a cutoff, or whose cutoff row does not exist exactly once."""
    chosen = cutoffs(df, seeds, fraction, keys)
    rows = df.select(*keys, "cycle").withColumn("__hit", F.lit(1))
    hits = chosen.join(rows, [*keys, "cycle"], "left").groupBy(*keys, "seed").agg(
        F.max("span").alias("span"), F.count("__hit").alias("n_rows")
    )
    reason = F.when(F.col("span") < 1, "needs two observed cycles").otherwise("no unique cutoff row")
    return hits.where((F.col("span") < 1) | (F.col("n_rows") != 1)).select(*keys, "seed", reason.alias("reason"))


def raise_on_endpoint_violations(df: DataFrame, seeds=SPLIT_SEED, fraction=OBSERVED_FRACTION, keys=UNIT) -> None:
    bad = endpoint_violations(df, seeds, fraction, keys).limit(10).collect()
    if bad:
        raise ValueError(f"units without a usable cutoff: {[tuple(row) for row in bad]}")


def official_endpoints(test: DataFrame, terminal: DataFrame, keys=UNIT) -> DataFrame:
    """Last row of every truncated unit with its official RUL instead of the stored one.

    The join is one to one: a unit with several official records is an error of the job.
    """
    last = last_rows(test, [c for c in test.columns if c != "RUL"], keys)
    return last.join(single_records(terminal, keys).withColumnRenamed(TERMINAL_COLUMN, "RUL"), list(keys))


def single_records(terminal: DataFrame, keys=UNIT) -> DataFrame:
    """Official RUL per unit; reading a unit that has several records fails."""
    counted = terminal.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(TERMINAL_COLUMN).alias(TERMINAL_COLUMN))
    unit = F.concat_ws(" ", *(F.col(k).cast("string") for k in keys))
    several = F.raise_error(F.concat(F.lit("several official records for unit "), unit)).cast("int")
    return counted.select(*keys, F.when(F.col("__n") > 1, several).otherwise(F.col(TERMINAL_COLUMN)).alias(TERMINAL_COLUMN))


def duplicate_units(terminal: DataFrame, keys=UNIT) -> DataFrame:
    """Units with several official records; the official join must be one to one."""
    return terminal.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def random_rows(df: DataFrame, seed: int, minimum_cycle=0, keys=UNIT) -> DataFrame:
    """One row per unit, picked by hash order: stable under any partitioning."""
    eligible = df.where(F.col("cycle") >= minimum_cycle)
    # A plain number, so that the aggregate hashes instead of sorting.
    draw = F.xxhash64(F.col("unit_id"), F.col("cycle"), F.lit(seed))
    picks = [F.min_by(name, "__draw").alias(name) for name in df.columns if name not in keys]
    return eligible.withColumn("__draw", draw).groupBy(*keys).agg(*picks)


def quotas(subsets: DataFrame, total: int) -> DataFrame:
    """Share ``total`` requests over the subsets; the first ones take the remainder."""
    known = subsets.select("subset").distinct()
    place = F.row_number().over(Window.orderBy("subset")) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return known.select("subset", place.alias("place"), n.alias("n")).select(
        "subset", (F.floor(F.lit(total) / F.col("n")) + (F.col("place") < F.lit(total) % F.col("n")).cast("int")).cast("int").alias("quota")
    )


def sample_units(picks: DataFrame, shares: DataFrame, seed: int, strict=False) -> DataFrame:
    """Per subset, ``quota`` units in hash order; with ``strict``, fewer are an error.

    The rank limit is applied before the shuffle, so at most quota rows per task
    and subset move.
    """
    if strict:
        lacking = short_subsets(picks, shares).collect()
        if lacking:
            raise ValueError(f"subsets with too few units for their quota: {[tuple(row) for row in lacking]}")
    most = shares.agg(F.max("quota").alias("quota")).first()["quota"] or 0
    order = Window.partitionBy("subset").orderBy(F.xxhash64(F.col("unit_id"), F.lit(seed)), "unit_id")
    ranked = picks.withColumn("draw", F.row_number().over(order)).where(F.col("draw") <= most)
    return attach(ranked, shares, "subset").where(F.col("draw") <= F.col("quota")).drop("quota")


def short_subsets(sampled: DataFrame, shares: DataFrame) -> DataFrame:
    """Subsets that could not fill their quota."""
    got = sampled.groupBy("subset").agg(F.count(F.lit(1)).alias("n"))
    filled = shares.join(got, "subset", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return filled.where(F.col("n") < F.col("quota"))
