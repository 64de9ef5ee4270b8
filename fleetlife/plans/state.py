"""Learned preprocessing state: fit, check, store and apply.

State is one row per subset with nested lists (see ``schema.STATE``); it is applied
as small joined tables, never as driver dictionaries.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.cluster import settle
from fleetlife.functions.expressions import regime_keys
from fleetlife.operators import regimes, scaling, selection
from fleetlife.schema import SENSORS, SETTINGS, STATE, measurements_in, sensors_in

FIELDS = STATE.fieldNames()


@dataclass(frozen=True)
class Fitted:
    """Settled state tables: regimes, constant columns and sensor statistics."""

    mapping: DataFrame
    constants: DataFrame
    scaler: DataFrame


def fit(train: DataFrame) -> Fitted:
    """Learn regimes, constants and scaling of all subsets from one pass over the rows.

    The rows are aggregated once by rounded settings; the regimes are the groups, the
    ranges of the groups give the constants, and their moments the scaling.
    """
    names, sensors = measurements_in(train.columns), sensors_in(train.columns)
    grouped = train.select("*", *regime_keys()).groupBy("subset", *regimes.KEYS)
    profile = settle(grouped.agg(*selection.ranges(names), *scaling.moments(sensors)))
    mapping = settle(regimes.number_regimes(profile))
    spans = [f(f"{side}__{n}").alias(f"{side}__{n}") for n in names for side, f in (("lo", F.min), ("hi", F.max))]
    constants = settle(selection.constants_of_ranges(profile.groupBy("subset").agg(*spans), names))
    numbered = profile.join(mapping, ["subset", *regimes.KEYS])
    statistics = scaling.choose_by_strategy(numbered, mapping, sensors)
    retained = constants.select("subset", F.explode("retained_sensor_columns").alias("sensor"))
    return Fitted(mapping, constants, settle(statistics.join(retained, ["subset", "sensor"])))


def _in_order(sensor):
    return F.array_position(F.array(*(F.lit(name) for name in SENSORS)), sensor)


def as_rows(fitted: Fitted) -> DataFrame:
    """State tables as one row per subset, lists sorted."""
    record = F.struct("regime", *(F.col(f"key_{name}").alias(name) for name in SETTINGS))
    mapping = fitted.mapping.groupBy("subset").agg(F.array_sort(F.collect_list(record)).alias("m"))
    mapping = mapping.select(
        "subset", F.transform("m", lambda x: F.struct(*(x[n].alias(n) for n in SETTINGS), x["regime"].alias("regime"))).alias("regime_mapping")
    )
    entry = F.struct(_in_order(F.col("sensor")).alias("place"), "sensor", "mean", "std")
    stats = fitted.scaler.groupBy("subset", "scaling_strategy", "regime").agg(F.array_sort(F.collect_list(entry)).alias("s"))
    stats = stats.withColumn(
        "s", F.transform("s", lambda x: F.struct(x["sensor"].alias("sensor"), x["mean"].alias("mean"), x["std"].alias("std")))
    )
    by_regime = (
        stats.where(F.col("scaling_strategy") == scaling.BY_REGIME)
        .groupBy("subset")
        .agg(F.array_sort(F.collect_list(F.struct("regime", F.col("s").alias("sensors")))).alias("regime_sensor_scaler"))
    )
    whole = stats.where(F.col("scaling_strategy") == scaling.GLOBAL).select("subset", F.col("s").alias("global_sensor_scaler"))
    return (
        fitted.constants.join(mapping, "subset")
        .join(by_regime, "subset", "left")
        .join(whole, "subset", "left")
        .select("subset", *FIELDS)
    )


def to_json(state: DataFrame) -> DataFrame:
    keep = [name for name in state.columns if name not in FIELDS]
    text = F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"})
    return state.select(*keep, text.alias("state_json"))


def from_json(documents: DataFrame) -> DataFrame:
    keep = [name for name in documents.columns if name != "state_json"]
    return documents.select(*keep, F.from_json("state_json", STATE).alias("s")).select(*keep, "s.*")


def violations(state: DataFrame) -> DataFrame:
    """Broken state rows, with the reason: missing keys, or a bad list of retained sensors."""
    retained, dropped = F.col("retained_sensor_columns"), F.col("dropped_feature_columns")
    known = F.array(*(F.lit(name) for name in SENSORS))
    sorted_known = F.filter(known, lambda name: F.array_contains(retained, name))
    incomplete = F.exists(
        "regime_mapping", lambda m: m["regime"].isNull() | m["setting_1"].isNull() | m["setting_2"].isNull() | m["setting_3"].isNull()
    )
    reason = (
        F.when(F.col("regime_mapping").isNull() | retained.isNull() | dropped.isNull(), "missing key")
        .when(incomplete, "incomplete regime")
        .when(F.size(F.array_distinct(retained)) != F.size(retained), "duplicate sensor")
        .when(F.size(F.array_except(retained, known)) > 0, "unknown sensor")
        .when(retained != sorted_known, "sensors out of order")
        .when(F.size(F.array_intersect(retained, dropped)) > 0, "retained and dropped")
    )
    keep = [name for name in state.columns if name not in FIELDS]
    return state.select(*keep, reason.alias("reason")).where(F.col("reason").isNotNull())


def check(state: DataFrame) -> DataFrame:
    broken = violations(state).limit(10).collect()
    if broken:
        raise ValueError(f"invalid preprocessing state: {[tuple(row) for row in broken]}")
    return state


def as_tables(state: DataFrame) -> Fitted:
    """State rows back to joinable tables; global statistics are repeated per regime."""
    listed = state.select("subset", F.inline("regime_mapping"))
    mapping = listed.select("subset", *(F.col(n).alias(f"key_{n}") for n in SETTINGS), "regime")
    by_regime = state.select("subset", F.inline("regime_sensor_scaler")).select(
        "subset", F.inline("sensors"), "regime", F.lit(scaling.BY_REGIME).alias("scaling_strategy")
    )
    whole = (
        state.where(F.col("global_sensor_scaler").isNotNull())
        .select("subset", F.explode(F.transform("regime_mapping", lambda m: m["regime"])).alias("regime"), "global_sensor_scaler")
        .select("subset", F.inline("global_sensor_scaler"), "regime", F.lit(scaling.GLOBAL).alias("scaling_strategy"))
    )
    constants = state.select("subset", "dropped_feature_columns", "retained_sensor_columns")
    return Fitted(settle(mapping), settle(constants), settle(by_regime.unionByName(whole)))


def apply(df: DataFrame, fitted: Fitted, strict=True) -> DataFrame:
    """Regime, then scaled sensors; sensors a subset dropped become null."""
    assigned = regimes.assign_regimes(df, fitted.mapping, strict)
    return scaling.apply_scaler(assigned, fitted.scaler, sensors_in(df.columns))


def retained_sensors(fitted: Fitted) -> list[str]:
    """Sensors retained in at least one subset: at most 21 names."""
    names = fitted.constants.select(F.explode("retained_sensor_columns").alias("s")).distinct().collect()
    return sensors_in(row["s"] for row in names)


def save(state: DataFrame, path: str, run_id: str) -> None:
    to_json(state.withColumn("run_id", F.lit(run_id))).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    stored = spark.read.parquet(path).where(F.col("run_id") == run_id)
    return check(from_json(stored))
