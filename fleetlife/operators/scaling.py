"""Sensor scaling: statistics as tables, applied by a lookup join.

The canonical state is long: (subset, regime, sensor, mean, std), with a null
regime for subset-wide statistics.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.cluster import attach
from fleetlife.functions.expressions import zscore

GLOBAL = "global"
BY_REGIME = "regime-aware"


def _deviation(name: str, sample: bool):
    spread = F.stddev_samp(name) if sample else F.stddev_pop(name)
    # A sensor without variance has exactly 0, whatever the rounding of the moments.
    return F.when(F.min(name) == F.max(name), F.lit(0.0)).otherwise(spread)


def _long(wide: DataFrame, keys, sensors) -> DataFrame:
    entries = [
        F.struct(F.lit(name).alias("sensor"), F.col(f"mean__{name}").alias("mean"), F.col(f"std__{name}").alias("std"))
        for name in sensors
    ]
    return wide.select(*keys, F.inline(F.array(*entries))).where(F.col("mean").isNotNull())


def fit_global(train: DataFrame, sensors) -> DataFrame:
    """Mean and sample deviation per subset."""
    stats = [e for s in sensors for e in (F.avg(s).alias(f"mean__{s}"), _deviation(s, True).alias(f"std__{s}"))]
    wide = train.groupBy("subset").agg(*stats).withColumn("regime", F.lit(None).cast("int"))
    return _long(wide, ["subset", "regime"], sensors)


def fit_by_regime(train: DataFrame, sensors) -> DataFrame:
    """Mean and population deviation per subset and regime."""
    stats = [e for s in sensors for e in (F.avg(s).alias(f"mean__{s}"), _deviation(s, False).alias(f"std__{s}"))]
    return _long(train.groupBy("subset", "regime").agg(*stats), ["subset", "regime"], sensors)


def strategies(mapping: DataFrame) -> DataFrame:
    """Single-regime subsets scale globally, the others by regime."""
    count = F.count(F.lit(1))
    return mapping.groupBy("subset").agg(
        count.alias("n_regimes"), F.when(count == 1, GLOBAL).otherwise(BY_REGIME).alias("scaling_strategy")
    )


def moments(sensors) -> list:
    """Mean and both deviations of each sensor, as aggregates."""
    stats = []
    for s in sensors:
        stats += [
            F.avg(s).alias(f"mean__{s}"),
            _deviation(s, True).alias(f"samp__{s}"),
            _deviation(s, False).alias(f"pop__{s}"),
        ]
    return stats


def fit_by_strategy(train: DataFrame, mapping: DataFrame, sensors) -> DataFrame:
    """Statistics of all subsets at once, each under its own strategy."""
    return choose_by_strategy(train.groupBy("subset", "regime").agg(*moments(sensors)), mapping, sensors)


def choose_by_strategy(grouped: DataFrame, mapping: DataFrame, sensors) -> DataFrame:
    """Pick the deviation of each subset's strategy from moments by (subset, regime).

    A subset with a single regime has one group, which is the subset, so the same
    aggregate serves both strategies.
    """
    chosen = grouped.join(strategies(mapping), "subset")
    single = F.col("scaling_strategy") == GLOBAL
    wide = chosen.select(
        "subset",
        "regime",
        "scaling_strategy",
        *(F.col(f"mean__{s}") for s in sensors),
        *(F.when(single, F.col(f"samp__{s}")).otherwise(F.col(f"pop__{s}")).alias(f"std__{s}") for s in sensors),
    )
    return _long(wide, ["subset", "regime", "scaling_strategy"], sensors)


def widen(scaler: DataFrame, sensors, by_regime: bool) -> DataFrame:
    """One row per subset (and regime) with a mean and a std column per sensor."""
    keys = ["subset", "regime"] if by_regime else ["subset"]
    picks = []
    for s in sensors:
        here = F.col("sensor") == s
        picks += [
            F.max(F.when(here, F.col("mean"))).alias(f"mean__{s}"),
            F.max(F.when(here, F.col("std"))).alias(f"std__{s}"),
        ]
    return scaler.groupBy(*keys).agg(*picks)


def apply_scaler(df: DataFrame, scaler: DataFrame, sensors, by_regime: bool = True) -> DataFrame:
    """Scale the listed sensors in place; a regime without statistics gives null."""
    keys = ["subset", "regime"] if by_regime else ["subset"]
    found = attach(df, widen(scaler, sensors, by_regime), keys, "left")
    wanted = set(sensors)
    return found.select(
        *(
            zscore(F.col(name), F.col(f"mean__{name}"), F.col(f"std__{name}")).alias(name)
            if name in wanted
            else F.col(name)
            for name in df.columns
        )
    )


def scaled_moments(scaled: DataFrame, sensors, keys=("subset", "regime"), sample=False) -> DataFrame:
    """Mean and deviation of scaled sensors per group, long."""
    spread = F.stddev_samp if sample else F.stddev_pop
    stats = [e for s in sensors for e in (F.avg(s).alias(f"mean__{s}"), spread(s).alias(f"std__{s}"))]
    return _long(scaled.groupBy(*keys).agg(*stats), list(keys), sensors)


def moment_violations(moments: DataFrame, tolerance=1e-9) -> DataFrame:
    """Groups whose mean is not 0, or whose deviation is neither 1 nor 0."""
    off_mean = F.abs(F.col("mean")) > tolerance
    off_spread = (F.abs(F.col("std") - 1) > tolerance) & (F.abs(F.col("std")) > tolerance)
    return moments.where(off_mean | F.coalesce(off_spread, F.lit(False)))
