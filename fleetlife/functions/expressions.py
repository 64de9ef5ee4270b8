"""Scalar and aggregate column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlife.schema import SETTING_DECIMALS, SETTINGS

# Time scales of the prediction score (early, late).
EARLY_SCALE = 13.0
LATE_SCALE = 10.0


def score_contribution(error: Column) -> Column:
    """Exponential penalty of one error; late (positive) errors cost more."""
    return F.when(error < 0, F.expm1(-error / EARLY_SCALE)).otherwise(F.expm1(error / LATE_SCALE))


def regime_keys() -> list[Column]:
    """Operating settings rounded half to even: the identity of a regime."""
    return [F.bround(F.col(name), digits).alias(f"key_{name}") for name, digits in zip(SETTINGS, SETTING_DECIMALS)]


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Standardised value; a sensor without variance is 0."""
    return F.when(std == 0, F.lit(0.0)).otherwise((value - mean) / std)


def missing(name: str, floating: bool) -> Column:
    test = F.col(name).isNull()
    return test | F.isnan(name) if floating else test


def infinite(name: str) -> Column:
    return F.abs(F.col(name)) == float("inf")


def hash_offset(seed: Column | int, unit: Column, span: Column) -> Column:
    """``first 8 bytes of sha256("seed:unit") mod span``, as an exact integer."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    text = F.concat_ws(":", seed.cast("string"), unit.cast("string"))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % span.cast("decimal(20,0)")).cast("int")


def capped(target: Column, cap) -> Column:
    return target if cap is None else F.least(target, F.lit(cap))


def target_name(cap) -> str:
    return "raw_rul" if cap is None else f"capped_rul_{cap:g}"


def regression_metrics(error: Column) -> list[Column]:
    """rmse, mae, summed score, bias and late rate of an error column, one pass."""
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.sum(score_contribution(error)).alias("rul_score"),
        F.avg(error).alias("bias"),
        F.avg((error > 0).cast("int")).alias("late_prediction_rate"),
    ]
