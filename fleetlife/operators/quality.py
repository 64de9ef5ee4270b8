"""Data-quality checks. Each returns a violations frame; nothing is collected
until ``raise_if_any`` reports a bounded sample.

Violations: check STRING, subset STRING, column_name STRING, unit_id INT, n BIGINT.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.functions.expressions import infinite, missing
from fleetlife.schema import MEASUREMENTS, TELEMETRY_COLUMNS, TERMINAL_COLUMN, UNIT, is_integral, is_numeric

SAMPLE = 10


def require_columns(df: DataFrame, columns=TELEMETRY_COLUMNS) -> None:
    """Schema guard: the columns exist and are numeric."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise ValueError(f"schema check failed, missing columns: {absent}")
    wrong = [name for name in columns if not is_numeric(df.schema[name].dataType)]
    if wrong:
        raise ValueError(f"schema check failed, non-numeric columns: {wrong}")


def _present(df: DataFrame, columns):
    return [name for name in columns if name in df.columns]


def value_counts(df: DataFrame, columns=TELEMETRY_COLUMNS) -> DataFrame:
    """Missing and infinite values per subset and column, from one aggregate."""
    names = _present(df, columns)
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    counts = []
    for name in names:
        counts.append(F.count_if(missing(name, name in floating)).alias(f"missing__{name}"))
        if name in floating:
            counts.append(F.count_if(infinite(name)).alias(f"infinite__{name}"))
    wide = df.groupBy("subset").agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"missing__{name}").alias("n_missing"),
            (F.col(f"infinite__{name}") if name in floating else F.lit(0).cast("long")).alias("n_infinite"),
        )
        for name in names
    ]
    return wide.select("subset", "n_rows", F.inline(F.array(*entries)))


def value_violations(df: DataFrame, columns=TELEMETRY_COLUMNS) -> DataFrame:
    counts = value_counts(df, columns)
    measured = F.col("column_name").isin(*MEASUREMENTS)
    checks = F.array(
        F.struct(F.lit("missing-value").alias("check"), F.col("n_missing").alias("n")),
        F.struct(F.lit("finite-value").alias("check"), F.when(measured, F.col("n_infinite")).otherwise(F.lit(0)).alias("n")),
    )
    return (
        counts.select("subset", "column_name", F.inline(checks))
        .where("n > 0")
        .select("check", "subset", "column_name", F.lit(None).cast("int").alias("unit_id"), "n")
    )


def cycle_profile(df: DataFrame, keys=UNIT) -> DataFrame:
    """First and last cycle, rows and distinct cycles per unit: hash aggregates
    that combine map-side, no sort."""
    return df.groupBy(*keys).agg(
        F.min("cycle").alias("first_cycle"),
        F.max("cycle").alias("last_cycle"),
        F.count("cycle").alias("n_rows"),
        F.count_distinct("cycle").alias("n_cycles"),
    )


def cycle_violations(df: DataFrame, keys=UNIT) -> DataFrame:
    """Units whose cycles are not exactly 1, 2, ..., n."""
    profile = cycle_profile(df, keys)
    clean = (
        (F.col("first_cycle") == 1)
        & (F.col("last_cycle") == F.col("n_cycles"))
        & (F.col("n_rows") == F.col("n_cycles"))
    )
    return profile.where(~F.coalesce(clean, F.lit(False)))


def telemetry_violations(df: DataFrame) -> DataFrame:
    """All checks on telemetry rows: values first, then cycle sequences."""
    require_columns(df, _present(df, TELEMETRY_COLUMNS))
    sequences = cycle_violations(df).select(
        F.lit("cycle-sequence").alias("check"),
        "subset",
        F.lit("cycle").alias("column_name"),
        "unit_id",
        F.col("n_rows").alias("n"),
    )
    return value_violations(df).unionByName(sequences)


def empty_subsets(df: DataFrame, subsets) -> list[str]:
    """Subsets without a single row; an empty frame must not pass as valid."""
    seen = {row["subset"] for row in df.where(F.col("subset").isin(*subsets)).select("subset").distinct().collect()}
    return [name for name in subsets if name not in seen]


def unit_mismatch(test: DataFrame, terminal: DataFrame, keys=UNIT) -> DataFrame:
    """Units present on one side only: ``missing`` from the test histories or ``extra`` in them."""
    observed = test.select(*keys).distinct().withColumn("__observed", F.lit(1))
    official = terminal.select(*keys).distinct().withColumn("__official", F.lit(1))
    sides = observed.join(official, list(keys), "full")
    return sides.where(F.col("__observed").isNull() | F.col("__official").isNull()).select(
        *keys, F.when(F.col("__observed").isNull(), "missing").otherwise("extra").alias("side")
    )


def terminal_violations(test: DataFrame, terminal: DataFrame) -> DataFrame:
    """Checks before labelling truncated histories with official terminal RUL."""
    reserved = [name for name in ("RUL", TERMINAL_COLUMN, "last_cycle") if name in test.columns]
    if reserved:
        raise ValueError(f"test histories already contain {reserved}")
    absent = [name for name in ("unit_id", TERMINAL_COLUMN) if name not in terminal.columns]
    if absent:
        raise ValueError(f"terminal RUL lacks {absent}")
    wrong = [name for name in ("unit_id", TERMINAL_COLUMN) if not is_integral(terminal.schema[name].dataType)]
    if wrong:
        raise ValueError(f"terminal RUL columns must be integers: {wrong}")
    profile = terminal.groupBy("subset").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("unit_id").alias("n_units"),
        F.min("unit_id").alias("first_unit"),
        F.max("unit_id").alias("last_unit"),
        F.count_if(F.col("unit_id").isNull() | F.col(TERMINAL_COLUMN).isNull()).alias("n_null"),
        F.count_if(F.col(TERMINAL_COLUMN) < 0).alias("n_negative"),
    )
    numbered = (
        (F.col("first_unit") == 1)
        & (F.col("last_unit") == F.col("n_rows"))
        & (F.col("n_units") == F.col("n_rows"))
    )
    checks = F.array(
        F.struct(F.lit("terminal-null").alias("check"), F.col("n_null").alias("n")),
        F.struct(F.lit("terminal-negative").alias("check"), F.col("n_negative").alias("n")),
        F.struct(
            F.lit("terminal-numbering").alias("check"),
            F.when(F.coalesce(numbered, F.lit(False)), F.lit(0)).otherwise(F.col("n_rows")).alias("n"),
        ),
    )
    values = (
        profile.select("subset", F.inline(checks))
        .where("n > 0")
        .select("check", "subset", F.lit(TERMINAL_COLUMN).alias("column_name"), F.lit(None).cast("int").alias("unit_id"), "n")
    )
    units = unit_mismatch(test, terminal).select(
        F.concat(F.lit("unit-"), "side").alias("check"),
        "subset",
        F.lit("unit_id").alias("column_name"),
        "unit_id",
        F.lit(1).cast("long").alias("n"),
    )
    return values.unionByName(units)


def raise_if_any(violations: DataFrame, what: str) -> None:
    """Fail with totals per check and a bounded sample of units."""
    totals = violations.groupBy("check").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("cases")).collect()
    if not totals:
        return
    # At most one total per kind of check comes back; the sample is a plain limit.
    sample = [tuple(row) for row in violations.limit(SAMPLE).collect()]
    summary = ", ".join(f"{row['check']}: {row['cases']} cases, {row['n']} rows" for row in sorted(totals))
    raise ValueError(f"{what} failed validation ({summary}); sample={sample}")
