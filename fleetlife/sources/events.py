"""Telemetry and prediction-traffic views over a table of user events.

Each user stands for an engine and each of its events, in time order, for one cycle.
Two of the four subsets run under one operating condition, two under several.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.operators.trajectory import HEAVY_ROWS, number_by_time, with_unit_facts
from fleetlife.schema import TERMINAL_COLUMN

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, columns) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet").select(*columns)


def telemetry_view(events: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(subset, unit_id, cycle, 3 settings, 5 sensors) from (event_id, ts, user_id, value, props)."""
    numbered = number_by_time(events, ["user_id"], "ts", ["event_id"], "cycle", heavy_rows)
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    several = F.col("user_id") % 2 == 1
    level = F.floor(F.hour("ts") / 6)
    early_even = (F.hour("ts") < 6) & (F.col("k") % 2 == 0)
    return numbered.withColumn("k", k).select(
        F.concat(F.lit("FD00"), (1 + F.col("user_id") % 4).cast("string")).alias("subset"),
        (F.col("user_id") + 1).cast("int").alias("unit_id"),
        "cycle",
        (F.when(several, 10.0 * level).otherwise(F.lit(0.0)) + F.col("value") / 2000).alias("setting_1"),
        (F.when(several, 0.25 * (F.col("k") % 2)).otherwise(F.lit(0.0)) + F.col("k") / 100000.0).alias("setting_2"),
        F.lit(100.0).alias("setting_3"),
        F.lit(518.67).alias("sensor_1"),
        F.col("value").alias("sensor_2"),
        F.col("k").cast("double").alias("sensor_3"),
        (F.col("value") * F.col("k")).alias("sensor_4"),
        F.when(several & early_even, F.lit(1.0)).otherwise(F.col("value")).alias("sensor_5"),
    )


def telemetry(spark: SparkSession, folder: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    return telemetry_view(read_events(spark, folder, ["event_id", "ts", "user_id", "value", "props"]), heavy_rows)


def history_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Last cycle per unit, counted without numbering the rows."""
    return (
        read_events(spark, folder, ["user_id"])
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).cast("int").alias("last_cycle"))
        .select(
            F.concat(F.lit("FD00"), (1 + F.col("user_id") % 4).cast("string")).alias("subset"),
            (F.col("user_id") + 1).cast("int").alias("unit_id"),
            "last_cycle",
        )
    )


def truncated_telemetry(spark: SparkSession, folder: str) -> DataFrame:
    """Histories cut halfway: cycles up to floor(n / 2)."""
    rows = telemetry(spark, folder)
    seen = with_unit_facts(rows, history_lengths(spark, folder))
    return seen.where(F.col("cycle") <= F.floor(F.col("last_cycle") / 2)).select(*rows.columns)


def terminal_view(spark: SparkSession, folder: str) -> DataFrame:
    """Official terminal RUL of the cut histories: the cycles cut off."""
    rest = F.col("last_cycle") - F.floor(F.col("last_cycle") / 2)
    return history_lengths(spark, folder).select("subset", "unit_id", rest.cast("int").alias(TERMINAL_COLUMN))


def prediction_log(events: DataFrame) -> DataFrame:
    """Prediction traffic from (ts, user_id, event_type, value)."""
    models = F.array(F.lit("random_forest"), F.lit("gradient_boosted"), F.lit("sequence"))
    return events.select(
        "ts",
        F.concat(F.lit("FD00"), (1 + F.col("user_id") % 4).cast("string")).alias("subset"),
        F.get(models, (F.col("user_id") % 3).cast("int")).alias("model_type"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 100).alias("latency_s"),
        F.col("value").alias("predicted_rul"),
    )


def prediction_traffic(spark: SparkSession, folder: str) -> DataFrame:
    return prediction_log(read_events(spark, folder, ["ts", "user_id", "event_type", "value"]))
