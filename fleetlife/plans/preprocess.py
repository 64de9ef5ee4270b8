"""Preprocessing of all selected subsets in one job: text in, model-ready tables out."""

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.operators import labels, quality, scaling, selection, split, temporal
from fleetlife.plans import runs, state
from fleetlife.schema import SPLIT_SEED, UNIT, VALIDATION_FRACTION, feature_columns
from fleetlife.sources import tables, telemetry_text


def label_and_split(train: DataFrame, test: DataFrame, terminal: DataFrame, fraction, seed) -> DataFrame:
    """Labelled rows of the three parts in one frame with a ``split`` column."""
    part = F.when(F.col(split.FLAG), "validation").otherwise("train")
    flagged = split.flag_validation(train, fraction, seed).withColumn("split", part).drop(split.FLAG)
    complete = labels.label_complete(flagged).select(*train.columns, "RUL", "split")
    return complete.unionByName(labels.label_truncated(test, terminal).withColumn("split", F.lit("test")))


def prepare(labelled: DataFrame, fitted: state.Fitted, include_temporal=False, contiguous=True, strict=True) -> DataFrame:
    """Regime, scaling, output layout and, on request, temporal features of all parts.

    A unit of the test part may share its id with a training unit, so the part belongs
    to the trajectory key.
    """
    sensors = state.retained_sensors(fitted)
    applied = state.apply(labelled, fitted, strict)
    ready = selection.model_ready(applied, sensors, ["split"])
    if not include_temporal:
        return ready
    # Validated rows have every reading; a sensor that its subset dropped has none.
    return temporal.temporal_features(ready, sensors, keys=("split", *UNIT), contiguous=contiguous, complete=True)


def summary(processed: DataFrame, fitted: state.Fitted) -> DataFrame:
    """Rows and units per part, with strategy, regimes and feature counts per subset."""
    counts = split.part_counts(processed.select("subset", "split", "unit_id"), ["subset", "split"])
    strategies = scaling.strategies(fitted.mapping)
    retained = fitted.constants.select("subset", F.size("retained_sensor_columns").alias("n_sensors"))
    per_sensor = len(feature_columns(processed.columns)) // max(1, len(state.retained_sensors(fitted)))
    # One row per subset on the right sides.
    return (
        counts.join(strategies, "subset")
        .join(retained, "subset")
        .withColumn("n_features", F.col("n_sensors") * F.lit(per_sensor))
        .drop("n_sensors")
    )


def run(
    spark: SparkSession,
    raw_folder: str,
    output_folder: str,
    subsets=None,
    fraction=VALIDATION_FRACTION,
    seed=SPLIT_SEED,
    include_temporal=False,
) -> DataFrame:
    """Text files of the subsets to processed Parquet, state and run records.

    Returns the run summary, one row per subset and part, with the run id. The text is
    parsed once into a staged Parquet table that all later passes read by column. A
    rerun has a new run id and leaves earlier output alone.
    """
    chosen = telemetry_text.normalise_subsets(subsets)
    absent = telemetry_text.missing_inputs(spark, raw_folder, chosen)
    if absent:
        raise FileNotFoundError(f"input files not found: {absent}")
    run_id = uuid.uuid4().hex
    started = datetime.datetime.now()
    staged = f"{output_folder}/staged/{run_id}"
    inputs = telemetry_text.input_patterns(raw_folder, chosen)
    for part in ("train", "test"):
        rows, rejected = telemetry_text.scan_telemetry(spark, inputs[part])
        rows.write.parquet(f"{staged}/{part}")
        rejected.write.json(f"{staged}/{part}_rejected")
    terminal, refused = telemetry_text.scan_terminal_rul(spark, inputs["terminal"])
    terminal.write.parquet(f"{staged}/terminal")
    wrong = refused.limit(quality.SAMPLE).collect()
    if wrong:
        raise ValueError(f"unusable terminal RUL lines: {[tuple(row) for row in wrong]}")

    train, test, terminal = (spark.read.parquet(f"{staged}/{name}") for name in ("train", "test", "terminal"))
    for part, rows in (("train", train), ("test", test)):
        empty = quality.empty_subsets(rows, chosen)
        if empty:
            raise ValueError(f"{part} histories without rows: {empty}")
        rejected = spark.read.schema("subset string, line string, tokens int").json(f"{staged}/{part}_rejected")
        broken = rejected.limit(quality.SAMPLE).collect()
        if broken:
            raise ValueError(f"{part} histories hold unreadable lines: {[tuple(row) for row in broken]}")
        quality.raise_if_any(quality.telemetry_violations(rows), f"{part} histories")
    quality.raise_if_any(quality.terminal_violations(test, terminal), "terminal RUL")

    label_and_split(train, test, terminal, fraction, seed).write.parquet(f"{staged}/labelled")
    labelled = spark.read.parquet(f"{staged}/labelled")
    fitted = state.fit(labelled.where(F.col("split") == "train").drop("split"))
    stored = state.check(state.as_rows(fitted))
    processed = prepare(labelled, fitted, include_temporal)
    most = train.groupBy("subset").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    files = max(1, -(-most // tables.ROWS_PER_FILE))
    target = f"{output_folder}/processed"
    tables.write_processed(processed, target, run_id, files=files)
    state.save(stored, f"{output_folder}/state", run_id)

    written = tables.read_processed(spark, target, run_id=run_id)
    report = summary(written, fitted).withColumn("run_id", F.lit(run_id))
    per_subset = report.groupBy("subset").agg(
        F.first("scaling_strategy").alias("scaling_strategy"), F.first("n_regimes").alias("n_regimes")
    )
    params = F.create_map(
        *(F.lit(x) for x in ("validation_fraction", str(fraction), "seed", str(seed), "include_temporal_features", str(include_temporal))),
        F.lit("scaling_strategy"),
        "scaling_strategy",
        F.lit("regime_count"),
        F.col("n_regimes").cast("string"),
    )
    records = per_subset.select(
        F.lit(run_id).alias("run_id"),
        F.lit("preprocessing").alias("kind"),
        "subset",
        F.lit(None).cast("string").alias("model_type"),
        F.lit(runs.FINISHED).alias("status"),
        F.lit(started).cast("timestamp_ntz").alias("start_time"),
        params.alias("params"),
        F.lit(None).cast("map<string,double>").alias("metrics"),
        F.lit(None).cast("map<string,string>").alias("tags"),
        F.lit(None).cast("array<string>").alias("features"),
    )
    runs.append(records, f"{output_folder}/runs")
    return report
