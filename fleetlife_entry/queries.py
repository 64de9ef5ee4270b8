"""Registered queries: every operator, run over the given tables.

Each takes (spark, folder) and returns a lazy DataFrame. Doubles are rounded to six
digits so that two engines can be compared by value.
"""


import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.cluster import attach, ensure_checkpoint_dir, settle, stored
from fleetlife.operators import (
    changes,
    endpoints,
    evaluation,
    labels,
    monitoring,
    quality,
    regimes,
    scaling,
    selection,
    sequences,
    sketches,
    split,
    temporal,
    trajectory,
)
from fleetlife.plans import models, preprocess, runs, scoring, state
from fleetlife.schema import TELEMETRY, TERMINAL_COLUMN, sensors_in
from fleetlife.sources import events as source
from fleetlife.sources import requests, tables, telemetry_text
from fleetlife.streaming import changes as live_changes
from fleetlife.streaming import corrections, live_features, traffic

SCALE = 1e6
SHIFT = 1e-10
SENSORS = ["sensor_2", "sensor_3", "sensor_4", "sensor_5"]
SEQUENCE_FEATURES = ["sensor_2", "sensor_3"]
SEEDS = tuple(range(42, 52))
WINDOW = "6 hours"
GAPPY_BELOW = 40.0
#: Hash buckets of units and blocks that a part of a subset is written in.
FILES = 16

REGISTRY = {}


def query(function):
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame) -> DataFrame:
    """Six digits, in plain arithmetic. The shift moves decimal halves off the rounding
    edge, where the last bit of a mean would decide; adding zero clears its sign."""
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*((F.rint((F.col(c) + SHIFT) * SCALE) / SCALE + F.lit(0.0)).alias(c) if c in doubles else F.col(c) for c in df.columns))


# ---------------------------------------------------------------- inputs


def complete(spark, folder) -> DataFrame:
    """Run-to-failure telemetry with RUL."""
    rows = source.telemetry(spark, folder)
    labelled = trajectory.with_unit_facts(rows, source.history_lengths(spark, folder))
    return labelled.select(*rows.columns, (F.col("last_cycle") - F.col("cycle")).cast("int").alias("RUL"))


def truncated(spark, folder) -> DataFrame:
    """Histories cut halfway, labelled with the official terminal RUL."""
    rows = source.truncated_telemetry(spark, folder)
    return labels.label_truncated(rows, source.terminal_view(spark, folder))


def faulty(spark, folder) -> DataFrame:
    """Telemetry with nulls, NaN and infinities derived from the readings."""
    rows = source.telemetry(spark, folder)
    k = F.col("sensor_3")
    return rows.withColumn("sensor_4", F.when(F.col("sensor_2") > 50, float("inf")).otherwise(F.col("sensor_4"))).withColumn(
        "sensor_3", F.when(k < 10, F.lit(None).cast("double")).when(k > 90, float("nan")).otherwise(k)
    )


def gappy(spark, folder) -> DataFrame:
    """Telemetry without its high readings: the cycle axis has gaps."""
    return source.telemetry(spark, folder).where(F.col("sensor_2") < GAPPY_BELOW)


def with_regimes(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = source.telemetry(spark, folder)
    mapping = settle(regimes.fit_regimes(rows))
    return regimes.join_regimes(rows, mapping), mapping


def mean_life_predictions(spark, folder) -> DataFrame:
    """Predictor without learning: mean life of the subset minus the age, at least 0."""
    lengths = source.history_lengths(spark, folder)
    life = lengths.groupBy("subset").agg(F.avg("last_cycle").alias("life"))
    rows = complete(spark, folder).select("subset", "unit_id", "cycle", "RUL")
    predicted = attach(rows, settle(life), "subset")
    return predicted.select(
        "subset", "unit_id", "cycle", "RUL", F.greatest(F.lit(0.0), F.col("life") - F.col("cycle")).alias("prediction")
    )


def candidate_predictions(spark, folder) -> DataFrame:
    """Two candidates at the cutoffs of ten seeds: mean life, and mean life capped at 30."""
    at = endpoints.cutoffs(source.telemetry(spark, folder).select("subset", "unit_id", "cycle"), SEEDS)
    chosen = at.where(F.col("cycle").isNotNull()).select("subset", "unit_id", "cycle", "seed")
    points = mean_life_predictions(spark, folder).join(chosen, ["subset", "unit_id", "cycle"])
    roles = F.array(
        F.struct(F.lit("mean_life").alias("candidate"), F.lit("champion").alias("role"), F.col("prediction").alias("p")),
        F.struct(
            F.lit("capped_mean_life").alias("candidate"),
            F.lit("competitor").alias("role"),
            F.least(F.col("prediction"), F.lit(30.0)).alias("p"),
        ),
    )
    return points.select("subset", "unit_id", "cycle", "seed", "RUL", F.inline(roles)).withColumnRenamed("p", "prediction")


def seed_metrics(spark, folder) -> DataFrame:
    return settle(evaluation.all_metrics(candidate_predictions(spark, folder), ("subset", "candidate", "role", "seed")))


# ---------------------------------------------------------------- ingest and quality


@query
def telemetry(spark, folder):
    return rounded(source.telemetry(spark, folder))


@query
def quality_counts(spark, folder):
    return quality.value_counts(faulty(spark, folder))


@query
def quality_violations(spark, folder):
    return quality.value_violations(faulty(spark, folder)).drop("unit_id")


@query
def cycle_violations(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_orderkey").alias("unit_id"), F.col("l_linenumber").alias("cycle")
    )
    return quality.cycle_violations(lines, ("unit_id",))


@query
def cycle_profile(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet").select(
        F.col("conv_id").alias("unit_id"), (F.col("turn") + 1).alias("cycle")
    )
    return quality.cycle_profile(turns, ("unit_id",))


@query
def unit_mismatch(spark, folder):
    lengths = source.history_lengths(spark, folder)
    official = source.terminal_view(spark, folder)
    return quality.unit_mismatch(lengths.where(F.col("last_cycle") >= 60), official.where(F.col(TERMINAL_COLUMN) < 36))


@query
def terminal_violations(spark, folder):
    """Official records with negative and missing values, against histories of other units."""
    lengths = source.history_lengths(spark, folder)
    value, unit = F.col(TERMINAL_COLUMN), F.col("unit_id")
    spoilt = F.when(unit % 7 == 0, -1 - value).when(unit % 11 != 0, value).cast("int")
    official = source.terminal_view(spark, folder).where(value < 36).withColumn(TERMINAL_COLUMN, spoilt)
    return quality.terminal_violations(lengths.where(F.col("last_cycle") >= 60).drop("last_cycle"), official)


@query
def part_counts(spark, folder):
    return split.part_counts(source.telemetry(spark, folder), "subset")


# ---------------------------------------------------------------- labels and splits


@query
def rul_train(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle")
    return labels.label_complete(rows)


@query
def rul_truncated(spark, folder):
    return truncated(spark, folder).select("subset", "unit_id", "cycle", "RUL")


@query
def rul_steps(spark, folder):
    rows = truncated(spark, folder).select("subset", "unit_id", "cycle", "RUL")
    return labels.label_steps(rows, contiguous=True)


@query
def rul_step_check(spark, folder):
    rows = gappy(spark, folder).select("subset", "unit_id", "cycle")
    return labels.label_step_violations(labels.label_complete(rows))


@query
def terminal_rows(spark, folder):
    return labels.terminal_rows(truncated(spark, folder))


@query
def terminal_check(spark, folder):
    official = source.terminal_view(spark, folder)
    shifted = official.where(F.col(TERMINAL_COLUMN) > 28).withColumn(
        TERMINAL_COLUMN, F.col(TERMINAL_COLUMN) + (F.col(TERMINAL_COLUMN) > 35).cast("int")
    )
    return labels.terminal_disagreements(truncated(spark, folder), shifted)


@query
def split_train(spark, folder):
    train, _ = split.split_by_unit(source.telemetry(spark, folder).select("subset", "unit_id", "cycle"))
    return train


@query
def split_validation(spark, folder):
    _, validation = split.split_by_unit(source.telemetry(spark, folder).select("subset", "unit_id", "cycle"))
    return validation


@query
def split_lost_rows(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle")
    train, _ = split.split_by_unit(rows)
    # The validation part is left out on purpose, so its rows must show up as lost.
    return split.lost_rows(rows, train)


@query
def split_parts_lost(spark, folder):
    """Rows that train and validation together lose or invent: none."""
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle")
    return split.lost_rows(rows, *split.split_by_unit(rows))


@query
def split_parts_shared(spark, folder):
    """Units in both train and validation: none."""
    return split.shared_units(*split.split_by_unit(source.telemetry(spark, folder).select("subset", "unit_id", "cycle")))


@query
def split_shared_units(spark, folder):
    rows = source.telemetry(spark, folder)
    early = rows.where(F.col("cycle") <= 60)
    late = rows.where(F.col("cycle") > 60)
    return split.shared_units(early, late)


# ---------------------------------------------------------------- learned state


@query
def regime_map(spark, folder):
    return regimes.fit_regimes(source.telemetry(spark, folder))


@query
def regime_assign(spark, folder):
    rows, _ = with_regimes(spark, folder)
    return rows.select("subset", "unit_id", "cycle", "regime")


@query
def regime_unseen(spark, folder):
    rows = source.telemetry(spark, folder)
    mapping = settle(regimes.fit_regimes(rows.where(F.col("setting_1") < 15)))
    return regimes.unseen_regimes(rows, mapping)


@query
def constant_columns(spark, folder):
    found = selection.constant_columns(source.telemetry(spark, folder))
    return found.select("subset", *(F.concat_ws(",", c).alias(c) for c in found.columns if c != "subset"))


@query
def scaler_global(spark, folder):
    return rounded(scaling.fit_global(source.telemetry(spark, folder), SENSORS).drop("regime"))


@query
def scaler_regime(spark, folder):
    rows, _ = with_regimes(spark, folder)
    return rounded(scaling.fit_by_regime(rows, SENSORS))


@query
def scaler_strategy(spark, folder):
    rows, mapping = with_regimes(spark, folder)
    return rounded(scaling.fit_by_strategy(rows, mapping, SENSORS))


@query
def scaled_global(spark, folder):
    rows = source.telemetry(spark, folder)
    fitted = settle(scaling.fit_global(rows, SENSORS))
    return rounded(scaling.apply_scaler(rows, fitted, SENSORS, by_regime=False).select("subset", "unit_id", "cycle", *SENSORS))


def scaled(spark, folder) -> DataFrame:
    rows = source.telemetry(spark, folder)
    return state.apply(rows, state.fit(rows), strict=False)


@query
def scaled_regime(spark, folder):
    return rounded(scaled(spark, folder).select("subset", "unit_id", "cycle", "regime", *SENSORS))


@query
def scaled_moments(spark, folder):
    return rounded(scaling.scaled_moments(scaled(spark, folder), SENSORS))


# ---------------------------------------------------------------- temporal features


@query
def lag_diff(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_3")
    return rounded(temporal.lag_difference(rows, ["sensor_2", "sensor_3"], contiguous=True, complete=True))


@query
def rolling_stats(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_3")
    made = temporal.rolling_features(rows, ["sensor_2", "sensor_3"], contiguous=True, complete=True)
    return rounded(made.select(*(c for c in made.columns if "_slope_" not in c)))


@query
def rolling_slope(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_3")
    made = temporal.rolling_features(rows, ["sensor_2", "sensor_3"], contiguous=True, complete=True)
    return rounded(made.select("subset", "unit_id", "cycle", *(c for c in made.columns if "_slope_" in c)))


@query
def rolling_wide(spark, folder):
    """Frames of hundreds of rows, put together from doubled spans."""
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_3")
    return rounded(temporal.rolling_features(rows, ["sensor_2", "sensor_3"], (60, 500), contiguous=True, complete=True))


@query
def rolling_wide_with_nulls(spark, folder):
    """Wide frames where most readings of a sensor are missing, on a cycle axis with gaps."""
    sparse = F.when(F.col("sensor_3") >= 90, F.col("sensor_3"))
    rows = gappy(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", sparse.alias("sensor_3"))
    return rounded(temporal.rolling_features(rows, ["sensor_2", "sensor_3"], (60, 500)))


@query
def ewma_sparse(spark, folder):
    """Slow smoothing of a sensor that reads in few rows: values go from one reading to the next over any distance."""
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", F.when(F.col("sensor_3") >= 110, F.col("sensor_3")).alias("sensor_3"))
    return rounded(temporal.ewma_features(rows, ["sensor_3"], 0.001, contiguous=True))


@query
def rolling_slope_gappy(spark, folder):
    rows = gappy(spark, folder).select("subset", "unit_id", "cycle", "sensor_2")
    made = temporal.rolling_features(rows, ["sensor_2"], (5, 10), complete=True)
    return rounded(made.select("subset", "unit_id", "cycle", "sensor_2_rolling_slope_5", "sensor_2_rolling_slope_10"))


@query
def ewma(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_3")
    return rounded(temporal.ewma_features(rows, ["sensor_2", "sensor_3"], contiguous=True, complete=True))


@query
def features_with_nulls(spark, folder):
    """Rolling and smoothed features where readings are missing."""
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", F.when(F.col("sensor_3") >= 30, F.col("sensor_3")).alias("sensor_3"))
    made = temporal.temporal_features(rows, ["sensor_3"], (1, 5), (5, 10), contiguous=True)
    return rounded(made)


@query
def temporal_features(spark, folder):
    """The whole feature block on scaled sensors."""
    rows = scaled(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_5")
    return rounded(temporal.temporal_features(rows, ["sensor_2", "sensor_5"], contiguous=True, complete=True))


@query
def feature_parity(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2", "sensor_5")
    swapped = rows.withColumn("sensor_5", F.col("sensor_2"))
    return rounded(evaluation.feature_parity(rows, swapped, ["sensor_2", "sensor_5"]))


# ---------------------------------------------------------------- model inputs


@query
def model_ready(spark, folder):
    rows = complete(spark, folder)
    fitted = state.fit(source.telemetry(spark, folder))
    return rounded(selection.model_ready(state.apply(rows, fitted, strict=False), sensors_in(SENSORS)))


@query
def model_inputs(spark, folder):
    rows = complete(spark, folder)
    dropped = selection.drop_columns(rows, ["setting_1", "setting_2", "setting_3", "sensor_1"])
    return rounded(selection.model_inputs(dropped, ["sensor_4", "sensor_2", "sensor_3"]))


@query
def capped_target(spark, folder):
    return selection.cap_target(complete(spark, folder).select("subset", "unit_id", "cycle", "RUL"), 50)


@query
def dense_features(spark, folder):
    rows = faulty(spark, folder).select("subset", "unit_id", "cycle", "sensor_3")
    dense = selection.dense_float_features(rows, ["sensor_3"])
    return dense.withColumn("sensor_3", F.col("sensor_3").cast("double"))


@query
def sequences_full(spark, folder):
    rows = complete(spark, folder)
    made = sequences.sliding_sequences(rows, SEQUENCE_FEATURES, contiguous=True)
    return rounded(sequences.sequence_steps(made, SEQUENCE_FEATURES))


@query
def sequences_endpoint(spark, folder):
    rows = source.telemetry(spark, folder)
    at = endpoints.cutoffs(rows).where(F.col("cycle").isNotNull())
    at = at.select("subset", "unit_id", F.col("cycle").alias("end_cycle"))
    made = sequences.endpoint_sequences(rows, at, SEQUENCE_FEATURES, contiguous=True)
    return rounded(sequences.sequence_steps(made, SEQUENCE_FEATURES))


@query
def sequences_endpoint_gappy(spark, folder):
    rows = gappy(spark, folder)
    lengths = source.history_lengths(spark, folder)
    at = lengths.select("subset", "unit_id", F.floor(F.col("last_cycle") * 0.7).cast("int").alias("end_cycle"))
    made = sequences.endpoint_sequences(rows, at, SEQUENCE_FEATURES, 10)
    return rounded(sequences.sequence_steps(made, SEQUENCE_FEATURES))


@query
def pseudo_endpoints(spark, folder):
    return endpoints.pseudo_endpoints(complete(spark, folder).select("subset", "unit_id", "cycle", "RUL"))


@query
def pseudo_endpoints_by_seed(spark, folder):
    return endpoints.pseudo_endpoints(complete(spark, folder).select("subset", "unit_id", "cycle", "RUL"), SEEDS)


@query
def endpoint_violations(spark, folder):
    return endpoints.endpoint_violations(gappy(spark, folder).select("subset", "unit_id", "cycle"))


@query
def official_endpoints(spark, folder):
    rows = truncated(spark, folder).withColumn("RUL", F.lit(999)).select("subset", "unit_id", "cycle", "sensor_2", "sensor_4", "RUL")
    return rounded(endpoints.official_endpoints(rows, source.terminal_view(spark, folder)))


@query
def last_observation(spark, folder):
    rows = source.telemetry(spark, folder)
    return rounded(trajectory.last_rows(rows, ["sensor_2", "sensor_3", "sensor_4", "sensor_5"]))


@query
def last_n_window(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2")
    at = source.history_lengths(spark, folder).withColumnRenamed("last_cycle", "end_cycle")
    return rounded(sequences.tails(rows, at, 30, contiguous=True))


# ---------------------------------------------------------------- evaluation


@query
def metrics(spark, folder):
    return rounded(evaluation.row_metrics(mean_life_predictions(spark, folder)))


@query
def tail_metrics(spark, folder):
    return rounded(evaluation.tail_metrics(mean_life_predictions(spark, folder)))


@query
def diagnostics(spark, folder):
    points = candidate_predictions(spark, folder).where((F.col("seed") == 42) & (F.col("role") == "champion"))
    return rounded(evaluation.diagnostics(points))


@query
def worst_predictions(spark, folder):
    points = candidate_predictions(spark, folder).where((F.col("seed") == 42) & (F.col("role") == "champion"))
    return rounded(evaluation.worst_first(evaluation.diagnostics(points), 3))


@query
def metrics_by_seed(spark, folder):
    return rounded(seed_metrics(spark, folder))


@query
def robustness(spark, folder):
    return rounded(evaluation.robustness_summary(seed_metrics(spark, folder)))


@query
def win_rate(spark, folder):
    return rounded(evaluation.win_rates(seed_metrics(spark, folder)))


@query
def robustness_report(spark, folder):
    return evaluation.robustness_report(seed_metrics(spark, folder))


@query
def comparison(spark, folder):
    points = candidate_predictions(spark, folder).where(F.col("seed") == 42)
    results = evaluation.all_metrics(points, ("subset", "candidate"))
    named = results.withColumnRenamed("candidate", "model").withColumn("feature_set", F.lit("baseline"))
    return evaluation.comparison_sheet(named)


# ---------------------------------------------------------------- sampling


@query
def request_quotas(spark, folder):
    return endpoints.quotas(source.history_lengths(spark, folder), 50)


@query
def request_sample(spark, folder):
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2")
    picks = endpoints.random_rows(rows, 42, minimum_cycle=30)
    shares = settle(endpoints.quotas(rows, 50))
    return rounded(endpoints.sample_units(picks, shares, 1042))


@query
def request_histories(spark, folder):
    """The last 30 cycles up to each sampled point, all samples at once."""
    rows = source.telemetry(spark, folder).select("subset", "unit_id", "cycle", "sensor_2")
    picks = endpoints.random_rows(rows.select("subset", "unit_id", "cycle"), 42, minimum_cycle=30)
    sampled = endpoints.sample_units(picks, settle(endpoints.quotas(rows, 50)), 1042)
    at = sampled.select("subset", "unit_id", F.col("cycle").alias("end_cycle"))
    return rounded(sequences.tails(rows, at, 30, contiguous=True))


# ---------------------------------------------------------------- prediction traffic


@query
def request_rate(spark, folder):
    return rounded(monitoring.request_rate(source.prediction_traffic(spark, folder), WINDOW))


@query
def request_rate_sliding(spark, folder):
    return rounded(monitoring.request_rate(source.prediction_traffic(spark, folder), WINDOW, "2 hours"))


@query
def request_totals(spark, folder):
    return monitoring.request_totals(source.prediction_traffic(spark, folder))


@query
def request_outcomes(spark, folder):
    return evaluation.request_outcomes(source.prediction_traffic(spark, folder))


@query
def latency_p95(spark, folder):
    return rounded(monitoring.latency_quantile(source.prediction_traffic(spark, folder), WINDOW))


@query
def latency_p95_sketch(spark, folder):
    return rounded(monitoring.latency_sketch(source.prediction_traffic(spark, folder), WINDOW))


@query
def latency_mean(spark, folder):
    return rounded(monitoring.mean_latency(source.prediction_traffic(spark, folder), WINDOW))


@query
def error_rate(spark, folder):
    return rounded(monitoring.error_rate(source.prediction_traffic(spark, folder), WINDOW))


@query
def latest_value(spark, folder):
    return rounded(monitoring.latest_value(source.prediction_traffic(spark, folder)))


@query
def alerts(spark, folder):
    traffic = source.prediction_traffic(spark, folder)
    return rounded(monitoring.error_alert(traffic, WINDOW, "2 hours", hold_windows=4, share=0.19))


@query
def latency_alerts(spark, folder):
    traffic = source.prediction_traffic(spark, folder)
    return rounded(monitoring.latency_alert(traffic, WINDOW, None, hold_windows=2, seconds=0.74, by=("subset",)))


@query
def silences(spark, folder):
    return monitoring.silences(source.prediction_traffic(spark, folder), "20 minutes", ("subset", "model_type"))


@query
def alert_changes(spark, folder):
    """Pending, firing, resolved: one row per change of each subset's error alert."""
    rates = monitoring.error_rate(source.prediction_traffic(spark, folder), WINDOW, "2 hours", ("subset",))
    return changes.alert_changes(rates, F.col("error_percent") > 100 * 0.19, 4, "2 hours", ("subset",))


@query
def latency_alert_changes(spark, folder):
    quantiles = monitoring.latency_quantile(source.prediction_traffic(spark, folder), WINDOW, None, ("subset",))
    return changes.alert_changes(quantiles, F.col("latency_p95_s") > 0.74, 2, WINDOW, ("subset",))


def latency_sketch_table(spark, folder) -> DataFrame:
    """Sketches of half hours, written and read back: what is merged comes from the table alone."""
    return stored(sketches.latency_sketches(source.prediction_traffic(spark, folder), "30 minutes"))


@query
def latency_sketches_stored(spark, folder):
    return rounded(sketches.quantiles(latency_sketch_table(spark, folder)))


@query
def latency_sketches_merged(spark, folder):
    """Six hours per subset, from half hours per subset and model."""
    return rounded(sketches.quantiles(sketches.merge_sketches(latency_sketch_table(spark, folder), WINDOW, ("subset",))))


@query
def latency_sketches_total(spark, folder):
    return rounded(sketches.quantiles(sketches.merge_sketches(latency_sketch_table(spark, folder))))


def expected_sources(log: DataFrame) -> DataFrame:
    """Every source of the log, and per subset one that never sends, expected from six hours
    after the subset's first event."""
    names = F.array_append(F.collect_set("model_type"), F.lit("standby"))
    found = log.groupBy("subset").agg(F.min("ts").alias("start"), names.alias("names"))
    return found.select("subset", F.explode("names").alias("model_type"), (F.col("start") + F.expr("INTERVAL 6 hours")).alias("since"))


@query
def silence_changes(spark, folder):
    """Silent and back: one row per change of each source, expected ones that never came included."""
    log = source.prediction_traffic(spark, folder)
    return changes.silence_changes(log, "20 minutes", ("subset", "model_type"), expected_sources(log))


# ---------------------------------------------------------------- text, requests, state, runs


def text_lines(spark, folder) -> DataFrame:
    """The telemetry as 26-token text lines; high readings make a line unreadable."""
    rows = source.telemetry(spark, folder)
    numbers = [F.col(name).cast("string") if name in rows.columns else F.lit("0.0") for name in TELEMETRY.fieldNames()]
    line = F.concat_ws("  ", *numbers)
    short = F.substring_index(line, " ", 20)
    word = F.concat(line, F.lit(" extra"))
    shown = F.when(F.col("sensor_2") > 60, short).when(F.col("sensor_3") < 10, F.concat(F.lit("x"), line)).otherwise(word)
    return rows.select("subset", F.concat(F.lit("\t "), shown, F.lit(" ")).alias("line"))


@query
def text_rows(spark, folder):
    rows, _ = telemetry_text.parse_telemetry(text_lines(spark, folder))
    return rounded(rows.select("subset", "unit_id", "cycle", *SENSORS))


@query
def text_rejects(spark, folder):
    _, rejected = telemetry_text.parse_telemetry(text_lines(spark, folder))
    return rejected.groupBy("subset", "tokens").agg(F.count(F.lit(1)).alias("n_lines"))


def request_bodies(spark, folder) -> DataFrame:
    """One request per unit with its last 30 rows; subsets and ids partly spoilt."""
    rows = source.telemetry(spark, folder)
    at = source.history_lengths(spark, folder).withColumnRenamed("last_cycle", "end_cycle")
    last = sequences.tails(rows, at, 30, contiguous=True)
    full = last.select(
        F.concat_ws("-", "subset", F.col("unit_id").cast("string")).alias("request_id"),
        F.when(F.col("end_cycle") > 80, "FD009").otherwise(F.lower("subset")).alias("subset"),
        F.lit("random_forest").alias("model_type"),
        F.when((F.col("end_cycle") < 55) & (F.col("cycle") == F.col("end_cycle")), F.lit(0)).otherwise(F.col("unit_id")).alias("unit_id"),
        "cycle",
        *(F.col(name) if name in rows.columns else F.lit(0.0).alias(name) for name in TELEMETRY.fieldNames()[2:]),
    )
    return requests.to_requests(full)


@query
def request_rows(spark, folder):
    rows, _ = requests.parse_requests(request_bodies(spark, folder))
    return rounded(rows.select("request_id", "subset", "unit_id", "cycle", "sensor_2", "sensor_3"))


@query
def request_rejects(spark, folder):
    _, rejected = requests.parse_requests(request_bodies(spark, folder))
    return rejected.select("request_id", "reason")


@query
def mixed_requests(spark, folder):
    """Bodies that hold the last observations of neighbouring units: one unit is allowed."""
    last = source.history_lengths(spark, folder)
    neighbours = F.concat_ws("-", "subset", F.floor(F.col("unit_id") / 8).cast("string")).alias("request_id")
    readings = (F.lit(0.0).alias(name) for name in TELEMETRY.fieldNames()[2:])
    rows = last.select(neighbours, "subset", F.lit("random_forest").alias("model_type"), "unit_id", F.col("last_cycle").alias("cycle"), *readings)
    _, rejected = requests.parse_requests(requests.to_requests(rows))
    return rejected.select("request_id", "reason")


@query
def state_round_trip(spark, folder):
    """Learned state to JSON and back to the table of sensor statistics."""
    fitted = state.fit(source.telemetry(spark, folder))
    stored = state.check(state.from_json(state.to_json(state.as_rows(fitted))))
    return rounded(state.as_tables(stored).scaler.select("subset", "regime", "scaling_strategy", "sensor", "mean", "std"))


@query
def state_violations(spark, folder):
    """Learned state of four subsets, broken in four ways."""
    learned = state.as_rows(state.fit(source.telemetry(spark, folder)))
    retained, one = F.col("retained_sensor_columns"), F.slice("retained_sensor_columns", 1, 1)
    broken = learned.select(
        "subset",
        *(c for c in learned.columns if c not in ("subset", "retained_sensor_columns", "dropped_feature_columns", "regime_mapping")),
        F.when(F.col("subset") != "FD002", F.col("regime_mapping")).alias("regime_mapping"),
        F.when(F.col("subset") == "FD001", F.reverse(retained)).when(F.col("subset") == "FD003", F.concat(retained, one)).otherwise(retained).alias("retained_sensor_columns"),
        F.when(F.col("subset") == "FD004", one).otherwise(F.col("dropped_feature_columns")).alias("dropped_feature_columns"),
    )
    return state.violations(broken)


@query
def state_applied(spark, folder):
    """Cut histories scaled with state learned on complete ones."""
    fitted = state.fit(source.telemetry(spark, folder))
    rows = state.apply(source.truncated_telemetry(spark, folder), fitted)
    return rounded(rows.select("subset", "unit_id", "cycle", "regime", *SENSORS))


def run_records(spark, folder) -> DataFrame:
    """Run records derived from events: sign-ups stand for preprocessing runs."""
    events = source.read_events(spark, folder, ["event_id", "ts", "user_id", "event_type"])
    fleet = F.concat(F.lit("FD00"), (1 + F.col("user_id") % 4).cast("string"))
    prepared = F.col("event_type") == "signup"
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.when(prepared, "preprocessing").otherwise("training").alias("kind"),
        fleet.alias("subset"),
        F.when(~prepared, F.concat(F.lit("model_"), (F.col("user_id") % 3).cast("string"))).alias("model_type"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("status"),
        F.col("ts").alias("start_time"),
        F.create_map(
            F.lit("preprocessing_run_id"), (F.col("event_id") - 1).cast("string"), F.lit("target"), F.lit("raw_rul")
        ).alias("params"),
        F.lit(None).cast("array<string>").alias("features"),
        F.create_map(F.lit("feature_set"), F.when(F.col("user_id") % 5 < 3, "baseline").otherwise("temporal")).alias("tags"),
        F.when(F.col("user_id") % 5 < 3, "baseline").otherwise("temporal").alias("feature_set"),
    )


@query
def latest_run(spark, folder):
    trained = run_records(spark, folder).where(F.col("kind") == "training")
    return runs.latest(trained)


@query
def run_chain(spark, folder):
    return runs.resolve(run_records(spark, folder)).drop("features")


@query
def run_names(spark, folder):
    return runs.with_names(run_records(spark, folder)).select("run_id", "run_name")


@query
def run_list(spark, folder):
    listed = run_records(spark, folder).select("run_id", "subset", "feature_set", "status")
    created = listed.where(F.col("status") == "FINISHED").drop("status")
    return runs.run_list(existing=created.where(F.col("feature_set") == "baseline"), created=listed.where(F.col("feature_set") == "temporal"))


@query
def missing_runs(spark, folder):
    records = run_records(spark, folder)
    # The largest event id of a subset decides, so that some pairs are missing.
    newest = records.groupBy("subset").agg(F.max_by("feature_set", F.col("run_id").cast("long")).alias("feature_set"))
    return runs.missing(newest, records, ["baseline", "temporal"])


# ---------------------------------------------------------------- preprocessing, models, scoring


def staged(spark, rows) -> DataFrame:
    """Rows written once to the shared scratch folder, where later passes read by column."""
    path = f"{scratch(spark)}/staged"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def processed(spark, folder, include_temporal=False):
    """Split, fitted and prepared telemetry: (rows of all parts, state tables)."""
    test = source.truncated_telemetry(spark, folder)
    rows = preprocess.label_and_split(source.telemetry(spark, folder), test, source.terminal_view(spark, folder), 0.2, 42)
    labelled = staged(spark, rows)
    fitted = state.fit(labelled.where(F.col("split") == "train").drop("split"))
    return preprocess.prepare(labelled, fitted, include_temporal), fitted


@query
def preprocessing_summary(spark, folder):
    rows, fitted = processed(spark, folder)
    return preprocess.summary(rows, fitted)


@query
def text_to_tables(spark, folder):
    """The whole preprocessing job, from text files made of the events to stored tables and state."""
    place = Window.partitionBy("subset").orderBy("unit_id")
    # The n-th terminal line belongs to unit n, so units are numbered without gaps.
    units = source.history_lengths(spark, folder).select("subset", "unit_id", F.row_number().over(place).alias("number"))
    measured = TELEMETRY.fieldNames()[2:]

    def renumbered(rows):
        return attach(rows, settle(units), ["subset", "unit_id"]).withColumn("unit_id", F.col("number")).drop("number")

    def lines(rows):
        numbers = [F.col(name).cast("string") if name in rows.columns else F.lit("0.0") for name in ("unit_id", "cycle", *measured)]
        return rows.select("subset", F.concat_ws(" ", *numbers).alias("value"))

    terminal = renumbered(source.terminal_view(spark, folder))
    parts = {
        "train": lines(renumbered(source.telemetry(spark, folder))),
        "test": lines(renumbered(source.truncated_telemetry(spark, folder))),
    }
    raw = f"{scratch(spark)}/raw"
    for subset in telemetry_text.normalise_subsets():
        for name, rows in parts.items():
            rows.where(F.col("subset") == subset).select("value").write.text(f"{raw}/{name}_{subset}.txt")
        ordered = terminal.where(F.col("subset") == subset).coalesce(1).sortWithinPartitions("unit_id")
        ordered.select(F.col(TERMINAL_COLUMN).cast("string").alias("value")).write.text(f"{raw}/RUL_{subset}.txt")
    return preprocess.run(spark, raw, f"{scratch(spark)}/out").drop("run_id")


@query
def preprocessed_rows(spark, folder):
    rows, _ = processed(spark, folder)
    return rounded(rows)


def part(rows, name):
    return rows.where(F.col("split") == name).drop("split")


def stored_rows(spark, folder):
    """Prepared rows written once as a partitioned table, which training reads repeatedly."""
    rows, fitted = processed(spark, folder)
    path = f"{scratch(spark)}/processed"
    tables.write_processed(rows, path, "r1", files=FILES)
    return tables.read_processed(spark, path, run_id="r1").drop("run_id"), fitted


def fleet_model(spark, folder, kind, parameters):
    """One model over all subsets, with the parts it was trained and checked on."""
    rows, fitted = stored_rows(spark, folder)
    names = state.retained_sensors(fitted)
    cap = models.DEFAULT_CAPS[kind]
    return models.fit(part(rows, "train"), names, kind, parameters, cap), rows, fitted, names


@query
def rf_scores(spark, folder):
    model, rows, _, _ = fleet_model(spark, folder, models.FOREST, {"numTrees": 20, "maxDepth": 5, "seed": 42})
    return evaluation.all_metrics(models.endpoint_predictions(model, part(rows, "validation")))


@query
def gbt_scores(spark, folder):
    parameters = {**models.BOOSTED_DEFAULTS, "maxIter": 5, "maxDepth": 4}
    model, rows, _, _ = fleet_model(spark, folder, models.BOOSTED, parameters)
    official = models.official_predictions(model, part(rows, "test"), source.terminal_view(spark, folder))
    return evaluation.all_metrics(official)


@query
def rf_seed_sweep(spark, folder):
    """Champion against competitor over ten seeds, each scored once."""
    model, rows, _, names = fleet_model(spark, folder, models.FOREST, {"numTrees": 10, "maxDepth": 4, "seed": 42})
    rival = models.fit(part(rows, "train"), names, models.FOREST, {"numTrees": 10, "maxDepth": 2, "seed": 7}, 30)
    validation = part(rows, "validation")
    matrix = [
        {"candidate": "deep", "role": "champion", "model": model, "validation": validation, "seeds": SEEDS},
        {"candidate": "shallow", "role": "competitor", "model": rival, "validation": validation, "seeds": SEEDS},
    ]
    return evaluation.robustness_report(models.seed_sweep(matrix))


@query
def fleet_scores(spark, folder):
    """RUL of every cut history at its last cycle, from raw rows, state and model."""
    model, _, fitted, names = fleet_model(spark, folder, models.FOREST, {"numTrees": 10, "maxDepth": 4, "seed": 42})
    return scoring.score_last(source.truncated_telemetry(spark, folder), fitted, model, names, contiguous=True)


def in_range(predictions, rows):
    """Per subset: predictions, and whether all lie in the range of the targets learned from."""
    seen = part(rows, "train").agg(F.min("RUL").alias("low"), F.max("RUL").alias("high")).first()
    inside = F.col("prediction").between(seen["low"], seen["high"])
    return predictions.groupBy("subset").agg(F.count(F.lit(1)).alias("n_endpoints"), F.min(inside.cast("int")).alias("all_in_range"))


@query
def rf_checks(spark, folder):
    """A forest averages its targets, so no prediction may leave their range; every validation unit has one."""
    model, rows, _, _ = fleet_model(spark, folder, models.FOREST, {"numTrees": 20, "maxDepth": 5, "seed": 42})
    return in_range(models.endpoint_predictions(model, part(rows, "validation")), rows)


@query
def boosted_checks(spark, folder):
    """Boosted trees at full strength (500 rounds, depth 6): every validation unit has a score, training errors fell
    in more than nine of ten rounds, and the model scores alike when it is stored and loaded."""
    model, rows, _, _ = fleet_model(spark, folder, models.HISTOGRAM, None)
    losses = model.losses
    fell = sum(after < before for before, after in zip(losses, losses[1:], strict=False))
    path = f"{scratch(spark)}/model"
    models.save(model, path)
    scored = models.endpoint_predictions(model, part(rows, "validation"))
    again = models.predict(models.load(path), scored.withColumnRenamed("prediction", "before"))
    return again.groupBy("subset").agg(
        F.count(F.lit(1)).alias("n_endpoints"),
        F.lit(int(len(model.trees) == 500 and fell > 0.9 * len(model.trees))).alias("learned"),
        F.min((F.col("prediction") == F.col("before")).cast("int")).alias("same_when_loaded"),
    )


@query
def official_checks(spark, folder):
    """The same on the official endpoints of cut histories, for a forest with a capped target stored and loaded."""
    model, rows, _, _ = fleet_model(spark, folder, models.FOREST, {"numTrees": 10, "maxDepth": 4, "seed": 7})
    path = f"{scratch(spark)}/model"
    models.save(model, path)
    return in_range(models.official_predictions(models.load(path), part(rows, "test"), source.terminal_view(spark, folder)), rows)


@query
def fleet_score_checks(spark, folder):
    """One score per cut history, at its last cycle."""
    scored = fleet_scores(spark, folder)
    return scored.select("subset", "unit_id", "cycle", (F.col("predicted_rul") >= 0).cast("int").alias("scored"))


@query
def sequence_scores(spark, folder):
    """Sequences of any length scored in Arrow batches; the scorer averages all values."""
    rows = source.telemetry(spark, folder)
    at = source.history_lengths(spark, folder)
    ends = at.select("subset", "unit_id", F.col("last_cycle").alias("end_cycle"))
    made = sequences.endpoint_sequences(rows, ends, SEQUENCE_FEATURES, contiguous=True)
    scored = models.score_sequences(made, lambda stacked: stacked.astype("float64").mean(axis=(1, 2)))
    return scored.withColumn("prediction", F.round(F.col("prediction") + 5e-5, 3))


@query
def scaled_by_model(spark, folder):
    """All rows scaled by the storable ML model."""
    rows = source.telemetry(spark, folder)
    fitted = models.fit_scaler_pipeline(rows, SENSORS)
    return rounded(models.apply_scaler_pipeline(rows, fitted, SENSORS).select("subset", "unit_id", "cycle", *SENSORS))


# ---------------------------------------------------------------- streams, replayed to their end


def scratch(spark) -> str:
    """A fresh folder for one run, under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/replay-{uuid.uuid4().hex}"


def replayed(spark, stream) -> DataFrame:
    folder = scratch(spark)
    traffic.write_rows(stream, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def replayed_with_state(spark, stream) -> DataFrame:
    """A replay through keyed state, which needs the RocksDB store."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    live_features.use_rocksdb(spark)
    try:
        return replayed(spark, stream)
    finally:
        spark.conf.set(key, before)


def totals(spark, stream) -> DataFrame:
    folder = scratch(spark)
    traffic.write_totals(stream, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return traffic.read_totals(spark, f"{folder}/rows")


def traffic_replay(spark, folder) -> DataFrame:
    return traffic.traffic_stream(traffic.replay_events(spark, folder), "1 hour")


def closed_replay(spark, folder) -> DataFrame:
    """The replay with a closing event long after the last one, so that the watermark passes
    every window; the window of the closing event itself stays open and gives no row."""
    rows = spark.read.schema(source.EVENTS).parquet(f"{folder}/events.parquet")
    end = rows.agg(F.max("ts").alias("ts")).select(*((F.col("ts") + F.expr("INTERVAL '60' DAY")).alias("ts") if c == "ts" else F.lit(0 if t == "bigint" else None).cast(t).alias(c) for c, t in rows.dtypes))
    path = f"{scratch(spark)}/replayed"
    rows.unionByName(end).write.parquet(path)
    return traffic.traffic_stream(spark.readStream.schema(source.EVENTS).parquet(path), "1 hour")


@query
def stream_request_totals(spark, folder):
    return totals(spark, monitoring.request_totals(traffic_replay(spark, folder)))


def zone_free(df: DataFrame) -> DataFrame:
    """Timestamps as the events table has them, without a zone."""
    stamps = {f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"}
    return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if c in stamps else F.col(c) for c in df.columns))


@query
def stream_request_rate(spark, folder):
    return zone_free(rounded(replayed(spark, monitoring.request_rate(closed_replay(spark, folder), WINDOW))))


@query
def stream_latency_p95(spark, folder):
    return zone_free(rounded(replayed(spark, monitoring.latency_quantile(closed_replay(spark, folder), WINDOW))))


@query
def stream_error_alerts(spark, folder):
    """Spans of three windows, two hours apart, that all breach."""
    return zone_free(replayed(spark, traffic.error_alerts(closed_replay(spark, folder), WINDOW, "2 hours", 3, 0.19)))


@query
def stream_silences(spark, folder):
    starts = traffic.silence_starts(closed_replay(spark, folder), "20 minutes", ("subset", "model_type"))
    return zone_free(replayed(spark, starts))


def stamped_telemetry(spark, folder) -> DataFrame:
    """Two sensors of the telemetry, with the time of each row."""
    stamped = source.read_events(spark, folder, ["event_id", "ts", "user_id", "value", "props"])
    numbered = trajectory.number_by_time(stamped, ["user_id"], "ts", ["event_id"], "cycle")
    return numbered.select(
        F.concat(F.lit("FD00"), (1 + F.col("user_id") % 4).cast("string")).alias("subset"),
        (F.col("user_id") + 1).cast("int").alias("unit_id"),
        "cycle",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("sensor_2"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("sensor_3"),
    )


@query
def stream_features(spark, folder):
    """Telemetry rows as a stream through keyed state; equal to the batch features."""
    rows = stamped_telemetry(spark, folder)
    path = f"{scratch(spark)}/telemetry"
    rows.write.parquet(path)
    arriving = spark.readStream.schema(rows.schema).parquet(path)
    sensors = ["sensor_2", "sensor_3"]
    made = replayed_with_state(spark, live_features.live_features(live_features.valid_rows(arriving, sensors, "60 days"), sensors))
    return rounded(made.drop("ts_ms"))


@query
def stream_corrected_features(spark, folder):
    """Some rows arrive 40 days late: features are released without them, then again with
    them, over three runs of one stream. The last versions equal the batch features."""
    sensors, place = ["sensor_2", "sensor_3"], scratch(spark)
    rows = stored(stamped_telemetry(spark, folder))
    held_back = F.pmod(F.xxhash64("unit_id", "cycle"), F.lit(40)) == 0
    clock = rows.agg((F.max("ts") + F.expr("INTERVAL 90 DAYS")).alias("ts")).select(
        *(F.col("ts") if f.name == "ts" else F.lit(0 if f.name in ("unit_id", "cycle") else None).cast(f.dataType).alias(f.name) for f in rows.schema)
    )
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    live_features.use_rocksdb(spark)
    try:
        for part in (rows.where(~held_back), rows.where(held_back).withColumn("ts", F.col("ts") + F.expr("INTERVAL 40 DAYS")), clock):
            part.write.mode("append").parquet(f"{place}/in")
            arriving = spark.readStream.schema(rows.schema).parquet(f"{place}/in").withWatermark("ts", "10 minutes")
            features = live_features.live_features(arriving, sensors)
            corrections.write_released(features, f"{place}/out", f"{place}/checkpoint").awaitTermination()
            corrections.correct(spark, f"{place}/out", features.schema, sensors)
    finally:
        spark.conf.set(key, before)
    return rounded(corrections.read_current(spark, f"{place}/out", features.schema).where("unit_id > 0").drop("ts_ms", "version"))


@query
def stream_alert_changes(spark, folder):
    made = live_changes.error_alert_changes(closed_replay(spark, folder), WINDOW, "2 hours", 4, 0.19, ("subset",))
    return zone_free(replayed_with_state(spark, made))


@query
def stream_latency_alert_changes(spark, folder):
    made = live_changes.latency_alert_changes(closed_replay(spark, folder), WINDOW, None, 2, 0.74, ("subset",))
    return zone_free(replayed_with_state(spark, made))


@query
def stream_latency_sketches(spark, folder):
    """Half-hour sketches from the stream, merged to six hours per subset."""
    made = zone_free(replayed(spark, sketches.latency_sketches(closed_replay(spark, folder), "30 minutes")))
    return rounded(sketches.quantiles(sketches.merge_sketches(made, WINDOW, ("subset",))))


@query
def stream_silence_changes(spark, folder):
    expected = expected_sources(source.prediction_traffic(spark, folder))
    made = live_changes.silence_changes(closed_replay(spark, folder), "20 minutes", ("subset", "model_type"), expected, "5 minutes")
    return zone_free(replayed_with_state(spark, made))
