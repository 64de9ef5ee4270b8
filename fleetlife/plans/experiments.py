"""Candidate models over subsets and feature sets, trained, evaluated and recorded."""

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.plans import models, runs, state
from fleetlife.schema import sensors_in
from fleetlife.sources import tables

def parts(spark: SparkSession, output: str, subset: str, run_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows of one subset and run; other directories are pruned.

    The columns of sensors the subset does not retain are left out.
    """
    rows = tables.read_processed(spark, f"{output}/processed", subset, run_id)
    stored = state.load(spark, f"{output}/state", run_id).where(F.col("subset") == subset).first()
    if stored is None:
        raise ValueError(f"run {run_id} has no state for {subset}")
    absent = set(sensors_in(rows.columns)) - set(stored["retained_sensor_columns"])
    gone = [c for c in rows.columns if any(c == s or c.startswith(f"{s}_") for s in absent)]
    kept = rows.drop(*gone, "run_id")
    return tuple(kept.where(F.col("split") == part).drop("split") for part in ("train", "validation", "test"))


def run_candidate(spark: SparkSession, output: str, terminal: DataFrame, candidate: dict) -> dict:
    """Train one candidate, evaluate it on validation and official endpoints, store it all.

    ``candidate`` names ``subset``, ``run_id`` (preprocessing), ``model_type`` and, if
    wanted, ``parameters`` and ``cap``. Returns the result row of the comparison.
    """
    subset, kind = candidate["subset"], candidate["model_type"]
    started = datetime.datetime.now()
    train, validation, test = parts(spark, output, subset, candidate["run_id"])
    done = models.train_and_evaluate(train, validation, kind, candidate.get("parameters"), candidate.get("cap", "default"))
    official = terminal.where(F.col("subset") == subset)
    test_metrics, report = models.evaluate_official(done["model"], test, official)
    training_run = uuid.uuid4().hex
    folder = f"{output}/models/{training_run}"
    models.save(done["model"], f"{folder}/model")
    tables.write_report(done["diagnostics"], f"{folder}/validation_endpoint_predictions")
    tables.write_report(report, f"{folder}/test_predictions")
    params = {**done["params"], "subset": subset, "preprocessing_run_id": candidate["run_id"]}
    record = runs.record(
        spark, training_run, "training", subset, started, kind,
        params=params, metrics={**done["metrics"], **test_metrics}, tags=done["tags"], features=done["features"],
    )
    runs.append(record, f"{output}/runs")
    return {
        "subset": subset,
        "model": kind,
        "feature_set": done["tags"]["feature_set"],
        "preprocessing_run_id": candidate["run_id"],
        "training_run_id": training_run,
        **{name.removeprefix("test_"): value for name, value in test_metrics.items()},
    }


def run_matrix(spark: SparkSession, output: str, terminal: DataFrame, candidates) -> DataFrame:
    """All candidates, one row of test metrics each; the fits themselves are distributed."""
    results = [run_candidate(spark, output, terminal, candidate) for candidate in candidates]
    names = list(results[0])
    return spark.createDataFrame([tuple(row[name] for name in names) for row in results], names)


def load_trained(spark: SparkSession, output: str, training_run: str):
    """(model, features, preprocessing run) of a stored training run."""
    found = runs.resolve(runs.read(spark, f"{output}/runs")).where(F.col("training_run_id") == training_run).first()
    if found is None or found["preprocessing_run_id"] is None:
        raise ValueError(f"no usable training run {training_run}")
    return models.load(f"{output}/models/{training_run}/model"), found["features"], found["preprocessing_run_id"]
