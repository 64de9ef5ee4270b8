"""Text files to processed tables, models and scores."""

import datetime

import pytest
from pyspark.sql import functions as F

from fleetlife.operators import endpoints, evaluation
from fleetlife.plans import models, preprocess, runs, scoring, state
from fleetlife.schema import MEASUREMENTS, TELEMETRY, TERMINAL_COLUMN, feature_columns
from fleetlife.sources import tables, telemetry_text


def write_subset(folder, name, units=4, cycles=3, tests=2, seen=2, terminal="5\n7\n"):
    """Constant settings and sensors but sensor_2 = 10 * unit + cycle."""

    def lines(count, n):
        for unit in range(1, count + 1):
            for cycle in range(1, n + 1):
                values = [0.0, 0.0, 100.0] + [float(k) if k != 2 else 10.0 * unit + cycle for k in range(1, 22)]
                yield " ".join([str(unit), str(cycle), *map(str, values)]) + "  \n"

    (folder / f"train_{name}.txt").write_text("".join(lines(units, cycles)))
    (folder / f"test_{name}.txt").write_text("".join(lines(tests, seen)))
    (folder / f"RUL_{name}.txt").write_text(terminal)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    write_subset(folder, "FD001")
    write_subset(folder, "FD003", units=6)
    return str(folder)


def by_part(report):
    return {(r["subset"], r["split"]): r for r in report.collect()}


@pytest.mark.parametrize("include_temporal, n_features", [(False, 1), (True, 15)])
def test_two_subsets_at_once(spark, raw, tmp_path, include_temporal, n_features):
    out = str(tmp_path / "out")
    report = preprocess.run(spark, raw, out, ["fd001", "FD003"], 0.25, include_temporal=include_temporal)
    parts = by_part(report)
    assert {key: (r["n_rows"], r["n_units"]) for key, r in parts.items()} == {
        ("FD001", "train"): (9, 3),
        ("FD001", "validation"): (3, 1),
        ("FD001", "test"): (4, 2),
        ("FD003", "train"): (12, 4),
        ("FD003", "validation"): (6, 2),
        ("FD003", "test"): (4, 2),
    }
    first = parts["FD001", "train"]
    assert (first["scaling_strategy"], first["n_regimes"], first["n_features"]) == ("global", 1, n_features)
    rows = tables.read_processed(spark, f"{out}/processed", "FD001", first["run_id"], "test")
    assert len(feature_columns(rows.columns)) == n_features
    assert sorted((r["unit_id"], r["cycle"], r["RUL"]) for r in rows.collect()) == [(1, 1, 6), (1, 2, 5), (2, 1, 8), (2, 2, 7)]
    assert {f.dataType.typeName() for f in rows.schema.fields} <= {"string", "integer", "double"}
    train = tables.read_processed(spark, f"{out}/processed", "FD001", first["run_id"], "train")
    mean, std = train.agg(F.avg("sensor_2"), F.stddev_samp("sensor_2")).first()
    assert mean == pytest.approx(0.0, abs=1e-12) and std == pytest.approx(1.0)


def test_a_rerun_stands_beside_the_first(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    first, second = (by_part(preprocess.run(spark, raw, out, "FD001")) for _ in range(2))
    ids = {first["FD001", "train"]["run_id"], second["FD001", "train"]["run_id"]}
    assert len(ids) == 2
    assert {k: r["n_rows"] for k, r in first.items()} == {k: r["n_rows"] for k, r in second.items()}
    stored = runs.read(spark, f"{out}/runs")
    assert {r["run_id"] for r in stored.collect()} == ids
    newest = runs.find(stored, "fd001")
    assert newest == second["FD001", "train"]["run_id"]
    assert stored.where(F.col("run_id") == newest).first()["params"]["scaling_strategy"] == "global"
    loaded = state.load(spark, f"{out}/state", newest)
    assert loaded.first()["retained_sensor_columns"] == ["sensor_2"]
    with pytest.raises(ValueError, match="no finished"):
        runs.find(stored, "FD002")


def test_bad_input_stops_the_run(spark, raw, tmp_path):
    from pathlib import Path

    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="unsupported"):
        preprocess.run(spark, raw, out, "FD007")
    with pytest.raises(FileNotFoundError, match="FD002"):
        preprocess.run(spark, raw, out, "FD002")
    Path(raw, "RUL_FD001.txt").write_text("5\n-7\n")
    with pytest.raises(ValueError, match="negative"):
        preprocess.run(spark, raw, out, "FD001")
    Path(raw, "RUL_FD001.txt").write_text("5\n7\n9\n")
    with pytest.raises(ValueError, match="unit-missing"):
        preprocess.run(spark, raw, out, "FD001")
    with open(Path(raw, "train_FD003.txt"), "a") as text:
        text.write("7 1 broken\n")
    with pytest.raises(ValueError, match="unreadable"):
        preprocess.run(spark, raw, out, "FD003")


def degradation(spark, units=12, cycles=40):
    """Readings that drift with age, so that trees can learn RUL."""
    rows = spark.range(1, units + 1).select(F.col("id").cast("int").alias("unit_id"))
    rows = rows.withColumn("life", (F.lit(cycles) - F.col("unit_id")).cast("int"))
    rows = rows.withColumn("cycle", F.explode(F.sequence(F.lit(1), F.col("life"))))
    values = [
        (F.col("life") - F.col("cycle") + (F.col("unit_id") % 3) * 0.1 if name == "sensor_2" else F.lit(1.0)).cast("double").alias(name)
        for name in MEASUREMENTS
    ]
    return rows.select(F.lit("FD001").alias("subset"), "unit_id", "cycle", *values)


@pytest.mark.parametrize("kind, parameters", [(models.FOREST, {"numTrees": 8, "maxDepth": 6, "seed": 42}), (models.BOOSTED, {"maxIter": 15, "maxDepth": 4, "stepSize": 0.3, "seed": 42})])
def test_train_evaluate_store_and_score(spark, tmp_path, kind, parameters):
    telemetry = degradation(spark)
    cut = telemetry.where("cycle <= 15")
    lives = telemetry.groupBy("subset", "unit_id").agg(F.max("cycle").alias("life"))
    terminal = lives.select("subset", "unit_id", (F.col("life") - 15).alias(TERMINAL_COLUMN))
    labelled = preprocess.label_and_split(telemetry, cut, terminal, 0.25, 42)
    fitted = state.fit(labelled.where("split = 'train'").drop("split"))
    rows = preprocess.prepare(labelled, fitted, include_temporal=True)
    path = str(tmp_path / "processed")
    tables.write_processed(rows, path, "p1", files=2)
    train, validation, test = (
        tables.read_processed(spark, path, "FD001", "p1", part).drop("run_id", "split") for part in ("train", "validation", "test")
    )
    done = models.train_and_evaluate(train, validation, kind, parameters)
    assert done["tags"] == {"feature_set": "temporal"} and len(done["features"]) == 15
    assert {"rmse", "mae", "rul_score", "bias", "late_prediction_rate", "validation_row_rmse", "worst_positive_error",
            "worst_negative_error", "largest_score_contribution", "top_3_score_contribution"} <= set(done["metrics"])
    assert done["metrics"]["rmse"] < 4
    assert done["params"]["target"] == ("raw_rul" if kind == models.FOREST else "capped_rul_125")
    assert done["diagnostics"].count() == validation.select("unit_id").distinct().count()

    metrics, report = models.evaluate_official(done["model"], test, terminal)
    assert metrics["test_mae"] < 6 and report.count() == 12
    tables.write_report(report, str(tmp_path / "report"))
    assert tables.read_report(spark, str(tmp_path / "report"), report.schema).count() == 12

    records = runs.record(spark, "p1", "preprocessing", "FD001", datetime.datetime(2024, 1, 1))
    records = records.unionByName(
        runs.record(spark, "t1", "training", "FD001", datetime.datetime(2024, 1, 2), kind, params={**done["params"], "preprocessing_run_id": "p1"}, metrics=done["metrics"], tags=done["tags"], features=done["features"])
    )
    runs.append(records, str(tmp_path / "runs"))
    found = runs.resolve(runs.read(spark, str(tmp_path / "runs"))).first()
    assert (found["training_run_id"], found["preprocessing_run_id"], found["features"]) == ("t1", "p1", done["features"])
    assert runs.unresolved(runs.read(spark, str(tmp_path / "runs"))).count() == 0

    models.save(done["model"], str(tmp_path / "model"))
    loaded = models.load(str(tmp_path / "model"))
    scores = scoring.score_last(cut, fitted, loaded, found["features"], contiguous=True)
    expected = models.predict(loaded, endpoints.official_endpoints(test, terminal)).select("unit_id", "prediction")
    both = scores.join(expected, "unit_id")
    assert both.count() == 12
    assert both.where(F.abs(F.col("predicted_rul") - F.col("prediction")) > 1e-9).count() == 0
    if kind == models.BOOSTED:
        losses = models.training_losses(loaded, train)
        assert len(losses) == 15 and losses[-1] < losses[0]
        assert runs.metric_series(spark, "t1", "training_mse", losses).count() == 15


def test_scoring_one_unit(spark, frame):
    """Two sensors with known statistics, as one request sees them."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TELEMETRY.fields)

    def rows(points):
        made = []
        for cycle, two, three in points:
            values = {name: 0.0 for name in MEASUREMENTS} | {"sensor_2": two, "sensor_3": three}
            made.append((1, cycle, *(float(values[name]) for name in MEASUREMENTS)))
        return frame(made, columns)

    document = """{"regime_mapping": [{"setting_1": 0.0, "setting_2": 0.0, "setting_3": 0.0, "regime": 1}],
      "dropped_feature_columns": [], "retained_sensor_columns": ["sensor_2", "sensor_3"], "regime_sensor_scaler": null,
      "global_sensor_scaler": [{"sensor": "sensor_2", "mean": 10.0, "std": 2.0}, {"sensor": "sensor_3", "mean": 100.0, "std": 10.0}]}"""
    fitted = state.as_tables(state.from_json(spark.createDataFrame([("FD001", document)], "subset string, state_json string")))
    names = ["sensor_2", "sensor_3", "sensor_2_lag_1", "sensor_2_diff_1", "sensor_2_rolling_mean_5", "sensor_2_rolling_std_5", "sensor_2_rolling_slope_5", "sensor_2_ewma"]
    prepared = scoring.prepare(rows([(1, 10, 100), (2, 14, 120)]), fitted, names).orderBy("cycle").collect()[-1]
    assert [prepared[name] for name in names] == pytest.approx([2, 2, 0, 2, 1, 2**0.5, 2, 0.4])

    scored = scoring.score_last_sequences(
        rows([(3, 16, 100), (1, 10, 100), (2, 14, 100)]), fitted, lambda stacked: stacked[:, -1, 0] * 10 + stacked[:, 0, 0], ["sensor_2"], 2
    ).first()
    assert (scored["cycle"], scored["predicted_rul"]) == (3, pytest.approx(32.0))


def test_missing_runs_and_run_lists(spark):
    have = spark.createDataFrame([("FD001", "baseline", "a"), ("FD001", "temporal", "b"), ("FD002", "baseline", "c")], "subset string, feature_set string, run_id string")
    assert [tuple(r) for r in runs.missing(have, have, ["baseline", "temporal"]).collect()] == [("FD002", "temporal")]
    created = have.limit(1).withColumn("n_rows", F.lit(5))
    listed = runs.run_list(existing=have, created=created)
    assert {r["source"]: r["n"] for r in listed.groupBy("source").agg(F.count("*").alias("n")).collect()} == {"existing": 3, "created": 1}


def test_seed_sweep(spark):
    labelled = degradation(spark).withColumn("RUL", (F.lit(40) - F.col("unit_id") - F.col("cycle")).cast("int"))
    model = models.fit(labelled, ["sensor_2"], models.FOREST, {"numTrees": 4, "maxDepth": 5, "seed": 1})
    rival = models.fit(labelled, ["sensor_2"], models.FOREST, {"numTrees": 1, "maxDepth": 1, "seed": 1})
    matrix = [
        {"candidate": name, "role": role, "model": m, "validation": labelled, "seeds": [42, 43, 44]}
        for name, role, m in (("deep", "champion", model), ("shallow", "competitor", rival))
    ]
    sweep = models.seed_sweep(matrix)
    assert sweep.count() == 6
    assert evaluation.win_rates(sweep).first()["champion_win_rate"] == 1.0


def write_fleet(spark, folder, name, shift):
    """Text files of degrading units and of the same units cut at cycle 15."""
    rows = degradation(spark, 8, 30 + shift).orderBy("unit_id", "cycle").collect()
    lines = [" ".join(str(row[c]) for c in TELEMETRY.fieldNames()) for row in rows]
    cut = [line for row, line in zip(rows, lines) if row["cycle"] <= 15]
    lives = {row["unit_id"]: row["cycle"] for row in rows}
    (folder / f"train_{name}.txt").write_text("\n".join(lines) + "\n")
    (folder / f"test_{name}.txt").write_text("\n".join(cut) + "\n")
    (folder / f"RUL_{name}.txt").write_text("".join(f"{life - 15}\n" for _, life in sorted(lives.items())))


def test_experiments_and_streamed_requests(spark, tmp_path):
    """Text to processed tables to trained candidates to scores of streamed JSON requests."""
    import json

    from fleetlife.plans import experiments
    from fleetlife.sources import requests
    from fleetlife.streaming import live_scoring

    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write_fleet(spark, raw, "FD001", 0)
    write_fleet(spark, raw, "FD003", 4)
    report = preprocess.run(spark, str(raw), out, ["FD001", "FD003"], include_temporal=True)
    run_id = report.first()["run_id"]
    terminal, _ = telemetry_text.scan_terminal_rul(spark, [f"{raw}/RUL_FD001.txt", f"{raw}/RUL_FD003.txt"])
    small = {"numTrees": 5, "maxDepth": 5, "seed": 42}
    candidates = [
        {"subset": "FD001", "run_id": run_id, "model_type": models.FOREST, "parameters": small},
        {"subset": "FD003", "run_id": run_id, "model_type": models.FOREST, "parameters": small, "cap": 20},
    ]
    results = experiments.run_matrix(spark, out, terminal, candidates)
    sheet = evaluation.comparison_sheet(results).collect()
    assert {(r["subset"], r["feature_set"]) for r in sheet} == {("FD001", "temporal"), ("FD003", "temporal")}
    assert all(r["test_mae"] < 10 for r in sheet)
    names = {r["run_name"] for r in runs.with_names(runs.read(spark, f"{out}/runs")).collect()}
    assert {"FD001-preprocessing", "FD003-random_forest-temporal-capped_rul_20", "FD001-random_forest-temporal-raw_rul"} <= names

    training_run = runs.find(runs.read(spark, f"{out}/runs"), "FD001", "training", models.FOREST)
    model, features, preprocessing_run = experiments.load_trained(spark, out, training_run)
    assert preprocessing_run == run_id
    with pytest.raises(ValueError, match="no usable"):
        experiments.load_trained(spark, out, "missing")

    fitted = state.as_tables(state.load(spark, f"{out}/state", run_id))
    cut = degradation(spark, 8, 30).where("cycle <= 15")
    bodies = requests.to_requests(cut.select(F.col("unit_id").cast("string").alias("request_id"), F.lit("m").alias("model_type"), "*"))
    lines = [json.dumps({"request_id": r["request_id"], "body": r["body"]}) for r in bodies.collect()]
    (tmp_path / "requests").mkdir()
    (tmp_path / "requests" / "a.json").write_text("\n".join(lines))
    arriving = spark.readStream.schema("request_id string, body string").json(str(tmp_path / "requests"))
    rows, _ = requests.parse_requests(arriving)
    keys = ("request_id", "subset", "unit_id")
    done = live_scoring.write_scores(
        rows, f"{out}/scores", f"{out}/scores-checkpoint", lambda batch: scoring.score_last(batch, fitted, model, features, keys)
    )
    done.awaitTermination()
    scored = spark.read.parquet(f"{out}/scores")
    expected = scoring.score_last(cut, fitted, model, features, contiguous=True)
    both = scored.select("unit_id", F.col("predicted_rul").alias("live")).join(expected, "unit_id")
    assert both.count() == 8
    assert both.where(F.abs(F.col("live") - F.col("predicted_rul")) > 1e-6).count() == 0
