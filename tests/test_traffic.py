"""Prediction traffic: batch reports, and streams that end where the batch does."""

import datetime
import uuid

import pytest
from oracle import SMALL
from pyspark.sql import functions as F

from fleetlife.operators import evaluation, monitoring, temporal
from fleetlife.operators.trajectory import number_by_time
from fleetlife.sources import events
from fleetlife.streaming import live_features, live_scoring, traffic

START = datetime.datetime(2024, 1, 1)


def log(spark, rows):
    """rows: (second, status, latency)"""
    made = [(START + datetime.timedelta(seconds=s), "FD001", "m", status, latency, float(s)) for s, status, latency in rows]
    return spark.createDataFrame(
        made, "ts timestamp_ntz, subset string, model_type string, status string, latency_s double, predicted_rul double"
    )


def test_rates_and_totals(spark):
    df = log(spark, [(0, "success", 0.1), (10, "error", 0.1), (20, "success", 0.1), (400, "success", 0.1)])
    found = {(r["window_start"], r["status"]): (r["requests"], r["per_second"]) for r in monitoring.request_rate(df).collect()}
    later = START + datetime.timedelta(minutes=5)
    assert found == {(START, "success"): (2, 2 / 300), (START, "error"): (1, 1 / 300), (later, "success"): (1, 1 / 300)}
    assert {r["status"]: r["requests"] for r in monitoring.request_totals(df).collect()} == {"success": 3, "error": 1}
    assert monitoring.latest_value(df).first()["predicted_rul"] == 400.0
    assert evaluation.failed_requests(df).count() == 1
    assert tuple(evaluation.request_outcomes(df).first()) == ("FD001", "m", 4, 3, 1)


@pytest.mark.parametrize(
    "latencies, expected",
    [
        ([0.004] * 10, 0.95 * 0.005),
        ([0.3] * 100, 0.25 + 0.25 * 0.95),
        ([0.3] * 50 + [3.0] * 50, 2.5 + 2.5 * 0.9),
        ([50.0] * 3, 10.0),
    ],
)
def test_quantile_interpolates_in_buckets(spark, latencies, expected):
    df = log(spark, [(i, "success", x) for i, x in enumerate(latencies)])
    assert monitoring.latency_quantile(df).first()["latency_p95_s"] == pytest.approx(expected)


def test_alert_needs_consecutive_windows(spark):
    minutes = {0: "error", 5: "error", 10: "success", 15: "error", 25: "error", 30: "error", 35: "error"}
    df = log(spark, [(60 * m, status, 5.0) for m, status in minutes.items()])
    found = monitoring.error_alert(df, hold_windows=2).where("firing").orderBy("window_start").collect()
    assert [int((r["window_start"] - START).total_seconds() // 60) for r in found] == [5, 30, 35]
    slow = monitoring.latency_alert(df, hold_windows=3).where("firing").orderBy("window_start").collect()
    assert [int((r["window_start"] - START).total_seconds() // 60) for r in slow] == [10, 15, 35]
    spans = traffic.error_alerts(df, hold_windows=2).orderBy("span_end").collect()
    assert [int((r["span_end"] - START).total_seconds() // 60) for r in spans] == [10, 35, 40]


def test_silences(spark):
    df = log(spark, [(0, "success", 1.0), (50, "success", 1.0), (111, "success", 1.0), (171, "success", 1.0), (400, "success", 1.0)])
    found = sorted((r["silent_from"], r["silent_until"]) for r in monitoring.silences(df).collect())
    assert [(a - START).seconds for a, _ in found] == [50, 171]
    assert [(b - START).seconds for _, b in found] == [111, 400]


def run(spark, stream, folder):
    name = uuid.uuid4().hex
    traffic.write_rows(stream, f"{folder}/{name}", f"{folder}/{name}-checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}")


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    """The events in four files in time order, and a late row far ahead that closes all windows."""
    folder = str(tmp_path_factory.mktemp("replay"))
    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    bounds = [0, 250, 500, 750, 10**9]
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = rows.where((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.parquet(f"{folder}/staging{i}")
    closing = rows.limit(1).withColumn("ts", F.lit(datetime.datetime(2025, 1, 1)).cast("timestamp_ntz"))
    closing.write.parquet(f"{folder}/staging4")
    import pathlib
    import shutil
    import time

    target = pathlib.Path(folder, "in")
    target.mkdir()
    for i in range(5):
        source = next(pathlib.Path(folder, f"staging{i}").glob("*.parquet"))
        shutil.copy(source, target / f"events{i}.parquet")
        time.sleep(0.05)
    return str(target)


def stream(spark, replay):
    return traffic.traffic_stream(traffic.replay_events(spark, replay), "10 minutes")


def batch(spark):
    return events.prediction_traffic(spark, SMALL).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize(
    "report",
    [
        lambda df: monitoring.request_rate(df, "6 hours"),
        lambda df: monitoring.request_rate(df, "6 hours", "2 hours"),
        lambda df: monitoring.error_rate(df, "6 hours"),
        lambda df: monitoring.mean_latency(df, "6 hours"),
        lambda df: monitoring.latency_quantile(df, "6 hours"),
        lambda df: monitoring.latency_sketch(df, "6 hours"),
        lambda df: traffic.error_alerts(df, "6 hours", "2 hours", 3, 0.15),
        lambda df: traffic.latency_alerts(df, "6 hours", None, 2, 0.5, ("subset",)),
        lambda df: traffic.silence_starts(df, "8 hours").drop("requests"),
    ],
)
def test_streams_end_where_the_batch_does(spark, replay, tmp_path, report):
    def tidy(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

    live, whole = tidy(run(spark, report(stream(spark, replay)), tmp_path)), tidy(report(batch(spark)))
    # The closing row itself is still open in the stream and absent from the batch.
    assert live == whole and len(whole) > 3


def test_running_totals(spark, replay, tmp_path):
    for i, report in enumerate((monitoring.request_totals, monitoring.latest_value)):
        path = f"{tmp_path}/{i}"
        traffic.write_totals(report(stream(spark, replay)), path, f"{path}-checkpoint").awaitTermination()
        live = traffic.read_totals(spark, path)
        with_closing = events.prediction_log(spark.read.parquet(replay))
        whole = report(with_closing.withColumn("ts", F.col("ts").cast("timestamp")))
        assert sorted(map(tuple, live.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


SENSORS = ["sensor_2", "sensor_3"]


def live_rows(spark):
    times = number_by_time(spark.read.parquet(f"{SMALL}/events.parquet"), ["user_id"], "ts", ["event_id"], "cycle")
    times = times.select((F.col("user_id") + 1).cast("int").alias("unit_id"), "cycle", F.col("ts").cast("timestamp").alias("ts"))
    return events.telemetry(spark, SMALL).join(times, ["unit_id", "cycle"]).select("subset", "unit_id", "cycle", "ts", *SENSORS)


def as_stream(spark, parts, folder):
    import time

    for part in parts:
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.3)
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_live_features_equal_batch_features(spark, tmp_path):
    """Rows arrive in three files in arbitrary order; units span several blocks."""
    live_features.use_rocksdb(spark)
    rows = live_rows(spark)
    shuffled = [rows.where(F.pmod(F.xxhash64("unit_id", "cycle"), F.lit(3)) == i) for i in range(3)]
    arriving = as_stream(spark, [*shuffled, shuffled[0]], f"{tmp_path}/in")
    valid = live_features.valid_rows(arriving, SENSORS, "60 days")
    options = {"lags": (1, 5), "windows": (5, 10), "alpha": 0.9, "block_rows": 40}
    made = run(spark, live_features.live_features(valid, SENSORS, **options), tmp_path)
    want = temporal.temporal_features(rows.drop("ts"), SENSORS, contiguous=True, **options)
    assert made.where("status = 'ok' and missing_before = 0").count() == rows.count() == made.count()
    names = temporal.feature_names(SENSORS, (1, 5), (5, 10))
    assert evaluation.feature_parity(made, want, [*SENSORS, *names], rtol=1e-9, atol=1e-9).count() == 0


def test_gaps_and_late_rows_are_marked(spark, frame, tmp_path):
    live_features.use_rocksdb(spark)

    def part(points):
        rows = [(u, c, START + datetime.timedelta(minutes=m), float(c)) for u, c, m in points]
        return frame(rows, "unit_id int, cycle int, ts timestamp, sensor_2 double")

    arriving = as_stream(
        spark,
        [part([(1, 1, 0), (1, 2, 1), (1, 4, 3)]), part([(2, 1, 200)]), part([(2, 2, 201)]), part([(1, 3, 202)]), part([(2, 3, 203)])],
        f"{tmp_path}/in",
    )
    watched = arriving.withWatermark("ts", "10 minutes")
    made = run(spark, live_features.live_features(watched, ["sensor_2"], (1,), (2,), 0.5), tmp_path)
    found = {(r["unit_id"], r["cycle"]): (r["status"], r["missing_before"], r["sensor_2_lag_1"]) for r in made.collect()}
    assert found == {
        (1, 1): ("ok", 0, None),
        (1, 2): ("ok", 0, 1.0),
        (1, 4): ("ok", 1, 2.0),
        (1, 3): ("late", None, None),
        (2, 1): ("ok", 0, None),
        (2, 2): ("ok", 0, 1.0),
        (2, 3): ("ok", 0, 2.0),
    }


def test_rejected_rows(spark, frame):
    rows = frame([(1, 1, 1.0), (0, 1, 1.0), (1, 2, None), (1, 3, float("nan")), (1, 4, float("inf")), (None, 1, 1.0)], "unit_id int, cycle int, sensor_2 double")
    assert live_features.rejected_rows(rows, ["sensor_2"]).count() == 5


def test_live_scoring(spark, tmp_path):
    from fleetlife.plans import models, state

    live_features.use_rocksdb(spark)
    rows = events.telemetry(spark, SMALL)
    fitted = state.fit(rows)
    names = ["sensor_2", "sensor_3", "sensor_2_ewma", "sensor_3_lag_1"]
    times = live_rows(spark).select("unit_id", "cycle", "ts")
    whole = rows.join(times, ["unit_id", "cycle"]).select("subset", "unit_id", "cycle", "ts", "setting_1", "setting_2", "setting_3", *SENSORS)
    scaled = live_scoring.scaled_stream(whole, fitted)
    features = temporal.temporal_features(scaled.drop("ts"), SENSORS, contiguous=True)
    model = models.fit(features.withColumn("RUL", F.col("cycle")), names, models.FOREST, {"numTrees": 3, "maxDepth": 4, "seed": 1})
    arriving = as_stream(spark, [whole.where("cycle <= 20"), whole.where("cycle > 20")], f"{tmp_path}/in")
    prepared = live_scoring.scaled_stream(arriving, fitted).withWatermark("ts", "60 days")
    made = live_features.live_features(prepared, SENSORS)
    live = run(spark, live_scoring.live_predictions(made, model), tmp_path)
    want = models.predict(model, features).select("subset", "unit_id", "cycle", "prediction")
    both = live.join(want, ["subset", "unit_id", "cycle"])
    assert both.count() == rows.count()
    assert both.where(F.abs(F.col("predicted_rul") - F.col("prediction")) > 1e-6).count() == 0
    assert live_scoring.unseen_stream(whole.withColumn("setting_1", F.lit(777.0)), fitted).count() == rows.count()
