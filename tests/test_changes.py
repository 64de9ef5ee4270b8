"""Alert and silence life cycles: literals, brute force, and streams of many triggers."""

import datetime
import os
import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from fleetlife.operators import changes, monitoring
from fleetlife.streaming import changes as live
from fleetlife.streaming import live_features, traffic

START = datetime.datetime(2024, 1, 1)
LOG = "ts timestamp, subset string, model_type string, status string, latency_s double, predicted_rul double"


def at(second):
    return START + datetime.timedelta(seconds=second)


def log(spark, rows):
    """rows: (second, subset, status, latency)"""
    return spark.createDataFrame([(at(s), subset, "m", status, latency, 1.0) for s, subset, status, latency in rows], LOG)


def found(df, *names):
    return sorted(((r["subset"], r["state"], *(None if r[n] is None else int((r[n] - START).total_seconds()) for n in names)) for r in df.collect()), key=repr)


def windows(spark, minutes):
    """minutes: window end -> breach (None: null)"""
    rows = [("a", START + datetime.timedelta(minutes=m), b) for m, b in minutes.items()]
    return spark.createDataFrame(rows, "subset string, window_end timestamp, breach boolean")


def alerts(spark, minutes, hold):
    made = changes.alert_changes(windows(spark, minutes), F.col("breach"), hold, "5 minutes", ("subset",))
    return [(state, second // 60) for _, state, second in sorted(found(made, "at"), key=lambda r: (r[2], r[1] == "firing"))]


def test_alert_fires_after_hold_and_resolves(spark):
    seen = {5: True, 10: True, 15: False, 20: True, 25: False}
    assert alerts(spark, seen, 2) == [("pending", 5), ("firing", 10), ("resolved", 15), ("pending", 20), ("inactive", 25)]


def test_missing_and_null_windows_end_an_alert(spark):
    assert alerts(spark, {5: True, 15: True}, 1) == [("pending", 5), ("firing", 5), ("resolved", 10), ("pending", 15), ("firing", 15), ("resolved", 20)]
    assert alerts(spark, {5: True, 10: None, 15: True}, 2) == [("pending", 5), ("inactive", 10), ("pending", 15), ("inactive", 20)]
    assert alerts(spark, {5: False, 10: None}, 1) == []


def test_hold_must_be_positive(spark):
    with pytest.raises(ValueError):
        changes.alert_changes(windows(spark, {5: True}), F.col("breach"), 0, "5 minutes", ("subset",))
    with pytest.raises(ValueError):
        live.alert_changes(windows(spark, {5: True}), F.col("breach"), 0, "5 minutes", ("subset",))


def brute_alerts(minutes, hold):
    made, run = [], 0
    for m in range(0, max(minutes) + 10, 5):
        if minutes.get(m):
            run += 1
            made += [("pending", m)] if run == 1 else []
            made += [("firing", m)] if run == hold else []
        elif run:
            made.append(("resolved" if run >= hold else "inactive", m))
            run = 0
    return made


@pytest.mark.parametrize("seed", range(4))
def test_alerts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    minutes = {5 * i: rng.random() < 0.7 for i in range(60) if rng.random() < 0.9}
    assert alerts(spark, minutes, seed + 1) == brute_alerts(minutes, seed + 1)


def test_silences_of_known_and_expected_sources(spark):
    df = log(spark, [(0, "a", "success", 1.0), (60, "a", "success", 1.0), (200, "a", "success", 1.0), (300, "late", "success", 1.0)])
    expected = spark.createDataFrame([("never", at(30)), ("late", at(100)), ("a", at(100))], "subset string, since timestamp")
    made = found(changes.silence_changes(df, "1 minute", ("subset",), expected), "at", "last_seen")
    assert made == sorted(
        [
            ("a", "silent", 160, 60),
            ("a", "back", 200, 60),
            ("a", "silent", 260, 200),
            ("late", "silent", 160, None),
            ("late", "back", 300, None),
            ("late", "silent", 360, 300),
            ("never", "silent", 90, None),
        ],
        key=repr,
    )
    # A pause of exactly the time-out is no silence.
    assert found(changes.silence_changes(df, "1 minute"), "at")[:2] == [("a", "back", 200), ("a", "silent", 120)]


def brute_silences(moments, since, timeout):
    """Second by second, for one source."""
    made, silent = [], False
    last = None
    for second in range(min([*moments, since]), max([*moments, since]) + timeout + 2):
        came = second in moments
        watched_from = max(since, last) if last is not None else since
        if not silent and second > watched_from + timeout:
            made.append(("silent", watched_from + timeout, last))
            silent = True
        if came:
            if silent:
                made.append(("back", second, last))
            last, silent = second, False
    return made


@pytest.mark.parametrize("seed", range(4))
def test_silences_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    moments = sorted(rng.sample(range(2_000), 40))
    since = rng.choice([0, 500, 1_500, 3_000])
    expected = spark.createDataFrame([("a", at(since))], "subset string, since timestamp")
    df = log(spark, [(s, "a", "success", 1.0) for s in moments])
    made = found(changes.silence_changes(df, "45 seconds", ("subset",), expected), "at", "last_seen")
    assert made == sorted((("a", *row) for row in brute_silences(moments, since, 45)), key=repr)


def test_nothing_from_nothing(spark):
    empty = log(spark, [(0, "a", "success", 1.0)]).where("false")
    assert changes.silence_changes(empty, "1 minute").count() == 0
    assert changes.alert_changes(windows(spark, {5: True}).where("false"), F.col("breach"), 2, "5 minutes").count() == 0


# ---------------------------------------------------------------- streams


def traffic_rows(seed):
    """Two sources with busy and quiet spells, bursts of errors and slow answers."""
    rng, rows, second = random.Random(seed), [], 0
    while second < 20_000:
        second += rng.choice([5, 20, 40, 90, 400])
        bad = (second // 1_500) % 2 == 0
        status = "error" if bad and rng.random() < 0.6 else "success"
        rows.append((second, rng.choice("aab"), status, 4.0 if bad else 0.1))
    return rows


@pytest.fixture(scope="module")
def arriving(spark, tmp_path_factory):
    """(batch log, folder): the log in six files, slightly out of order, then one row far ahead."""
    rows = traffic_rows(1)
    folder = tmp_path_factory.mktemp("changes")
    parts = [[r for r in rows if (r[0] + 37 * (r[0] % 3)) // 3_600 == i] for i in range(6)]
    for i, part in enumerate([*parts, [(10**7, "a", "success", 0.1)]]):
        log(spark, part).coalesce(1).write.parquet(f"{folder}/staged{i}")
        piece = next((folder / f"staged{i}").glob("*.parquet"))
        (folder / "in").mkdir(exist_ok=True)
        os.link(piece, folder / "in" / f"log{i}.parquet")
        stamp = time.time() - 100 + i
        os.utime(folder / "in" / f"log{i}.parquet", (stamp, stamp))
    return log(spark, [r for part in parts for r in part]), str(folder)


def stream(spark, folder):
    reader = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/in").withWatermark("ts", "5 minutes")


def run(spark, made, folder):
    live_features.use_rocksdb(spark)
    name = uuid.uuid4().hex
    query = traffic.write_rows(made, f"{folder}/{name}", f"{folder}/{name}-checkpoint")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 3
    return spark.read.schema(made.schema).parquet(f"{folder}/{name}")


@pytest.mark.parametrize("by", [("subset",), ()])
def test_stream_of_error_alerts_equals_batch(spark, arriving, by):
    df, folder = arriving
    made = run(spark, live.error_alert_changes(stream(spark, folder), "5 minutes", "1 minute", 3, 0.2, by), folder)
    rates = monitoring.error_rate(df, "5 minutes", "1 minute", by)
    expected = changes.alert_changes(rates, F.col("error_percent") > 20, 3, "1 minute", by)
    assert expected.where("state = 'resolved'").count() > 2
    assert sorted(made.collect()) == sorted(expected.collect())


def test_stream_of_latency_alerts_equals_batch(spark, arriving):
    df, folder = arriving
    made = run(spark, live.latency_alert_changes(stream(spark, folder), hold_windows=2, by=("subset",)), folder)
    quantiles = monitoring.latency_quantile(df, by=("subset",))
    expected = changes.alert_changes(quantiles, F.col("latency_p95_s") > 2, 2, "5 minutes", ("subset",))
    assert {r["state"] for r in expected.collect()} >= {"pending", "firing", "resolved"}
    assert sorted(made.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("grain", [None, "20 seconds"])
def test_stream_of_silences_equals_batch(spark, arriving, grain):
    df, folder = arriving
    expected = spark.createDataFrame([("never", at(700)), ("b", at(5_000))], "subset string, since timestamp")
    made = run(spark, live.silence_changes(stream(spark, folder), "3 minutes", ("subset",), expected, grain), folder)
    batch = changes.silence_changes(df, "3 minutes", ("subset",), expected)
    assert found(made, "at", "last_seen") == found(batch, "at", "last_seen")
    assert ("never", "silent", 880, None) in found(made, "at", "last_seen")


def test_grain_within_time_out(spark, arriving):
    with pytest.raises(ValueError):
        live.silence_changes(stream(spark, arriving[1]), "1 minute", grain="2 minutes")
