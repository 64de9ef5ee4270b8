"""Stored sketches: error bound, merging in any order and grouping, odd values, streams."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from fleetlife.operators import sketches
from fleetlife.streaming import traffic

START = datetime.datetime(2024, 1, 1)
LOG = "ts timestamp_ntz, subset string, model_type string, latency_s double"


def log(spark, rows):
    """rows: (second, subset, model, latency)"""
    return spark.createDataFrame([(START + datetime.timedelta(seconds=s), *rest) for s, *rest in rows], LOG)


def sample(seed, n=3_000):
    rng = random.Random(seed)
    draw = [lambda: rng.lognormvariate(-1, 2), lambda: rng.uniform(0, 5), lambda: rng.choice([0.25, 0.5, 1.0]), lambda: 0.0]
    return [(rng.randrange(3_600), rng.choice("aab"), rng.choice("xy"), rng.choice(draw)()) for _ in range(n)]


def exact(values, q):
    return sorted(values)[math.floor(q * (len(values) - 1))]


@pytest.mark.parametrize("accuracy", [0.01, 0.05])
def test_error_bound_after_merging(spark, accuracy):
    rows = sample(1)
    kept = sketches.latency_sketches(log(spark, rows), "1 minute", accuracy=accuracy)
    at = (0.0, 0.1, 0.5, 0.95, 0.999, 1.0)
    names = ["latency_p0_s", "latency_p10_s", "latency_p50_s", "latency_p95_s", "latency_p99_9_s", "latency_p100_s"]
    for size, length in (("10 minutes", 600), (None, 3_600)):
        found = sketches.quantiles(sketches.merge_sketches(kept, size, ("subset",)), at, accuracy).collect()
        assert len(found) == 2 * 3_600 // length
        for row in found:
            begin = (row["window_start"] - START).seconds
            values = [r[3] for r in rows if r[1] == row["subset"] and begin <= r[0] < begin + length]
            assert row["requests"] == len(values)
            for q, name in zip(at, names):
                true = exact(values, q)
                assert abs(row[name] - true) <= accuracy * true * (1 + 1e-9) + sketches.SMALLEST


def test_merged_equals_sketch_of_the_whole(spark):
    df = log(spark, sample(2))
    fine = sketches.latency_sketches(df, "1 minute")
    steps = sketches.merge_sketches(sketches.merge_sketches(fine, "5 minutes", ("subset", "model_type")), "30 minutes", ("subset",))
    whole = sketches.latency_sketches(df, "30 minutes", ("subset",))
    assert sorted(steps.select(whole.columns).collect()) == sorted(whole.collect())


def test_odd_latencies(spark):
    nan, inf = float("nan"), float("inf")
    df = log(spark, [(0, "a", "x", None), (1, "a", "x", nan), (2, "b", "x", -3.0), (3, "b", "x", 0.0), (4, "c", "x", inf), (5, "c", "x", 1e300), (6, None, "x", 2.0)])
    made = sketches.quantiles(sketches.latency_sketches(df, by=("subset",)), (0.5,))
    found = {r["subset"]: (r["requests"], r["latency_p50_s"]) for r in made.collect()}
    assert found["a"] == (0, None) and found["b"] == (2, 0.0)
    assert found["c"][0] == 2 and found["c"][1] == pytest.approx(sketches.LARGEST, rel=0.01)
    assert found[None] == (1, pytest.approx(2.0, rel=0.01))
    merged = sketches.quantiles(sketches.merge_sketches(sketches.latency_sketches(df, by=("subset",)), by=("subset",)), (0.5,))
    assert {r["subset"]: (r["requests"], r["latency_p50_s"]) for r in merged.collect()} == found


def test_empty_and_refused(spark):
    none = sketches.latency_sketches(log(spark, [(0, "a", "x", 1.0)]).where("false"))
    assert none.count() == 0
    assert sketches.merge_sketches(none, "5 minutes", ("subset",)).count() == 0
    assert sketches.merge_sketches(none).count() == 0
    with pytest.raises(ValueError):
        sketches.sketch_quantile(F.col("sketch"), 1.5)
    with pytest.raises(ValueError):
        sketches.growth(1.0)


def test_hot_group_costs_its_buckets(spark):
    df = spark.range(200_000).select(F.lit(START).cast("timestamp_ntz").alias("ts"), F.lit("a").alias("subset"), F.lit("x").alias("model_type"), (F.col("id") % 1_000 / 100.0).alias("latency_s"))
    row = sketches.latency_sketches(df).first()
    assert sum(part["n"] for part in row["sketch"]) == 200_000 and len(row["sketch"]) < 400


def test_stream_equals_batch_though_the_last_row_has_no_latency(spark, tmp_path):
    df = log(spark, [*sample(3, 500), (10**7, "a", "x", None)]).withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(2).write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in").withWatermark("ts", "1 hour")
    made = sketches.latency_sketches(arriving, "5 minutes")
    traffic.write_rows(made, f"{tmp_path}/rows", f"{tmp_path}/checkpoint").awaitTermination()
    rows = spark.read.schema(made.schema).parquet(f"{tmp_path}/rows")
    closed = sketches.latency_sketches(df.where("latency_s IS NOT NULL"), "5 minutes")
    assert sorted(rows.collect()) == sorted(closed.collect())
