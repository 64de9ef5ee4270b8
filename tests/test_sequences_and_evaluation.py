import math

import pytest
from pyspark.sql import functions as F

from fleetlife.functions.expressions import regression_metrics
from fleetlife.operators import endpoints, evaluation, selection, sequences, trajectory
from fleetlife.schema import TERMINAL_COLUMN, feature_columns

STEPS = "unit_id int, cycle int, RUL int, sensor_2 double, sensor_3 double"


def two_units(frame):
    rows = [(3, 1, 6, 0.5, -1.0), (3, 2, 5, 2.5, -4.0), (3, 3, 4, 1.5, -9.0), (3, 4, 3, 9.5, -2.0), (8, 1, 2, 7.0, 30.0), (8, 2, 1, 6.0, 50.0)]
    return frame(rows[::-1], STEPS)


@pytest.mark.parametrize("contiguous, block_rows", [(True, 2048), (False, 2048), (True, 4), (False, 4)])
def test_sliding_sequences(frame, contiguous, block_rows):
    made = sequences.sliding_sequences(two_units(frame), ["sensor_3", "sensor_2"], 2, contiguous=contiguous, block_rows=block_rows)
    rows = made.orderBy("unit_id", "cycle").collect()
    assert [r["sequence"] for r in rows] == [
        [[-1, 0.5], [-4, 2.5]],
        [[-4, 2.5], [-9, 1.5]],
        [[-9, 1.5], [-2, 9.5]],
        [[30, 7], [50, 6]],
    ]
    assert [r["target"] for r in rows] == [5, 4, 3, 1]


def long_units(frame, lengths):
    rows = [(u, c, n - c, float(c), 0.0) for u, n in lengths.items() for c in range(1, n + 1)]
    return frame(rows, STEPS)


@pytest.mark.parametrize("block_rows", [2048, 60])
def test_short_units_have_no_full_sequence(frame, block_rows):
    made = sequences.sliding_sequences(long_units(frame, {1: 17, 2: 40, 3: 18}), ["sensor_2"], 18, block_rows=block_rows)
    counts = {r["unit_id"]: r["count"] for r in made.groupBy("unit_id").count().collect()}
    assert counts == {2: 23, 3: 1}


def ends(frame, points):
    return frame(points, "unit_id int, end_cycle int")


@pytest.mark.parametrize("contiguous", [True, False])
def test_endpoint_sequences(frame, contiguous):
    made = sequences.endpoint_sequences(two_units(frame), ends(frame, [(3, 3), (8, 2)]), ["sensor_2"], 2, contiguous=contiguous)
    assert [r["sequence"] for r in made.orderBy("unit_id").collect()] == [[[2.5], [1.5]], [[7], [6]]]


def test_endpoint_sequences_are_not_padded(frame):
    made = sequences.endpoint_sequences(long_units(frame, {1: 2}), ends(frame, [(1, 2)]), ["sensor_2"], 4, contiguous=True)
    assert made.first()["sequence"] == [[1], [2]]


@pytest.mark.parametrize("block_rows", [2048, 3])
def test_endpoints_between_observed_cycles(frame, block_rows):
    rows = frame([(1, c, 0, float(c), 0.0) for c in (1, 2, 5, 9, 20, 21)], STEPS)
    points = ends(frame, [(1, 1), (1, 4), (1, 8), (1, 19), (1, 500), (1, 0)])
    made = sequences.endpoint_sequences(rows, points, ["sensor_2"], 2, block_rows=block_rows)
    found = {r["cycle"]: [x[0] for x in r["sequence"]] for r in made.collect()}
    assert found == {1: [1], 4: [1, 2], 8: [2, 5], 19: [5, 9], 500: [20, 21]}


def test_positions_across_slices(frame):
    rows = frame([(u, c) for u in (1, 2) for c in range(3, 200, 2)], "unit_id int, cycle int")
    found = trajectory.with_position(rows, block_rows=16).orderBy("unit_id", "cycle").collect()
    assert [r[trajectory.POSITION] for r in found] == list(range(1, 100)) * 2 if len(found) == 198 else False


def test_last_rows(frame):
    found = trajectory.last_rows(long_units(frame, {1: 5, 2: 3}), ["sensor_2", "RUL"]).orderBy("unit_id").collect()
    assert [(r["unit_id"], r["cycle"], r["sensor_2"], r["RUL"]) for r in found] == [(1, 5, 5.0, 0), (2, 3, 3.0, 0)]


def test_model_inputs(frame):
    rows = two_units(frame).withColumn("operating_regime", F.lit(1)).withColumn("sensor_2_lag_1", F.lit(0.0))
    assert feature_columns(rows.columns) == ["sensor_2", "sensor_3", "sensor_2_lag_1"]
    assert selection.model_inputs(rows, ["sensor_3", "sensor_2"]).columns == ["sensor_3", "sensor_2", "RUL"]
    capped = selection.cap_target(rows, 4).agg(F.max("RUL"), F.min("RUL")).first()
    assert tuple(capped) == (4, 1)


def test_dense_features(frame):
    rows = frame([(1, 1, 0, None, float("nan")), (1, 2, 0, 2.5, 1.0)], STEPS)
    found = selection.dense_float_features(rows, ["sensor_2", "sensor_3"]).orderBy("cycle")
    assert [tuple(r)[4:] for r in found.collect()] == [(0.0, 0.0), (2.5, 1.0)]
    assert found.schema["sensor_2"].dataType.simpleString() == "float"


def test_pseudo_endpoints(frame):
    rows = long_units(frame, {1: 10, 2: 10})
    first, again = (endpoints.pseudo_endpoints(df).orderBy("unit_id").collect() for df in (rows, rows.repartition(5)))
    assert [(r["unit_id"], r["cycle"], r["RUL"]) for r in first] == [(1, 8, 2), (2, 5, 5)]
    assert first == again


def test_cutoffs_equal_their_definition(frame):
    import hashlib

    lengths = {u: 2 + (u * 7) % 50 for u in range(1, 80)}
    found = endpoints.cutoffs(long_units(frame, lengths), [42, 7], 0.5).collect()
    for row in found:
        n = lengths[row["unit_id"]]
        low = max(1, math.ceil(n * 0.5))
        digest = hashlib.sha256(f"{row['seed']}:{row['unit_id']}".encode()).digest()
        assert row["cycle"] == low + int.from_bytes(digest[:8], "big") % (n - low)
    assert len(found) == 2 * len(lengths)


def test_units_without_a_cutoff_are_reported(frame):
    rows = long_units(frame, {1: 10, 3: 1}).where("not (unit_id = 1 and cycle = 8)")
    found = {r["unit_id"]: r["reason"] for r in endpoints.endpoint_violations(rows).collect()}
    assert found == {1: "no unique cutoff row", 3: "needs two observed cycles"}
    with pytest.raises(ValueError, match="cutoff"):
        endpoints.raise_on_endpoint_violations(rows)


def predictions(frame, rows):
    return frame(rows, "unit_id int, cycle int, RUL int, prediction double")


def test_row_metrics(frame):
    found = evaluation.row_metrics(predictions(frame, [(1, 1, 70, 44.0), (2, 1, 15, 20.0), (3, 1, 9, 9.0), (4, 1, 40, 55.0)])).first()
    assert found["rmse"] == pytest.approx(math.sqrt(926 / 4))
    assert found["mae"] == pytest.approx(46 / 4)
    assert found["rul_score"] == pytest.approx(math.expm1(2) + math.expm1(0.5) + math.expm1(1.5))
    assert found["bias"] == pytest.approx(-1.5)
    assert found["late_prediction_rate"] == pytest.approx(1 / 2)


def test_diagnostics_are_worst_first(frame):
    rows = predictions(frame, [(1, 50, 10, 11.0), (2, 60, 20, 50.0)])
    found = evaluation.worst_first(evaluation.diagnostics(rows)).collect()
    assert [(r["unit_id"], r["error"]) for r in found] == [(2, 30.0), (1, 1.0)]
    tail = evaluation.tail_metrics(rows).first()
    assert tail["worst_positive_error"] == 30.0 and tail["worst_negative_error"] == 0.0
    assert tail["top_3_score_contribution"] == pytest.approx(math.expm1(3) + math.expm1(0.1))


def test_official_endpoints(frame):
    rows = frame([(1, 1, 999), (1, 2, 999), (2, 1, 999), (2, 3, 999)], "unit_id int, cycle int, RUL int")
    terminal = frame([(1, 25), (2, 5)], f"unit_id int, {TERMINAL_COLUMN} int")
    points = endpoints.official_endpoints(rows, terminal).withColumn("prediction", F.when(F.col("unit_id") == 1, 20.0).otherwise(10.0))
    assert {(r["unit_id"], r["cycle"], r["RUL"]) for r in points.collect()} == {(1, 2, 25), (2, 3, 5)}
    found = points.agg(*regression_metrics(F.col("prediction") - F.col("RUL"))).first()
    assert found["rmse"] == found["mae"] == 5.0
    assert found["rul_score"] == pytest.approx(math.expm1(5 / 13) + math.expm1(0.5))
    assert endpoints.duplicate_units(terminal.unionByName(terminal)).count() == 2
    with pytest.raises(Exception, match="several official records"):
        endpoints.official_endpoints(rows, terminal.unionByName(terminal)).collect()


def test_champion_and_competitor(spark):
    rows = [("FD001", c, r, s, v, v, v, v) for c, r, vs in (("a", "champion", (1.0, 5.0, 3.0)), ("b", "competitor", (2.0, 4.0, 3.0))) for s, v in enumerate(vs)]
    by_seed = spark.createDataFrame(rows, "subset string, candidate string, role string, seed int, mae double, rmse double, rul_score double, worst_positive_error double")
    assert evaluation.win_rates(by_seed).first()["champion_win_rate"] == pytest.approx(1 / 3)
    report = {r["candidate"]: r for r in evaluation.robustness_report(by_seed).collect()}
    assert report["a"]["median_mae"] == 3.0 and report["a"]["worst_seed_rul_score"] == 5.0
    assert report["b"]["champion_win_rate"] == 0.333


def test_feature_parity_treats_nan_as_null(frame):
    columns = "unit_id int, cycle int, a double, b double"
    left = frame([(1, 1, None, 1.0), (1, 2, 2.0, 1.0), (1, 3, 1.0, None)], columns)
    right = frame([(1, 1, float("nan"), 1.0 + 1e-13), (1, 2, 2.1, 1.0), (1, 3, 1.0, 5.0)], columns)
    found = {(r["cycle"], r["feature"]) for r in evaluation.feature_parity(left, right, ["a", "b"]).collect()}
    assert found == {(2, "a"), (3, "b")}


def test_quotas_and_samples(spark, frame):
    rows = frame([(u, c) for u in range(1, 31) for c in (29, 30, 31)], "unit_id int, cycle int")
    both = rows.unionByName(rows.where("unit_id <= 5").withColumn("subset", F.lit("FD002")))
    shares = endpoints.quotas(both, 7)
    assert {r["subset"]: r["quota"] for r in shares.collect()} == {"FD001": 4, "FD002": 3}
    picks = endpoints.random_rows(both, 42, minimum_cycle=30)
    sampled = endpoints.sample_units(picks, shares, 1)
    again = endpoints.sample_units(endpoints.random_rows(both.repartition(7), 42, 30), shares, 1)
    assert sampled.exceptAll(again.select(sampled.columns)).count() == 0
    assert sampled.groupBy("subset").count().orderBy("subset").collect()[0]["count"] == 4
    assert endpoints.short_subsets(sampled, shares).count() == 0
    with pytest.raises(ValueError, match="too few units"):
        endpoints.sample_units(picks, endpoints.quotas(both, 30), 1, strict=True)
    assert endpoints.short_subsets(sampled.where("subset = 'FD001'"), shares).count() == 1
