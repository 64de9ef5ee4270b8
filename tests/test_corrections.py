"""Late rows release the rows within their reach again; the last version equals batch."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from fleetlife.operators import evaluation, temporal
from fleetlife.streaming import corrections, live_features

START = datetime.datetime(2024, 1, 1)
ROWS = "unit_id int, cycle int, ts timestamp, sensor_2 double"
OPTIONS = {"lags": (1, 3), "windows": (2, 5), "alpha": 0.9}
NAMES = temporal.feature_names(["sensor_2"], (1, 3), (2, 5))


@pytest.fixture
def feed(spark, frame, tmp_path):
    """Sends parts, lists of (unit, cycle, minute, reading), through one stream run by run."""
    live_features.use_rocksdb(spark)
    sent = frame([], ROWS)

    class Feed:
        path = f"{tmp_path}/out"
        schema = None

        def send(self, part):
            rows = [(u, c, START + datetime.timedelta(minutes=m), x) for u, c, m, x in part]
            frame(rows, ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            arriving = spark.readStream.schema(sent.schema).parquet(f"{tmp_path}/in").withWatermark("ts", "10 minutes")
            features = live_features.live_features(arriving, ["sensor_2"], block_rows=30, **OPTIONS)
            self.schema = features.schema
            corrections.write_released(features, self.path, f"{tmp_path}/checkpoint").awaitTermination()

        def correct(self):
            return corrections.correct(spark, self.path, self.schema, ["sensor_2"], **OPTIONS)

        def current(self):
            return corrections.read_current(spark, self.path, self.schema).where("unit_id > 0")

    return Feed()


def seen(feed):
    return {(r["unit_id"], r["cycle"]): (r["version"], r["missing_before"], r["sensor_2_lag_1"]) for r in feed.current().collect()}


def test_late_row_corrects_its_followers(feed):
    feed.send([(1, 1, 0, 1.0), (1, 2, 1, 2.0), (1, 4, 3, 4.0), (2, 1, 0, 7.0), (0, 1, 60, 0.0)])
    feed.send([(0, 2, 120, 0.0)])
    assert seen(feed) == {(1, 1): (0, 0, None), (1, 2): (0, 0, 1.0), (1, 4): (0, 1, 2.0), (2, 1): (0, 0, None)}
    feed.send([(1, 3, 121, 3.0)])
    # Not taken up yet: the late row is left out.
    assert (1, 3) not in seen(feed)
    assert feed.correct() == 1
    wanted = {(1, 1): (0, 0, None), (1, 2): (0, 0, 1.0), (1, 3): (1, 0, 2.0), (1, 4): (1, 0, 3.0), (2, 1): (0, 0, None)}
    assert seen(feed) == wanted
    # Nothing new: no pass. A row that follows later doesn't know the late one until the next pass.
    assert feed.correct() == 0
    feed.send([(1, 5, 122, 5.0), (0, 3, 240, 0.0)])
    assert feed.correct() == 2
    assert seen(feed) == wanted | {(1, 5): (2, 0, 4.0)}


def test_broken_pass_is_never_read(spark, feed):
    feed.send([(1, 1, 0, 1.0), (1, 3, 3, 3.0), (0, 1, 60, 0.0)])
    feed.send([(1, 2, 121, 2.0)])
    before = seen(feed)
    # A pass that ended before its manifest: rows, but no entry.
    feed.current().drop("version").withColumn("missing_before", F.lit(99)).write.parquet(f"{feed.path}/corrected/pass=1")
    assert seen(feed) == before
    assert feed.correct() == 1
    assert seen(feed) == {(1, 1): (0, 0, None), (1, 2): (1, 0, 1.0), (1, 3): (1, 0, 2.0)}


def test_first_released_row_of_a_cycle_holds(feed):
    feed.send([(1, 1, 0, 1.0), (1, 2, 1, 2.0), (0, 1, 60, 0.0)])
    feed.send([(1, 1, 121, 50.0)])
    assert feed.correct() == 1
    assert {k: v[2] for k, v in seen(feed).items()} == {(1, 1): None, (1, 2): 1.0}


def test_out_of_order_stream_equals_batch(spark, frame, feed):
    rng = random.Random(3)
    rows = [(u, c, c, rng.uniform(0, 10)) for u, n in ((1, 100), (2, 35), (3, 4)) for c in range(1, n + 1)]
    parts = [[], [], []]
    for row in rows:
        parts[rng.choices((0, 1, 2), (0.85, 0.1, 0.05))[0]].append(row)
    for i, part in enumerate(parts):
        feed.send([(u, c, m + 1_000 * i, x) for u, c, m, x in part] + [(0, i + 1, 1_000 * i + 500, 0.0)])
        feed.correct()
    feed.send([(0, 9, 9_000, 0.0)])
    feed.correct()
    plain = frame([(u, c, x) for u, c, _, x in rows], "unit_id int, cycle int, sensor_2 double")
    want = temporal.temporal_features(plain, ["sensor_2"], **OPTIONS)
    made = feed.current()
    assert made.count() == len(rows) and made.where("version > 0").count() > 20
    assert made.where("missing_before > 0").count() == 0
    assert evaluation.feature_parity(made, want, ["sensor_2", *NAMES], rtol=1e-9, atol=1e-9).count() == 0


def test_late_rows_of_a_freed_block_are_corrected(feed):
    """State is freed after a week without rows: what comes then looks like the first row of its block."""
    days = 24 * 60
    feed.send([(1, 1, 0, 1.0), (1, 2, 1, 2.0), (1, 4, 3, 4.0), (1, 5, 4, 5.0), (0, 1, 30 * days, 0.0)])
    feed.send([(0, 2, 31 * days, 0.0)])
    feed.send([(1, 3, 32 * days, 3.0), (0, 3, 33 * days, 0.0)])
    assert feed.correct() == 1
    feed.send([(0, 4, 34 * days, 0.0)])
    feed.correct()
    got = seen(feed)
    assert {k: v[1:] for k, v in got.items()} == {(1, 1): (0, None), (1, 2): (0, 1.0), (1, 3): (0, 2.0), (1, 4): (0, 3.0), (1, 5): (0, 4.0)}
    assert got[1, 2][0] == 0 and got[1, 3][0] > 0 and got[1, 4][0] > 0


RELEASED = "unit_id int, cycle int, ts_ms long, status string, missing_before int, sensor_2 double, trigger long"


def released(frame, units):
    """Rows of units from lists of (cycle, status, missing before, trigger)."""
    return frame([(u, c, 0, status, missing, 1.0, trigger) for u, rows in units.items() for c, status, missing, trigger in rows], RELEASED)


def test_units_whose_gaps_are_as_they_say_are_only_counted(frame):
    rows = released(
        frame,
        {
            1: [(1, "ok", 0, 0), (4, "ok", 2, 0), (5, "ok", 0, 1)],
            2: [(1, "ok", 0, 0), (2, "ok", 0, 0)],
            3: [(2, "ok", 1, 0), (3, "late", None, 1)],
            # Both errors together leave the sum of missing cycles right.
            4: [(1, "ok", 0, 0), (3, "ok", 0, 0), (5, "ok", 2, 1)],
            5: [(1, "ok", 0, 0), (1, "ok", 0, 1)],
            6: [(2, "ok", 0, 1)],
            # As 4, but nothing is new.
            7: [(1, "ok", 0, 0), (3, "ok", 0, 0), (5, "ok", 2, 0)],
        },
    )
    assert {r["unit_id"] for r in corrections.units_to_correct(rows, 0).collect()} == {3, 4, 5, 6}
    assert {r["unit_id"] for r in corrections.units_to_correct(rows, -1).collect()} == {3, 4, 5, 6, 7}


def test_a_late_row_reaches_as_far_in_long_units(spark, frame):
    """Rows of many slices and blocks with gaps between: those in reach of a late row, and their features, are as in batch."""
    rng = random.Random(8)
    width = corrections.reach(**OPTIONS)
    kept = {u: sorted(rng.sample(range(1, 3 * n), n)) for u, n in ((1, 5_000), (2, 300), (3, 2))}
    late = {1: set(rng.sample(kept[1], 3)) | {kept[1][2_047], kept[1][4_095]}, 2: {kept[2][0]}, 3: set()}
    value = {(u, c): rng.uniform(0, 10) for u, cycles in kept.items() for c in cycles}
    told, want = [], []
    for u, cycles in kept.items():
        last, reached = 0, -1
        for i, c in enumerate(cycles):
            if c in late[u]:
                told.append((u, c, 0, "late", None, value[u, c], 1))
                reached = i + width  # its follower says wrongly what is missing, and has the same reach
            else:
                told.append((u, c, 0, "ok", c - last - 1, value[u, c], 0))
                last = c
            if i <= reached:
                want.append((u, c, c - (cycles[i - 1] if i else 0) - 1))
    # A second row of the cycle of one in time never holds.
    told.append((1, kept[1][9], 0, "late", None, 99.0, 1))
    reached = {(1, c, c - (kept[1][i - 1] if i else 0) - 1) for i, c in enumerate(kept[1]) if 9 <= i < 9 + width}
    made = corrections.corrected_rows(frame(told, RELEASED), ["sensor_2"], 0, **OPTIONS)
    got = {(r["unit_id"], r["cycle"], r["missing_before"]) for r in made.collect()}
    assert set(want) - got == set() and got - set(want) - reached == set()
    batch = temporal.temporal_features(frame([(*k, x) for k, x in value.items()], "unit_id int, cycle int, sensor_2 double"), ["sensor_2"], **OPTIONS)
    compared = batch.join(made.select("subset", "unit_id", "cycle"), ["subset", "unit_id", "cycle"], "left_semi")
    assert evaluation.feature_parity(made, compared, ["sensor_2", *NAMES], rtol=1e-9, atol=1e-9).count() == 0


def test_readings_that_are_missing_leave_the_others_right(frame):
    rows = [(c, "late" if c == 40 else "ok", None if c == 40 else int(c == 41), int(c == 40)) for c in range(1, 200)]
    plain = released(frame, {1: rows}).withColumn("sensor_2", F.when(F.col("cycle") % 7 != 0, F.col("cycle").cast("double")))
    made = corrections.corrected_rows(plain, ["sensor_2"], 0, **OPTIONS)
    batch = temporal.temporal_features(plain.select("subset", "unit_id", "cycle", "sensor_2"), ["sensor_2"], **OPTIONS)
    compared = batch.join(made.select("subset", "unit_id", "cycle"), ["subset", "unit_id", "cycle"], "left_semi")
    assert made.count() == corrections.reach(**OPTIONS) + 1
    assert evaluation.feature_parity(made, compared, ["sensor_2", *NAMES], rtol=1e-9, atol=1e-9).count() == 0
