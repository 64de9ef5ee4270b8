"""State of live features on a stub of Spark's state handle."""

import datetime
import random

import numpy as np

from fleetlife.operators import evaluation, temporal
from fleetlife.streaming import corrections, live_features
from fleetlife.streaming.live_features import BlockFeatures


class Slot:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value if self.value is not None else []

    def put(self, value):
        self.value = list(value)

    update = put

    def clear(self):
        self.value = None


class Handle:
    def __init__(self):
        self.slots, self.timers = {}, []

    def getListState(self, name, _):
        return self.slots.setdefault(name, Slot())

    getValueState = getListState

    def registerTimer(self, at):
        self.timers.append(at)


def processor(block_rows=20, idle_ms=1_000):
    made, handle = BlockFeatures(("subset", "unit_id"), ["sensor_2"], (1,), (3,), 0.5, 2, block_rows, idle_ms), Handle()
    made.init(handle)
    return made, handle


def advance(made, cycles, watermark=0):
    frames = list(made._advance(("FD001", 1, 0), [(10 * c, c, True, float(c)) for c in cycles], watermark))
    return [(r["cycle"], r["status"], r["missing_before"]) for f in frames for _, r in f.iterrows()]


def test_a_late_row_after_a_finished_block_is_late():
    made, handle = processor()
    early = [c for c in range(1, 21) if c != 5]
    assert [r[0] for r in advance(made, early)] == [1, 2, 3, 4]
    assert [r[0] for r in advance(made, [], 201)] == early[4:]
    assert [r[:2] for r in advance(made, [5], 201)] == [(5, "late")]


def test_an_idle_block_frees_its_state():
    made, handle = processor()
    advance(made, range(1, 8))
    assert handle.slots["cursor"].exists() and handle.slots["past"].exists()
    assert max(handle.timers) == 70 + 1_000
    advance(made, [], 900)
    assert handle.slots["cursor"].exists()
    advance(made, [], 70 + 1_000)
    assert not any(slot.exists() for slot in handle.slots.values())


def test_waiting_rows_share_a_timer():
    made, handle = processor()
    advance(made, [1, *range(3, 15)])
    assert sorted(handle.timers) == [31, 140 + 1_000]


def place(rows):
    return sorted((r["unit_id"], r["cycle"], r["status"], r["missing_before"], r["sensor_2_rolling_mean_3"], r["sensor_2_ewma"]) for r in rows)


def frames_of(frames):
    return [r for f in frames for _, r in f.astype(object).where(f.notna(), None).iterrows()]


def test_blocks_of_a_group_share_calls_and_know_nothing_of_each_other():
    rng = random.Random(5)
    together, handle = processor()
    alone, watermark, seen = {}, 0, set()
    for trigger in range(12):
        came = [(u, b, 10 * c + rng.randrange(200), c, True, (rng.random(),)) for u in range(60) for b in (0, 1) for c in rng.sample(range(1 + 20 * b, 21 + 20 * b), 4)]
        rng.shuffle(came)
        rows = np.array([] if trigger % 3 == 2 else came, dtype=together.row)
        before = len(handle.timers)
        frames = list(together._advance_blocks(("FD001",), rows, watermark))
        # However many blocks: a frame of features and one of late rows, the first row to fall due and the first block to idle.
        assert len(frames) <= 2 and len(handle.timers) - before <= 2
        got, want = frames_of(frames), []
        for at in sorted({(u, b) for u in range(60) for b in (0, 1)}):
            made = alone.setdefault(at, processor()[0])
            own = [(r[2], r[3], r[4], *r[5]) for r in came if r[:2] == at] if trigger % 3 != 2 else []
            want += frames_of(made._advance(("FD001", *at), own, watermark))
        assert place(got) == place(want)
        seen |= {(r["status"], r["missing_before"]) for r in got}
        watermark += rng.randrange(100)
    list(together._advance_blocks(("FD001",), np.array([], dtype=together.row), 10_000))
    assert not any(slot.exists() for slot in handle.slots.values())
    assert seen >= {("ok", 0), ("ok", 3), ("late", None)}


def test_state_and_frames_are_bounded_by_groups(spark, frame, tmp_path):
    live_features.use_rocksdb(spark)
    start = datetime.datetime(2024, 1, 1)
    rows = frame([(u, c, start + datetime.timedelta(minutes=c), float(u * c)) for u in range(1, 301) for c in range(1, 6)], "unit_id int, cycle int, ts timestamp, sensor_2 double")
    rows.write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in").withWatermark("ts", "10 minutes")
    made = live_features.live_features(arriving, ["sensor_2"], (1,), (2,), 0.5)
    query = corrections.write_released(made, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    released = spark.read.schema(made.schema).parquet(f"{tmp_path}/out/released")
    want = temporal.temporal_features(rows.drop("ts"), ["sensor_2"], (1,), (2,), 0.5)
    assert released.count() == 1500
    assert evaluation.feature_parity(released, want, temporal.feature_names(["sensor_2"], (1,), (2,)), rtol=1e-9, atol=1e-9).count() == 0
    fewer = live_features.live_features(arriving, ["sensor_2"], (1,), (2,), 0.5, groups=4)
    query = corrections.write_released(fewer, f"{tmp_path}/out_4", f"{tmp_path}/checkpoint_4")
    query.awaitTermination()
    # A cursor, past rows and timers per group: not per unit.
    assert query.recentProgress[0]["stateOperators"][0]["numRowsTotal"] <= 4 * 4
    assert spark.read.schema(made.schema).parquet(f"{tmp_path}/out_4/released").exceptAll(released).count() == 0
