"""Temporal features on a stream of telemetry rows.

Rows belong to a unit and block of cycles, with the same lead-in copies as in batch, so a busy
unit is spread and what is kept of a block is bounded. Blocks are dealt by hash to groups, the keys
of state, so that what a key costs is shared by many blocks. A
finished block keeps only its cursor, which tells late rows apart; a block that has had no
row for ``idle`` of event time frees that too, as does an unfinished one. Rows that arrive
out of order wait in state until their predecessor is there, or until the watermark passes them.
"""

from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import fleetlife
from fleetlife.operators.temporal import ewma_block_rows, ewma_memory, feature_names, reject_collisions
from fleetlife.operators.trajectory import BLOCK, BLOCK_ROWS, OWN, POSITION, to_blocks
from fleetlife.schema import EWMA_ALPHA, LAGS, ROLLING_WINDOWS, UNIT

# The processor travels with its code, so executors need no installed package.
cloudpickle.register_pickle_by_value(fleetlife)

#: Event time without a row after which a block's state is freed.
IDLE_MS = 7 * 24 * 3_600_000

#: Blocks of a subset are dealt to so many groups, which are what state is keyed by.
GROUPS = 512
GROUP = "__group"

#: Rows of a frame that is released.
FRAME_ROWS = 8192

#: Time of the earliest waiting row of a block that has none.
NEVER = 2**62

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state of this kind needs the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def valid_rows(rows: DataFrame, sensors, delay="10 minutes") -> DataFrame:
    """Rows fit for features: positive ids, finite readings, one row per unit and cycle."""
    fit = (F.col("unit_id") >= 1) & (F.col("cycle") >= 1)
    for name in sensors:
        fit = fit & F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(F.col(name)) != float("inf"))
    return rows.where(fit).withWatermark("ts", delay).dropDuplicatesWithinWatermark([*UNIT, "cycle"])


def rejected_rows(rows: DataFrame, sensors) -> DataFrame:
    """Quarantine: the rows ``valid_rows`` refuses for their content."""
    bad = (F.col("unit_id") < 1) | (F.col("cycle") < 1) | F.col("unit_id").isNull() | F.col("cycle").isNull()
    for name in sensors:
        bad = bad | F.col(name).isNull() | F.isnan(name) | (F.abs(F.col(name)) == float("inf"))
    return rows.where(bad)


def _codes(records):
    """One number per unit and block of records; both are ints of 32 bits."""
    return records["unit"] * 2**32 + records["block"]


class BlockFeatures(StatefulProcessor):
    """Features of the blocks of one group, row by row in cycle order within a block.

    What a call to state or a frame costs is shared by all blocks of a group: each state is one
    array of records, those of a block marked by its unit and number, and features are computed and
    released for many blocks together. The blocks know nothing of each other.
    """

    def __init__(self, keys, sensors, lags, windows, alpha, lead_in, block_rows, idle_ms=IDLE_MS):
        self.keys, self.sensors = list(keys), list(sensors)
        self.lags, self.windows, self.alpha = lags, windows, alpha
        self.lead_in, self.block_rows, self.idle_ms = lead_in, block_rows, idle_ms
        self.reach = max([0, *lags, *(k - 1 for k in windows)])
        place, readings = [("unit", "i8"), ("block", "i8")], [("readings", "f8", (len(self.sensors),))]
        self.row = place + [("ts_ms", "i8"), ("cycle", "i8"), ("own", "?")] + readings
        self.past_row = place + [("cycle", "i8")] + readings
        # ``waits_ms`` is the time of the earliest waiting row; ``begun`` says that ``readings`` are smoothed values.
        self.place_row = place + [("next_cycle", "i8"), ("last_ms", "i8"), ("waits_ms", "i8"), ("begun", "?")] + readings

    def init(self, handle: StatefulProcessorHandle) -> None:
        records = T.StructType([T.StructField("records", T.BinaryType())])
        self.handle = handle
        self.waiting = handle.getValueState("waiting", records)
        self.past = handle.getValueState("past", records)
        self.cursor = handle.getValueState("cursor", records)

    def _read(self, state, kind):
        import numpy as np

        held = state.get()
        return np.frombuffer(bytes(held[0]), dtype=kind) if held else np.empty(0, dtype=kind)

    def _keep(self, state, before, records) -> None:
        if len(records):
            state.update((records.tobytes(),))
        elif len(before):
            state.clear()

    def _advance(self, key, arrived, watermark_ms):
        """The rows of a block that is alone in its group."""
        import numpy as np

        rows = np.array([(*key[-2:], *row[:3], row[3:]) for row in arrived], dtype=self.row)
        return self._advance_blocks(key[:-2], rows, watermark_ms)

    def _advance_blocks(self, head, arrived, watermark_ms):
        """Release what is next in line, or is older than the watermark, in the blocks of ``arrived`` or, without rows, in those that are due."""
        import numpy as np

        cursors = self._read(self.cursor, self.place_row)
        waiting, past = self._read(self.waiting, self.row), self._read(self.past, self.past_row)
        # Blocks of this call are numbered 0, 1, 2, ... in order of unit and block; others are -1.
        due = (cursors["waits_ms"] < watermark_ms) | (cursors["last_ms"] + self.idle_ms <= watermark_ms)
        touched = arrived if len(arrived) else cursors[due]
        codes, firsts = np.unique(_codes(touched), return_index=True)

        def numbered(records):
            found = _codes(records)
            at = np.searchsorted(codes, found)
            return np.where(np.append(codes, 0)[at] == found, at, -1) if len(codes) else np.full(len(found), -1)

        known, waits, before, new = numbered(cursors), numbered(waiting), numbered(past), numbered(arrived)
        now = np.zeros(len(codes), dtype=self.place_row)
        now["unit"], now["block"] = touched["unit"][firsts], touched["block"][firsts]
        now["next_cycle"], now["last_ms"] = np.maximum(1, now["block"] * self.block_rows - self.lead_in + 1), -1
        now[known[known >= 0]] = cursors[known >= 0]
        came = np.concatenate([waits[waits >= 0], new])
        queue = np.concatenate([waiting[waits >= 0], arrived])
        order = np.lexsort((queue["cycle"], came))
        queue, came = queue[order], came[order]
        ready, gaps, late, rest = self._in_line(now, queue, came, watermark_ms)
        np.maximum.at(now["last_ms"], new, arrived["ts_ms"])
        now["waits_ms"] = NEVER
        np.minimum.at(now["waits_ms"], came[rest], queue["ts_ms"][rest])
        kept = self._take_in(now, past[before >= 0], before[before >= 0], queue[ready], came[ready])
        kept, made = kept if kept else (past[before >= 0], None)
        # Nothing for so long: rows of this block, waiting ones included, are all out.
        idle = (now["last_ms"] + self.idle_ms <= watermark_ms) & (len(arrived) == 0)
        full = now["next_cycle"] > (now["block"] + 1) * self.block_rows
        now["begun"] &= ~full
        now["waits_ms"][full] = NEVER
        over = numbered(kept)
        self._keep(self.past, past, np.concatenate([past[before < 0], kept[~(idle | full)[over]]]))
        self._keep(self.waiting, waiting, np.concatenate([waiting[waits < 0], queue[rest][~(idle | full)[came[rest]]]]))
        all_now = np.concatenate([cursors[known < 0], now[~idle]])
        self._keep(self.cursor, cursors, all_now)
        if len(all_now):
            # Timers only for what falls due first: when they fire, the next ones are set.
            if all_now["waits_ms"].min() < NEVER:
                self.handle.registerTimer(int(all_now["waits_ms"].min()) + 1)
            self.handle.registerTimer(int(all_now["last_ms"].min()) + self.idle_ms)
        if made:
            yield from self._features(head, *made, gaps)
        yield from self._late(head, queue[late][queue["own"][late]])

    def _in_line(self, now, queue, came, watermark_ms):
        """Places in ``queue`` of rows to release, the cycles that are missing before each, and places of late and of waiting rows."""
        ready, gaps, late, rest = [], [], [], []
        at, expected, next_cycles = -1, 0, now["next_cycle"].tolist()
        for i, (block, cycle, ts_ms) in enumerate(zip(came.tolist(), queue["cycle"].tolist(), queue["ts_ms"].tolist(), strict=True)):
            if block != at:
                at, expected = block, next_cycles[block]
            if cycle < expected:
                late.append(i)
            elif cycle == expected or ts_ms <= watermark_ms:
                ready.append(i)
                gaps.append(cycle - expected)
                next_cycles[block] = expected = cycle + 1
            else:
                rest.append(i)
        now["next_cycle"] = next_cycles
        return ready, gaps, late, rest

    def _take_in(self, now, past, before, ready, came):
        """The rows that the next ones of their blocks need, and all rows with what features are computed from; nothing without ``ready`` rows.

        Smoothed values are carried on in ``now``.
        """
        import numpy as np

        if not len(ready):
            return None
        new = np.concatenate([np.zeros(len(past), dtype=bool), np.ones(len(ready), dtype=bool)])
        block = np.concatenate([before, came])
        order = np.lexsort((new, block))
        new, block = new[order], block[order]
        rows = np.concatenate([past, ready[["unit", "block", "cycle", "readings"]].astype(self.past_row)])[order]
        opens = np.flatnonzero(np.diff(block, prepend=-1))
        start = np.repeat(opens, np.diff(opens, append=len(block)))
        end = np.repeat(np.append(opens[1:], len(block)), np.diff(opens, append=len(block)))

        # One step takes the next row of every block that has one.
        readings, smoothed = ready["readings"], np.empty((len(ready), len(self.sensors)))
        firsts = np.flatnonzero(np.diff(came, prepend=-1))
        lengths = np.diff(firsts, append=len(came))
        longest = np.argsort(-lengths, kind="stable")
        firsts, lengths = firsts[longest], lengths[longest]
        of = came[firsts]
        held = np.where(now["begun"][of][:, None], self.alpha * readings[firsts] + (1 - self.alpha) * now["readings"][of], readings[firsts])
        smoothed[firsts] = held
        counts = np.searchsorted(-lengths, -np.arange(1, lengths[0]), side="left").tolist()
        for i, count in enumerate(counts, 1):
            at = firsts[:count] + i
            held = self.alpha * readings[at] + (1 - self.alpha) * held[:count]
            smoothed[at] = held
        now["readings"][of] = smoothed[firsts + lengths - 1]
        now["begun"][of] = True
        return rows[end - np.arange(len(rows)) <= self.reach], (rows, new, start, ready, smoothed)

    def columns(self):
        return [*self.keys, "cycle", "ts_ms", "status", "missing_before", *self.sensors, *feature_names(self.sensors, self.lags, self.windows)]

    def _placed(self, head, rows, status, missing):
        columns = dict(zip(self.keys, head, strict=False))
        columns[self.keys[-1]] = rows["unit"]
        columns |= {"cycle": rows["cycle"], "ts_ms": rows["ts_ms"], "status": status, "missing_before": missing}
        return columns | {s: rows["readings"][:, j] for j, s in enumerate(self.sensors)}

    def _late(self, head, rows):
        """The rows that came too late as one frame, if any, without features."""
        import pandas as pd

        if not len(rows):
            return []
        columns = self._placed(head, rows, "late", None)
        columns |= dict.fromkeys(feature_names(self.sensors, self.lags, self.windows))
        return [pd.DataFrame(columns, columns=self.columns())]

    def _features(self, head, rows, new, start, ready, smoothed, gaps):
        """Features of the blocks' own released rows in frames: shifted arrays, and a matrix of frames per window."""
        import numpy as np

        places, gaps = np.flatnonzero(new)[ready["own"]], np.array(gaps, dtype="int64")[ready["own"]]
        ends, released = smoothed[ready["own"]], ready[ready["own"]]
        for i in range(0, len(places), FRAME_ROWS):
            part = slice(i, i + FRAME_ROWS)
            yield self._frame(head, rows, start[places[part]], places[part], released[part], ends[part], gaps[part])

    def _frame(self, head, rows, start, at, released, ends, gaps):
        import numpy as np
        import pandas as pd

        low = start.min()
        values, cycles = rows["readings"][low : at.max() + 1], rows["cycle"][low : at.max() + 1].astype("float64")
        start, at = start - low, at - low
        columns = self._placed(head, released, "ok", gaps)
        for k in self.lags:
            before = np.where((at - start >= k)[:, None], values[np.maximum(at - k, 0)], np.nan)
            for j, s in enumerate(self.sensors):
                columns[f"{s}_lag_{k}"] = before[:, j]
                columns[f"{s}_diff_{k}"] = values[at, j] - before[:, j]
        for k in self.windows:
            places = at[:, None] - np.arange(k - 1, -1, -1)
            inside, places = places >= start[:, None], np.maximum(places, 0)
            n = inside.sum(axis=1)
            axis = np.where(inside, cycles[places], 0.0)
            centred = np.where(inside, axis - (axis.sum(axis=1) / n)[:, None], 0.0)
            spread = (centred**2).sum(axis=1)
            several = n > 1
            for j, s in enumerate(self.sensors):
                frame = np.where(inside, values[places, j], 0.0)
                mean = frame.sum(axis=1) / n
                squares = (np.where(inside, frame - mean[:, None], 0.0) ** 2).sum(axis=1)
                columns[f"{s}_rolling_mean_{k}"] = mean
                columns[f"{s}_rolling_std_{k}"] = np.where(several, np.sqrt(squares / np.maximum(n - 1, 1)), np.nan)
                columns[f"{s}_rolling_slope_{k}"] = np.where(spread > 0, (centred * frame).sum(axis=1) / np.where(spread > 0, spread, 1.0), np.nan)
        columns |= {f"{s}_ewma": ends[:, j] for j, s in enumerate(self.sensors)}
        return pd.DataFrame(columns, columns=self.columns())

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import numpy as np

        arrived = []
        for batch in rows:
            part = np.empty(len(batch), dtype=self.row)
            for i, name in enumerate(("unit", "block", "ts_ms", "cycle"), len(key)):
                # Fails on a null, where a cast of arrays would not.
                part[name] = batch.iloc[:, i].astype("int64")
            part["own"] = batch.iloc[:, len(key) + 4].astype("bool")
            for j in range(len(self.sensors)):
                part["readings"][:, j] = batch.iloc[:, len(key) + 5 + j].astype("float64")
            arrived.append(part)
        yield from self._advance_blocks(key[1:], np.concatenate(arrived), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import numpy as np

        yield from self._advance_blocks(key[1:], np.empty(0, dtype=self.row), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def live_features(rows: DataFrame, sensors, lags=LAGS, windows=ROLLING_WINDOWS, alpha=EWMA_ALPHA, block_rows=BLOCK_ROWS, idle_ms=IDLE_MS, groups=GROUPS) -> DataFrame:
    """Stream of (subset, unit_id, cycle, ts, sensors) to the same with features.

    ``status`` is ``ok``, or ``late`` for a row whose place was already passed;
    ``missing_before`` counts the cycles skipped before a row. ``rows`` must carry a
    watermark on ``ts``.
    """
    sensors = list(sensors)
    reject_collisions(rows, feature_names(sensors, lags, windows))
    lead_in = max([ewma_memory(alpha), *lags, *(k - 1 for k in windows)])
    size = ewma_block_rows(alpha, lead_in, block_rows)
    blocked = to_blocks(rows.select(*UNIT, "cycle", "ts", *sensors), lead_in, UNIT, size, contiguous=True)
    # The processor takes the columns by their place.
    group = F.pmod(F.xxhash64("unit_id", BLOCK), F.lit(groups)).cast("int").alias(GROUP)
    keyed = blocked.select(group, *UNIT, BLOCK, F.unix_millis("ts").alias("ts_ms"), "cycle", F.col(OWN).alias("own"), *sensors)
    processor = BlockFeatures(UNIT, sensors, tuple(lags), tuple(windows), alpha, lead_in, size, idle_ms)
    schema = T.StructType(
        [
            T.StructField("subset", T.StringType()),
            T.StructField("unit_id", T.IntegerType()),
            T.StructField("cycle", T.IntegerType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("status", T.StringType()),
            T.StructField("missing_before", T.IntegerType()),
        ]
        + [T.StructField(name, T.DoubleType()) for name in [*sensors, *feature_names(sensors, lags, windows)]]
    )
    return keyed.groupBy(GROUP, *UNIT[:-1]).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="eventTime"
    )
