"""Life cycles of alerts and silences on streams: keyed state with event-time timers.

A group's state is one small row. Events reach it as window results, so a group that sends
most of the events costs its windows only. Changes appear once the watermark has passed
them, an ending or a silence also if nothing follows, and equal those of
``fleetlife.operators.changes``. Both need the RocksDB state store.
"""

from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import fleetlife
from fleetlife.operators import monitoring

# The processors travel with their code, so executors need no installed package.
cloudpickle.register_pickle_by_value(fleetlife)

ALL = "__all"


def _table(key, made, names):
    import pandas as pd

    return pd.DataFrame([[*key, *row] for row in made], columns=names)


class AlertLife(StatefulProcessor):
    """Run of breaching windows of one group: its last window end and its length up to the hold."""

    def __init__(self, names, hold_windows, step_ms):
        self.names, self.hold, self.step_ms = list(names), hold_windows, step_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", T.StructType([T.StructField("last_ms", T.LongType()), T.StructField("length", T.IntegerType())]))

    def _ending(self, last, length):
        return ("resolved" if length == self.hold else "inactive", last + self.step_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        windows = sorted((int(end), bool(breach)) for batch in rows for end, breach in zip(batch["end_ms"], batch["breach"]))
        known = self.run.get() if self.run.exists() else None
        last, length = known or (None, 0)
        made = []
        for end, breach in windows:
            if length and (not breach or end > last + self.step_ms):
                made.append(self._ending(last, length))
                length = 0
            if breach:
                last = end
                if length == 0:
                    made.append(("pending", end))
                if length < self.hold:
                    length += 1
                    if length == self.hold:
                        made.append(("firing", end))
        if known:
            self.handle.deleteTimer(known[0] + self.step_ms)
        if length:
            self.run.update((last, length))
            self.handle.registerTimer(last + self.step_ms)
        else:
            self.run.clear()
        if made:
            yield _table(key, made, self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        if self.run.exists():
            last, length = self.run.get()
            if last + self.step_ms <= expiredTimerInfo.getExpiryTimeInMs():
                self.run.clear()
                yield _table(key, [self._ending(last, length)], self.names)

    def close(self) -> None:
        pass


def alert_changes(windows: DataFrame, breach, hold_windows: int, step: str, by=()) -> DataFrame:
    """(by, state, at) from a stream of window results, which keep their column ``w``."""
    if hold_windows < 1:
        raise ValueError("hold_windows must be at least 1")
    keys = list(by) or [ALL]
    keyed = windows if by else windows.withColumn(ALL, F.lit(0))
    rows = keyed.select(*keys, F.window_time("w").alias("moment"), F.unix_millis("w.end").alias("end_ms"), F.coalesce(breach, F.lit(False)).alias("breach"))
    schema = T.StructType([*(T.StructField(k, rows.schema[k].dataType) for k in keys), T.StructField("state", T.StringType()), T.StructField("at_ms", T.LongType())])
    processor = AlertLife(schema.names, hold_windows, round(1000 * monitoring.window_seconds(step)))
    made = rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="eventTime"
    )
    return made.select(*by, "state", F.timestamp_millis("at_ms").alias("at"))


def error_alert_changes(log: DataFrame, size="5 minutes", slide=None, hold_windows=2, share=monitoring.ERROR_SHARE, by=()) -> DataFrame:
    windows = monitoring.error_windows(log, size, slide, by)
    return alert_changes(windows, F.col("error_percent") > 100 * share, hold_windows, slide or size, by)


def latency_alert_changes(log: DataFrame, size="5 minutes", slide=None, hold_windows=2, seconds=monitoring.P95_SECONDS, by=()) -> DataFrame:
    windows = monitoring.latency_windows(log, size, slide, by)
    return alert_changes(windows, F.col("latency_p95_s") > seconds, hold_windows, slide or size, by)


class SilenceWatch(StatefulProcessor):
    """One source: the moment its time-out runs from, its last event, and whether it is silent."""

    def __init__(self, names, timeout_us, grain_us):
        self.names, self.timeout, self.grain = list(names), timeout_us, grain_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = [T.StructField("reached", T.LongType()), T.StructField("last_seen", T.LongType()), T.StructField("silent", T.BooleanType())]
        self.handle = handle
        self.source = handle.getValueState("source", T.StructType(fields))

    def _due_ms(self, reached) -> int:
        """End of the window in which the time-out runs out: by then all events before are known."""
        return ((reached + self.timeout) // self.grain + 1) * self.grain // 1000

    def handleInitialState(self, key, initialState, timerValues) -> None:
        since = int(initialState["since_us"].iloc[0])
        self.source.update((since, None, False))
        self.handle.registerTimer(self._due_ms(since))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        spans = sorted((int(a), int(b)) for batch in rows for a, b in zip(batch["first_us"], batch["last_us"]))
        known = self.source.get() if self.source.exists() else None
        reached, seen, silent = known or (None, None, False)
        made = []
        for first, last in spans:
            if reached is not None and first > reached + self.timeout:
                if not silent:
                    made.append(("silent", reached + self.timeout, seen))
                made.append(("back", first, seen))
                silent = False
            reached = last if reached is None else max(reached, last)
            seen = last if seen is None else max(seen, last)
        if known and not known[2]:
            self.handle.deleteTimer(self._due_ms(known[0]))
        self.source.update((reached, seen, silent))
        if not silent:
            self.handle.registerTimer(self._due_ms(reached))
        if made:
            yield _table(key, made, self.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        if self.source.exists():
            reached, seen, silent = self.source.get()
            if not silent and self._due_ms(reached) <= expiredTimerInfo.getExpiryTimeInMs():
                self.source.update((reached, seen, True))
                yield _table(key, [("silent", reached + self.timeout, seen)], self.names)

    def close(self) -> None:
        pass


def silence_changes(log: DataFrame, timeout="1 minute", by=("subset",), expected: DataFrame | None = None, grain: str | None = None) -> DataFrame:
    """(by, state, at, last_seen) as in batch, from a log with a watermark on ``ts``.

    A source is reported while it is still silent: at the latest one ``grain`` (the time-out
    itself if not given; any duration up to it) after its time-out in event time. ``expected``
    (by, since) is a table, one row per source, taken up when the stream first starts. A
    source is remembered for good, since only so can its next event end its silence.
    """
    grain = grain or timeout
    timeout_us, grain_us = (round(1e6 * monitoring.window_seconds(d)) for d in (timeout, grain))
    if grain_us > timeout_us:
        raise ValueError("grain must not be longer than timeout")
    spans = log.groupBy(F.window("ts", grain).alias("w"), *by).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    rows = spans.select(*by, F.window_time("w").alias("moment"), F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"))
    keys = [T.StructField(k, rows.schema[k].dataType) for k in by]
    schema = T.StructType([*keys, T.StructField("state", T.StringType()), T.StructField("at_us", T.LongType()), T.StructField("seen_us", T.LongType())])
    registered = None
    if expected is not None:
        since = F.unix_micros(F.col("since").cast("timestamp")).alias("since_us")
        registered = expected.select(*by, since).groupBy(*by)
    made = rows.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=SilenceWatch(schema.names, timeout_us, grain_us), outputStructType=schema, outputMode="append", timeMode="eventTime", initialState=registered
    )
    return made.select(*by, "state", F.timestamp_micros("at_us").alias("at"), F.timestamp_micros("seen_us").alias("last_seen"))
