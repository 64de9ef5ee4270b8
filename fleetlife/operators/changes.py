"""Life cycles of alerts and silences as change rows: one row per change of state.

The batch forms; ``fleetlife.streaming.changes`` gives the same rows while events arrive.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def alert_changes(windows: DataFrame, breach, hold_windows: int, step: str, by=()) -> DataFrame:
    """(by, state, at) from window results: one row per window and group, ``step`` apart.

    ``pending`` at the end of the first breach of a run, ``firing`` at the end of the
    ``hold_windows``-th in a row, and one window after the last breach ``resolved``, or
    ``inactive`` if the alert never fired. A window without a row, or with a null breach,
    is no breach.

    Every breach tells the windows around it where it stands, and the changes follow from
    the counts, so the windows of a group are never put in order in one task.
    """
    if hold_windows < 1:
        raise ValueError("hold_windows must be at least 1")
    offsets = F.explode(F.sequence(F.lit(-1), F.lit(hold_windows)))
    told = windows.where(breach).select(*by, "window_end", offsets.alias("offset"))
    place = F.col("window_end") + F.expr(f"INTERVAL {step}") * F.col("offset")
    counted = told.select(*by, place.alias("at"), "offset").groupBy(*by, "at").agg(
        (F.count_if(F.col("offset") == 0) > 0).alias("own"),
        (F.count_if(F.col("offset") == 1) > 0).alias("before"),
        (F.count_if(F.col("offset").between(0, hold_windows - 1)) == hold_windows).alias("held"),
        (F.count_if(F.col("offset") >= 1) == hold_windows).alias("held_before"),
    )
    ended = F.col("before") & ~F.col("own")
    states = F.array_compact(
        F.array(
            F.when(F.col("own") & ~F.col("before"), "pending"),
            F.when(F.col("held") & ~F.col("held_before"), "firing"),
            F.when(ended, F.when(F.col("held_before"), "resolved").otherwise("inactive")),
        )
    )
    return counted.select(*by, F.explode(states).alias("state"), "at")


def silence_changes(log: DataFrame, timeout="1 minute", by=("subset",), expected: DataFrame | None = None) -> DataFrame:
    """(by, state, at, last_seen): ``silent`` when a source has sent nothing for longer than
    ``timeout``, ``back`` at its next event.

    ``expected`` (by, since) registers sources, one row each. A registered source is watched
    from that moment, so its time-out starts there at the earliest, and one that never comes
    is silent too, with a null ``last_seen``. Others are watched from their first event.

    Events are first reduced to the first and last per window of that length; a longer gap
    cannot lie inside one window, so the ordered pass sees few rows per source.
    """
    span = F.window("ts", timeout)
    spans = log.groupBy(span, *by).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    moments = spans.select(*by, "first", "last", F.lit(True).alias("came"))
    if expected is not None:
        since = F.col("since")
        moments = moments.unionByName(expected.select(*by, since.alias("first"), since.alias("last"), F.lit(False).alias("came")))
    source = Window.partitionBy(*by)
    order = source.orderBy("first", "came")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = moments.select(
        *by,
        F.greatest(F.max("last").over(before), F.max(F.when(~F.col("came"), F.col("last"))).over(source)).alias("reached"),
        F.max(F.when(F.col("came"), F.col("last"))).over(before).alias("last_seen"),
        F.lead("first").over(order).alias("next"),
    )
    due = F.col("reached") + F.expr(f"INTERVAL {timeout}")
    gaps = reach.where(F.col("next").isNull() | (F.col("next") > due))
    silent = F.struct(F.lit("silent").alias("state"), due.alias("at"))
    back = F.struct(F.lit("back").alias("state"), F.col("next").alias("at"))
    rows = F.array_compact(F.array(silent, F.when(F.col("next").isNotNull(), back)))
    return gaps.select(*by, "last_seen", F.explode(rows).alias("row")).select(*by, "row.state", "row.at", "last_seen")
