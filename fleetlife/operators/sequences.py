"""Fixed-length and endpoint sequences as array columns."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.operators.trajectory import (
    BLOCK_ROWS,
    POSITION,
    block_of,
    block_window,
    own_rows,
    to_blocks,
    with_position,
)
from fleetlife.schema import SEQUENCE_LENGTH, UNIT


def _vector(features):
    return F.array(*(F.col(name) for name in features))


def sliding_sequences(df: DataFrame, features, length=SEQUENCE_LENGTH, keys=UNIT, contiguous=False, block_rows=BLOCK_ROWS) -> DataFrame:
    """One row per full window of ``length`` rows of a unit, with the target at its end.

    Units shorter than the window give none. The result is ``length`` times the
    input by definition, so consume it lazily.
    """
    blocked = to_blocks(df, length - 1, keys, block_rows, contiguous)
    steps = F.collect_list(_vector(features)).over(block_window(keys).rowsBetween(1 - length, 0))
    full = own_rows(blocked.withColumn("sequence", steps)).where(F.size("sequence") == length)
    return full.select(*keys, "cycle", "sequence", F.col("RUL").alias("target"))


def tails(df: DataFrame, endpoints: DataFrame, length: int, keys=UNIT, contiguous=False, block_rows=BLOCK_ROWS) -> DataFrame:
    """The last ``length`` rows of a unit up to each of its endpoints.

    ``endpoints`` holds the keys and ``end_cycle``. Each endpoint is sent to the one
    or two blocks its rows lie in, so a long unit is neither gathered nor
    multiplied by its endpoints. With ``contiguous``, endpoints are observed cycles.
    """
    keys = list(keys)
    block_rows = max(block_rows, length)
    if contiguous:
        rows = df.withColumn(POSITION, F.col("cycle"))
        ends = endpoints.select(*keys, "end_cycle", F.col("end_cycle").alias("__end"))
    else:
        rows = with_position(df, keys, block_rows)
        ends = last_position_upto(df, endpoints, keys, block_rows)
    placed = rows.withColumn("__cut", block_of(F.col(POSITION), block_rows))
    first = F.greatest(F.lit(0), block_of(F.col("__end") - (length - 1), block_rows))
    wanted = ends.withColumn("__cut", F.explode(F.sequence(first, block_of(F.col("__end"), block_rows))))
    near = (F.col(POSITION) <= F.col("__end")) & (F.col(POSITION) > F.col("__end") - length)
    return placed.join(wanted, [*keys, "__cut"]).where(near).drop("__cut", "__end", POSITION)


def last_position_upto(df: DataFrame, endpoints: DataFrame, keys, block_rows: int) -> DataFrame:
    """Position of the last row at or before ``end_cycle``, for cycle axes with gaps.

    Endpoints are merged into the rows, slice by slice, and a running count of rows
    is read off at each: no row is paired with an endpoint.
    """
    keys = list(keys)
    rows = df.select(*keys, "cycle", F.lit(1).alias("__row"))
    ends = endpoints.select(*keys, F.col("end_cycle").alias("cycle"), F.lit(0).alias("__row")).distinct()
    merged = rows.unionByName(ends).withColumn("__slice", F.floor(F.col("cycle") / F.lit(block_rows)))
    sizes = merged.groupBy(*keys, "__slice").agg(F.sum("__row").alias("__rows"))
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "__slice", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    running = Window.partitionBy(*keys, "__slice").orderBy("cycle", F.col("__row").desc())
    counted = merged.withColumn("__seen", F.sum("__row").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    found = counted.where("__row = 0").join(starts, [*keys, "__slice"])
    end = (F.col("__start") + F.col("__seen")).cast("int")
    return found.select(*keys, F.col("cycle").alias("end_cycle"), end.alias("__end")).where("__end > 0")


def endpoint_sequences(df: DataFrame, endpoints: DataFrame, features, length=SEQUENCE_LENGTH, keys=UNIT, contiguous=False, block_rows=BLOCK_ROWS) -> DataFrame:
    """Up to ``length`` rows ending at each endpoint, ascending, no padding."""
    rows = tails(df, endpoints, length, keys, contiguous, block_rows)
    step = F.struct(F.col("cycle"), _vector(features).alias("x"))
    # At most ``length`` steps per group.
    grouped = rows.groupBy(*keys, "end_cycle").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    return grouped.select(*keys, F.col("end_cycle").alias("cycle"), F.col("steps.x").alias("sequence"))


def sequence_steps(sequences: DataFrame, features, keys=UNIT) -> DataFrame:
    """Sequences as rows: one per step, one column per feature."""
    others = [name for name in sequences.columns if name != "sequence"]
    steps = sequences.select(*others, F.posexplode("sequence").alias("step", "x"))
    return steps.select(*others, "step", *(F.get("x", F.lit(i)).alias(name) for i, name in enumerate(features)))
