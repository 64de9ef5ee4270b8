"""Row order inside trajectories, without one task per trajectory.

A trajectory may hold a third of the table, so nothing here windows over a whole
unit. Rows are numbered from per-slice counts, and ordered work runs on
fixed-size *blocks* of consecutive rows. Each block starts with copies of the
rows that precede it (its *lead-in*), as many as the widest frame needs.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from fleetlife.cluster import attach, estimated_bytes, settle
from fleetlife.schema import UNIT

BLOCK_ROWS = 2048
HEAVY_ROWS = 4_000_000

BLOCK = "__block"
OWN = "__own"
POSITION = "__pos"


def number_rows(df: DataFrame, group, slice_column: str, order, name: str) -> DataFrame:
    """1-based row number per group, from slice sizes plus the rank in a slice.

    ``slice_column`` must grow with ``order``. Only slices are sorted; the group
    itself is never gathered.
    """
    keys = [*group, slice_column]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*group).orderBy(slice_column).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    numbered = df.join(starts, keys).withColumn(name, (F.col("__start") + rank).cast("int"))
    return numbered.drop("__start", slice_column)


def epoch_second(df: DataFrame, ts: str):
    """Whole seconds on the time axis; zone-free timestamps stay zone-free."""
    if not isinstance(df.schema[ts].dataType, TimestampNTZType):
        return F.unix_seconds(F.col(ts))
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)).cast("long") * 86400 + clock


def number_by_time(df: DataFrame, group, ts: str, ties, name: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """1-based row number per group in time order.

    Groups above ``heavy_rows`` are looked up first (a combined count, at most
    ``rows / heavy_rows`` results) and cut into time slices; without any, one
    window does it. An input of fewer than two bytes per allowed row cannot hold a
    heavy group and is not searched.
    """
    group = list(group)
    in_time = F.row_number().over(Window.partitionBy(*group).orderBy(ts, *ties))
    if estimated_bytes(df) <= 2 * heavy_rows:
        return df.withColumn(name, in_time)
    second = epoch_second(df, ts)
    heavy = (
        df.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("__rows"), F.min(second).alias("__lo"), F.max(second).alias("__hi"))
        .where(F.col("__rows") > heavy_rows)
        .select(
            *group,
            "__lo",
            F.greatest(
                F.lit(1.0), (F.col("__hi") - F.col("__lo")) / F.ceil(4.0 * F.col("__rows") / heavy_rows)
            ).alias("__width"),
        )
    )
    if not heavy.take(1):
        return df.withColumn(name, in_time)
    sliced = attach(df, settle(heavy), group, "left").withColumn(
        "__slice", F.coalesce(F.floor((second - F.col("__lo")) / F.col("__width")), F.lit(0))
    )
    return number_rows(sliced.drop("__lo", "__width"), group, "__slice", [ts, *ties], name)


def with_position(df: DataFrame, keys=UNIT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Row position per trajectory for cycle axes that may have gaps.

    Cycles are distinct integers, so a slice of ``block_rows`` cycles has at most
    that many rows.
    """
    sliced = df.withColumn("__slice", F.floor(F.col("cycle") / F.lit(block_rows)))
    return number_rows(sliced, list(keys), "__slice", ["cycle"], POSITION)


def block_of(position, block_rows: int):
    return F.floor((position - F.lit(1)) / F.lit(block_rows)).cast("int")


def to_blocks(df: DataFrame, lead_in: int, keys=UNIT, block_rows: int = BLOCK_ROWS, contiguous=False) -> DataFrame:
    """Put each row in its block and copy the last ``lead_in`` rows to the next one.

    ``contiguous`` says that cycles run 1, 2, 3, ... (the validated case), which
    saves the numbering step.
    """
    block_rows = max(block_rows, 2 * lead_in)
    rows = df.withColumn(POSITION, F.col("cycle")) if contiguous else with_position(df, keys, block_rows)
    return placed_in_blocks(rows, lead_in, block_rows)


def placed_in_blocks(rows: DataFrame, lead_in: int, block_rows: int) -> DataFrame:
    """Blocks of rows that have their position; a block has at least ``lead_in`` rows."""
    home = block_of(F.col(POSITION), block_rows)
    if lead_in == 0:
        return rows.withColumn(BLOCK, home).withColumn(OWN, F.lit(True))
    near_end = F.pmod(F.col(POSITION) - 1, F.lit(block_rows)) >= block_rows - lead_in
    places = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return rows.withColumn(BLOCK, F.explode(places)).withColumn(OWN, F.col(BLOCK) == home)


def block_window(keys=UNIT):
    return Window.partitionBy(*keys, BLOCK).orderBy("cycle")


def own_rows(blocked: DataFrame) -> DataFrame:
    """Drop the lead-in copies and the helper columns."""
    return blocked.where(OWN).drop(BLOCK, OWN, POSITION)


def unit_last_cycle(df: DataFrame, keys=UNIT) -> DataFrame:
    """Last observed cycle per unit."""
    return df.groupBy(*keys).agg(F.max("cycle").alias("last_cycle"))


def with_unit_facts(df: DataFrame, facts: DataFrame, keys=UNIT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Join per-unit facts (holding ``last_cycle``) to the rows of the unit.

    The facts are repeated per block of cycles, and the join key includes the
    block: a long trajectory is spread over tasks, an ordinary one has one block.
    """
    last_block = F.greatest(F.lit(0), block_of(F.col("last_cycle"), block_rows))
    spread = facts.withColumn("__cut", F.explode(F.sequence(F.lit(0), last_block)))
    cut = F.greatest(F.lit(0), block_of(F.col("cycle"), block_rows))
    return df.withColumn("__cut", cut).join(spread, [*keys, "__cut"]).drop("__cut")


def last_rows(df: DataFrame, columns, keys=UNIT) -> DataFrame:
    """The row of each unit's last cycle: one hash aggregate, combined map-side."""
    picks = [F.max_by(name, "cycle").alias(name) for name in columns if name not in (*keys, "cycle")]
    return df.groupBy(*keys).agg(F.max("cycle").alias("cycle"), *picks)
