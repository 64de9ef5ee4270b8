"""Corrections of live features: a late row releases the rows within its reach again.

What the feature stream emits is kept per trigger, late rows included. A correction pass is a
batch job over the units that have late rows: it computes their features with the late rows in
place, by the operator that batch uses, and writes those rows anew that a late row reaches. Readers take the last version
of each row. A pass counts once its manifest is written; one that broke off is never read and
its folder is overwritten by the next.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlife.cluster import attach, settle, stored
from fleetlife.operators import temporal
from fleetlife.operators.trajectory import BLOCK, BLOCK_ROWS, OWN, POSITION, block_window, own_rows, placed_in_blocks
from fleetlife.schema import EWMA_ALPHA, LAGS, ROLLING_WINDOWS, UNIT

PASSES = "pass int, up_to long"


def write_released(features: DataFrame, path: str, checkpoint: str, available_now=True):
    """Keep the rows of a feature stream, late ones included. A retried trigger overwrites its own folder."""

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/released/trigger={batch_id}")

    writer = features.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _released(spark: SparkSession, path: str, schema) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{fields}, trigger long").parquet(f"{path}/released")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def finished_passes(spark: SparkSession, path: str) -> DataFrame:
    """(pass, up_to): finished passes and the last trigger that each has seen."""
    if not _exists(spark, f"{path}/passes"):
        return spark.createDataFrame([], PASSES)
    return spark.read.schema(PASSES).parquet(f"{path}/passes")


def reach(lags=LAGS, windows=ROLLING_WINDOWS, alpha=EWMA_ALPHA) -> int:
    """Rows from a late row on, itself included, whose features it changes."""
    return 1 + max([1, *lags, *windows, temporal.ewma_memory(alpha)])


def corrected_rows(rows: DataFrame, sensors, up_to: int, lags=LAGS, windows=ROLLING_WINDOWS, alpha=EWMA_ALPHA) -> DataFrame:
    """Rows to release again, from all kept rows: those reached by a late row that came after
    trigger ``up_to``, and those that came after it and are reached by any late row.

    Late is also what a block whose state was freed took for its first rows: then the cycles that a row
    says are missing before it (or those its follower says) are not the ones that are missing. Of several
    rows of one unit and cycle the first one released holds; a late one only where none was.
    """
    sensors, width = list(sensors), reach(lags, windows, alpha)
    late = F.col("status") == "late"
    units = stored(units_to_correct(rows, up_to))
    names = temporal.feature_names(sensors, lags, windows)
    if units.isEmpty():
        nothing = rows.select(*UNIT, "cycle", "ts_ms", "status", "missing_before", *sensors).limit(0)
        return nothing.select("*", *(F.lit(None).cast("double").alias(name) for name in names))
    single = _first_released(attach(rows, units, list(UNIT), "left_semi"), sensors)

    # What a row is reached by, and its features, come from the same blocks: they are shuffled and sorted once.
    beside = temporal.smooths_beside(alpha, width)
    size = temporal.ewma_block_rows(alpha, width) if beside else max(BLOCK_ROWS, 2 * width)
    blocked = placed_in_blocks(single, width, size)
    keys = [*reversed(UNIT)]  # numbers first: they tell most rows apart when rows are sorted
    w = block_window(keys)
    # The first row of a block has no row before it here, and is out of reach of the block's own rows unless it is the unit's first.
    before = blocked.withColumns({"__before": F.lag("cycle").over(w), "__since": F.greatest("trigger", F.lag("trigger").over(w)), "__rank": F.row_number().over(w)})
    placed = before.withColumn("__skipped", F.col("cycle") - F.coalesce("__before", F.lit(0)) - 1)
    fresh, wrong = F.col("trigger") > up_to, F.coalesce(F.col("missing_before") != F.col("__skipped"), F.lit(False))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    last_any = F.max(F.when(late | wrong, F.col("__rank"))).over(upto)
    last_new = F.max(F.when((late & fresh) | (wrong & (F.col("__since") > up_to)), F.col("__rank"))).over(upto)
    near = placed.withColumns({"__any": F.col("__rank") - last_any < width, "__new": F.col("__rank") - last_new < width})
    touched = F.coalesce(F.col("__new"), F.lit(False)) | (fresh & F.coalesce(F.col("__any"), F.lit(False)))
    kept = near.select(*UNIT, "cycle", "ts_ms", touched.alias("__touched"), F.col("__skipped").alias("missing_before"), *sensors, BLOCK, OWN, POSITION)
    if beside and _all_finite(single, sensors):
        made = temporal.complete_features(kept, sensors, lags, windows, alpha, keys)
    else:
        made = temporal.temporal_features(stored(own_rows(kept)), sensors, lags, windows, alpha)
    return made.where("__touched").select(*UNIT, "cycle", "ts_ms", F.lit("ok").alias("status"), "missing_before", *sensors, *names)


def units_to_correct(rows: DataFrame, up_to: int) -> DataFrame:
    """Units with rows that came after trigger ``up_to``, and either late rows or rows that do not follow the row they say.

    A row in time says which cycle it follows. All rows of a unit are right about it just if the cycles that they follow are the first one's
    0 and all cycles but the last. Both sides are compared as sums of two hashes, 96 bits together, so that no unit is sorted
    for it. Units without new rows are as the last pass left them.
    """
    in_time, cycle = F.col("status") == "ok", F.col("cycle").cast("long")

    def hashed(value, seed):
        return F.shiftright(F.xxhash64(value, F.lit(seed)), 16)

    def differ(seed):
        follows = F.try_sum(F.when(in_time, hashed(cycle, seed) - hashed(cycle - 1 - F.col("missing_before"), seed)))
        return ~F.coalesce(follows + hashed(F.lit(0).cast("long"), seed) == hashed(F.max(cycle), seed), F.lit(False))

    marks = [F.max(F.col("trigger") > up_to).alias("new"), (F.max(~in_time) | differ(0) | differ(1)).alias("any")]
    return rows.groupBy(*UNIT).agg(*marks).where("new AND any").select(*UNIT)


def _first_released(rows: DataFrame, sensors) -> DataFrame:
    """Of rows of one unit and cycle the one that holds, with its position in the unit."""
    late = F.col("status") == "late"
    sliced = rows.withColumn("__slice", F.floor(F.col("cycle") / F.lit(BLOCK_ROWS)))
    keys = [*reversed(UNIT), "__slice"]
    w = Window.partitionBy(*keys).orderBy("cycle", late, "trigger", "ts_ms", *sensors)
    first = F.coalesce(F.lag("cycle").over(w) != F.col("cycle"), F.lit(True))
    columns = [*UNIT, "cycle", "trigger", "status", "ts_ms", "missing_before", *sensors, "__slice"]
    marked = sliced.select(*columns, first.alias("__first")).where("__first")
    single = stored(marked.select(*columns, F.row_number().over(Window.partitionBy(*keys).orderBy("cycle")).alias("__nth")))
    sizes = single.groupBy(*UNIT, "__slice").agg(F.max("__nth").alias("__rows"))
    earlier = Window.partitionBy(*UNIT).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    # Units within one slice, the usual case, need no start.
    starts = settle(sizes.select(*UNIT, "__slice", F.sum("__rows").over(earlier).alias("__start")).where("__start > 0"))
    numbered = attach(single, starts, [*UNIT, "__slice"], "left")
    return numbered.withColumn(POSITION, (F.coalesce("__start", F.lit(0)) + F.col("__nth")).cast("int")).drop("__start", "__nth", "__slice")


def _all_finite(rows: DataFrame, sensors) -> bool:
    odd = [F.col(s).isNull() | F.isnan(s) | (F.abs(F.col(s)) == float("inf")) for s in sensors]
    return rows.where(reduce(or_, odd, F.lit(False))).isEmpty()


def correct(spark: SparkSession, path: str, schema, sensors, lags=LAGS, windows=ROLLING_WINDOWS, alpha=EWMA_ALPHA) -> int:
    """One pass over everything kept so far; returns its number, or 0 if no trigger is new.

    Run it between triggers or beside the stream, one pass at a time. Rows of units without
    gaps or late rows, or without rows since the last pass, are only read; the others are computed in blocks, however long the unit.
    """
    known = finished_passes(spark, path).agg(F.coalesce(F.max("pass"), F.lit(0)), F.coalesce(F.max("up_to"), F.lit(-1).cast("long"))).first()
    rows = _released(spark, path, schema)
    newest = rows.agg(F.max("trigger")).first()[0]
    if newest is None or newest <= known[1]:
        return 0
    number = known[0] + 1
    seen = rows.where(F.col("trigger") <= newest)
    made = corrected_rows(seen, sensors, known[1], lags, windows, alpha)
    made.write.mode("overwrite").parquet(f"{path}/corrected/pass={number}")
    spark.createDataFrame([(number, newest)], PASSES).coalesce(1).write.mode("append").parquet(f"{path}/passes")
    return number


def read_current(spark: SparkSession, path: str, schema) -> DataFrame:
    """The last version of every row with its ``version``: 0 as first released, else the pass
    that released it again. Late rows that no pass has taken up are left out."""
    names = [f.name for f in schema]
    firsts = _released(spark, path, schema).where("status = 'ok'").select(*names, F.lit(0).alias("version"), "trigger")
    versions = firsts
    passes = [row["pass"] for row in finished_passes(spark, path).collect()]
    if passes:
        folders = [f"{path}/corrected/pass={n}" for n in passes]
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        again = spark.read.option("basePath", f"{path}/corrected").schema(f"{fields}, pass int").parquet(*folders)
        versions = firsts.unionByName(again.select(*names, F.col("pass").alias("version"), F.lit(-1).cast("long").alias("trigger")))
    # One sort after the shuffle, and none before it as an aggregate of such rows would have.
    w = Window.partitionBy(*reversed(UNIT), "cycle").orderBy(F.desc("version"), "trigger")
    return versions.withColumn("__later", F.lag(F.lit(True)).over(w)).where("__later IS NULL").select(*names, "version")
