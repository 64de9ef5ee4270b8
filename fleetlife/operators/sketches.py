"""Stored latency sketches: one per small window and group, merged later for any range and
any coarser group without the log.

A sketch is the sorted list of (bucket, n) of a logarithmic histogram: bucket i holds the
latencies above g^(i-1) up to g^i, with g = (1 + accuracy) / (1 - accuracy), so that the value
reported for a bucket is within ``accuracy`` of all it holds, relative to them. Merging adds counts:
it is exact, in any order, and merged sketches give what one sketch of the whole would.
Latencies up to ``SMALLEST`` count as 0 and those from ``LARGEST`` on as that, which bounds
a sketch at some 1,400 buckets for an accuracy of 1%. Null and NaN latencies count in no bucket;
where there are no others the sketch is empty, with no requests and null quantiles.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Range of latencies told apart, in seconds.
SMALLEST = 1e-6
LARGEST = 1e6
ACCURACY = 0.01


def growth(accuracy: float) -> float:
    """Ratio of the bounds of a bucket."""
    if not 0 < accuracy < 1:
        raise ValueError("accuracy must lie between 0 and 1")
    return (1 + accuracy) / (1 - accuracy)


def zero_bucket(accuracy: float) -> int:
    """The bucket of latencies that count as 0: below all others."""
    return math.floor(math.log(SMALLEST) / math.log(growth(accuracy))) - 1


def bucket_of(latency, accuracy: float):
    index = F.ceil(F.log(F.least(latency, F.lit(LARGEST))) / F.lit(math.log(growth(accuracy)))).cast("int")
    return F.when(latency <= SMALLEST, F.lit(zero_bucket(accuracy))).when(latency.isNotNull() & ~F.isnan(latency), index)


def _packed(counts: DataFrame, by) -> DataFrame:
    buckets = F.sort_array(F.collect_list(F.when(F.col("bucket").isNotNull(), F.struct("bucket", "n"))))
    return counts.groupBy(*by).agg(buckets.alias("sketch"))


def latency_sketches(log: DataFrame, size="1 minute", by=("subset", "model_type"), accuracy=ACCURACY) -> DataFrame:
    """(window_start, window_end, by, sketch), for batch and for streams in append mode.

    Rows are counted per bucket first, which combines map-side, so a busy group costs its buckets.
    Rows without a latency are not filtered out: a filter would move ahead of a stream's
    watermark, which they still have to advance.
    """
    placed = log.withColumn("bucket", bucket_of(F.col("latency_s"), accuracy))
    counts = placed.groupBy(F.window("ts", size).alias("w"), *by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    return _packed(counts, ("w", *by)).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "sketch")


def merge_sketches(sketches: DataFrame, size: str | None = None, by=()) -> DataFrame:
    """Sketches of larger windows (of the whole range without ``size``) and coarser groups.

    ``size`` has to be a multiple of the stored windows. Without ``size`` the range is that of
    all windows that were given, whatever group they are of.
    """
    rows = sketches.select("window_start", "window_end", *by, F.explode_outer("sketch").alias("part"))
    if size is None:
        reach = sketches.agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end")).first()
        rows = rows.withColumns({c: F.lit(reach[c]).cast(sketches.schema[c].dataType) for c in ("window_start", "window_end")})
    else:
        rows = rows.withColumn("w", F.window("window_start", size)).withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")})
    keys = ("window_start", "window_end", *by)
    counts = rows.groupBy(*keys, F.col("part.bucket").alias("bucket")).agg(F.sum("part.n").alias("n"))
    return _packed(counts, keys)


def sketch_count(sketch):
    return F.aggregate(sketch, F.lit(0).cast("bigint"), lambda total, part: total + part["n"])


def sketch_quantile(sketch, quantile: float, accuracy=ACCURACY):
    """The latency at place floor(quantile * (n - 1)), from 0, within ``accuracy`` of it."""
    if not 0 <= quantile <= 1:
        raise ValueError("quantile must lie between 0 and 1")
    ratio, zero = growth(accuracy), zero_bucket(accuracy)
    place = F.floor(F.lit(quantile) * (sketch_count(sketch) - 1))
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("int").alias("hit"))

    def step(state, part):
        seen = state["seen"] + part["n"]
        return F.struct(seen.alias("seen"), F.when(state["hit"].isNull() & (seen > place), part["bucket"]).otherwise(state["hit"]).alias("hit"))

    hit = F.aggregate(sketch, start, step, lambda state: state["hit"])
    value = F.lit(2 / (ratio + 1)) * F.pow(F.lit(ratio), hit.cast("double"))
    return F.when(hit == zero, F.lit(0.0)).otherwise(value)


def quantiles(sketches: DataFrame, at=(0.5, 0.95, 0.99), accuracy=ACCURACY) -> DataFrame:
    """``requests`` and one column ``latency_p<percent>_s`` per quantile in place of the sketch."""
    rest = [c for c in sketches.columns if c != "sketch"]
    named = [sketch_quantile(F.col("sketch"), q, accuracy).alias(f"latency_p{100 * q:g}_s".replace(".", "_")) for q in at]
    return sketches.select(*rest, sketch_count(F.col("sketch")).alias("requests"), *named)
