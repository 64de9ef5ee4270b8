"""Prediction-traffic reports over event-time windows, for batch and streams.

The log has ts, subset, model_type, status, latency_s and predicted_rul. Every
aggregate is bounded per group (counters, bucket counts, sketches), so a group that
holds most of the traffic combines map-side.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Upper bounds of the latency histogram, in seconds; the last is infinite.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)

# Alert thresholds (share of errors, seconds, quantile).
ERROR_SHARE = 0.05
P95_SECONDS = 2.0
QUANTILE = 0.95


def _windowed(log: DataFrame, size: str, slide: str | None, by):
    span = F.window("ts", size, slide) if slide else F.window("ts", size)
    return log.groupBy(span.alias("w"), *by)


def _flat(df: DataFrame, by) -> DataFrame:
    rest = [name for name in df.columns if name not in ("w", *by)]
    return df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *rest)


def window_seconds(size: str) -> float:
    """Length of a window duration such as "5 minutes"."""
    count, unit = size.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return float(count) * scale[unit.rstrip("s")]


def request_rate(log: DataFrame, size="5 minutes", slide=None, by=("status",)) -> DataFrame:
    """Requests per window and per second."""
    counts = _flat(_windowed(log, size, slide, by).agg(F.count(F.lit(1)).alias("requests")), by)
    return counts.withColumn("per_second", F.col("requests") / F.lit(window_seconds(size)))


def request_totals(log: DataFrame, by=("status",)) -> DataFrame:
    return log.groupBy(*by).agg(F.count(F.lit(1)).alias("requests"))


def mean_latency(log: DataFrame, size="5 minutes", slide=None, by=("subset", "model_type")) -> DataFrame:
    return _flat(_windowed(log, size, slide, by).agg(F.avg("latency_s").alias("mean_latency_s")), by)


def error_rate(log: DataFrame, size="5 minutes", slide=None, by=()) -> DataFrame:
    """Percentage of failed requests per window."""
    failed = F.count_if(F.col("status") == "error")
    rate = (F.lit(100.0) * failed / F.count(F.lit(1))).alias("error_percent")
    return _flat(_windowed(log, size, slide, by).agg(F.count(F.lit(1)).alias("requests"), rate), by)


def latest_value(log: DataFrame, by=("subset", "model_type")) -> DataFrame:
    """Last predicted value per group; ties in time go to the larger value."""
    moment = F.struct("ts", "predicted_rul")
    served = log.where(F.col("status") == "success")
    newest = served.groupBy(*by).agg(F.max(moment).alias("newest"))
    return newest.select(*by, F.col("newest.ts").alias("ts"), F.col("newest.predicted_rul").alias("predicted_rul"))


def _bucket_counts():
    """Requests per histogram bucket, cumulative, as fixed-width counters."""
    bounds = [F.count_if(F.col("latency_s") <= bound) for bound in LATENCY_BOUNDS]
    return F.array(*bounds, F.count("latency_s")).alias("cumulative")


def quantile_of_buckets(cumulative, quantile=QUANTILE):
    """Linear interpolation inside the bucket the quantile falls into; past the last
    finite bound, that bound."""
    bounds = F.array(*(F.lit(bound) for bound in LATENCY_BOUNDS))
    last = len(LATENCY_BOUNDS)
    total = F.element_at(cumulative, last + 1)
    rank = F.lit(quantile) * total
    hit = F.array_position(F.transform(cumulative, lambda n: n >= rank), True).cast("int")
    low_bound = F.when(hit == 1, F.lit(0.0)).otherwise(F.get(bounds, hit - 2))
    low_count = F.when(hit == 1, F.lit(0)).otherwise(F.get(cumulative, hit - 2))
    inside = F.get(cumulative, hit - 1) - low_count
    within = low_bound + (F.get(bounds, hit - 1) - low_bound) * (rank - low_count) / F.nullif(inside, F.lit(0))
    return F.when(total == 0, F.lit(None)).when(hit > last, F.lit(LATENCY_BOUNDS[-1])).otherwise(within)


def latency_quantile(log: DataFrame, size="5 minutes", slide=None, by=("subset", "model_type"), quantile=QUANTILE) -> DataFrame:
    """Latency quantile per window, interpolated in histogram buckets."""
    counts = _flat(_windowed(log, size, slide, by).agg(_bucket_counts()), by)
    return counts.withColumn("latency_p95_s", quantile_of_buckets(F.col("cumulative"), quantile)).drop("cumulative")


def latency_sketch(log: DataFrame, size="5 minutes", slide=None, by=("subset", "model_type"), quantile=QUANTILE, accuracy=10_000) -> DataFrame:
    """Latency quantile per window from a mergeable sketch of bounded size."""
    sketch = F.percentile_approx("latency_s", quantile, accuracy).alias("latency_p95_s")
    return _flat(_windowed(log, size, slide, by).agg(sketch), by)


def held_alerts(windows: DataFrame, breach, hold_windows: int, step: str, by=()) -> DataFrame:
    """Windows at whose end the alert fires: ``breach`` held for ``hold_windows`` in a row.

    Works on window results (one row per window and group) that start ``step`` apart.
    A window without traffic has no row and counts as no breach, so consecutive means
    consecutive in time. Every breach counts for itself and the windows after it, so the
    windows of a group are never put in order in one task.
    """
    flagged = windows.withColumn("breach", F.coalesce(breach, F.lit(False)))
    own = F.struct(*(c for c in flagged.columns if c not in (*by, "window_start")))
    later = F.transform(F.sequence(F.lit(0), F.lit(hold_windows - 1)), lambda j: F.col("window_start") + F.expr(f"INTERVAL {step}") * j)
    votes = flagged.where("breach").select(*by, F.explode(later).alias("window_start"), F.lit(None).cast(flagged.select(own.alias("own")).schema["own"].dataType).alias("own"), F.lit(1).alias("vote"))
    rows = flagged.select(*by, "window_start", own.alias("own"), F.lit(0).alias("vote"))
    found = rows.unionByName(votes).groupBy(*by, "window_start").agg(F.first("own", ignorenulls=True).alias("own"), F.sum("vote").alias("votes"))
    kept = [F.col("own")[c].alias(c) for c in flagged.columns if c not in (*by, "window_start")]
    return found.where(F.col("own").isNotNull()).select(*by, "window_start", *kept, (F.col("votes") == hold_windows).alias("firing"))


def firing_spans(windows: DataFrame, breach, hold_windows: int, step: str, by=()) -> DataFrame:
    """Spans of ``hold_windows`` consecutive windows that all breach.

    ``windows`` keeps its window column ``w``. The second window aggregation runs on
    streams as well, in append mode.
    """
    count, unit = step.split()
    span = F.window(F.window_time("w"), f"{int(count) * hold_windows} {unit}", step)
    held = windows.groupBy(span.alias("held"), *by).agg(F.count_if(breach).alias("n_breaches"))
    return held.where(F.col("n_breaches") == hold_windows).select(
        F.col("held.start").alias("span_start"), F.col("held.end").alias("span_end"), *by
    )


def error_windows(log: DataFrame, size="5 minutes", slide=None, by=()) -> DataFrame:
    failed = F.count_if(F.col("status") == "error")
    return _windowed(log, size, slide, by).agg((F.lit(100.0) * failed / F.count(F.lit(1))).alias("error_percent"))


def latency_windows(log: DataFrame, size="5 minutes", slide=None, by=()) -> DataFrame:
    counts = _windowed(log, size, slide, by).agg(_bucket_counts())
    return counts.select("w", *by, quantile_of_buckets(F.col("cumulative")).alias("latency_p95_s"))


def error_alert(log: DataFrame, size="5 minutes", slide=None, hold_windows=2, share=ERROR_SHARE, by=()) -> DataFrame:
    """Error share above the threshold, held."""
    rates = error_rate(log, size, slide, by)
    return held_alerts(rates, F.col("error_percent") > 100 * share, hold_windows, slide or size, by)


def latency_alert(log: DataFrame, size="5 minutes", slide=None, hold_windows=2, seconds=P95_SECONDS, by=()) -> DataFrame:
    """p95 latency above the threshold, held."""
    quantiles = latency_quantile(log, size, slide, by)
    return held_alerts(quantiles, F.col("latency_p95_s") > seconds, hold_windows, slide or size, by)


def silences(log: DataFrame, timeout="1 minute", by=("subset",)) -> DataFrame:
    """Gaps longer than ``timeout`` between consecutive events of a source.

    Events are first reduced to the first and last per window of that length; a
    longer gap cannot lie inside one window, so none is lost, and the ordered pass
    sees at most one row per window and source.
    """
    spans = _windowed(log, timeout, None, by).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    order = Window.partitionBy(*by).orderBy("first_ts") if by else Window.orderBy("first_ts")
    following = spans.select(*by, F.col("last_ts").alias("silent_from"), F.lead("first_ts").over(order).alias("silent_until"))
    limit = F.expr(f"INTERVAL {timeout}")
    return following.where(F.col("silent_until") - F.col("silent_from") > limit)
