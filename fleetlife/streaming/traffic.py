"""Prediction-traffic reports on streams.

The reports are the batch ones: windowed aggregates with a watermark. Only what
differs on a stream is here.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.operators import monitoring
from fleetlife.sources import events


def replay_events(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of event files as a stream, oldest file first."""
    reader = spark.readStream.schema(events.EVENTS).option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("pathGlobFilter", "events*.parquet").parquet(folder)


def traffic_stream(stream: DataFrame, delay="10 minutes") -> DataFrame:
    """Prediction log with event time and a watermark; older rows are dropped."""
    log = events.prediction_log(stream)
    return log.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def error_alerts(log: DataFrame, size="5 minutes", slide=None, hold_windows=2, share=monitoring.ERROR_SHARE, by=()) -> DataFrame:
    """Spans in which the error share stayed above the threshold."""
    windows = monitoring.error_windows(log, size, slide, by)
    return monitoring.firing_spans(windows, F.col("error_percent") > 100 * share, hold_windows, slide or size, by)


def latency_alerts(log: DataFrame, size="5 minutes", slide=None, hold_windows=2, seconds=monitoring.P95_SECONDS, by=()) -> DataFrame:
    """Spans in which p95 latency stayed above the threshold."""
    windows = monitoring.latency_windows(log, size, slide, by)
    return monitoring.firing_spans(windows, F.col("latency_p95_s") > seconds, hold_windows, slide or size, by)


def silence_starts(log: DataFrame, timeout="1 minute", by=("subset",)) -> DataFrame:
    """Sources that went silent for ``timeout``: every closed session, with its last event."""
    sessions = log.groupBy(F.session_window("ts", timeout).alias("s"), *by).agg(
        F.max("ts").alias("silent_from"), F.count(F.lit(1)).alias("requests")
    )
    return sessions.select(*by, "silent_from", "requests")


def write_rows(stream: DataFrame, path: str, checkpoint: str, available_now=True):
    """Append finished rows to Parquet."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_totals(stream: DataFrame, path: str, checkpoint: str, available_now=True):
    """Keep running totals: every trigger replaces the table with the current ones.

    Each trigger writes its own folder, so a retried trigger is idempotent.
    """

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/trigger={batch_id}")

    writer = stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(store)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals of the latest trigger."""
    stored = spark.read.parquet(path)
    newest = stored.agg(F.max("trigger")).first()[0]
    return stored.where(F.col("trigger") == newest).drop("trigger")


def write_late(stream: DataFrame, path: str, checkpoint: str, delay="10 minutes", available_now=True):
    """Quarantine: rows that a watermark of ``delay`` on ``ts`` lets reports leave out.

    As on a stream with that watermark, a row is late if it is older than the latest time of
    all earlier triggers less the delay. Each trigger has its own folders, so a retried one
    is idempotent; what is kept between triggers is one time per trigger.
    """

    def store(batch, batch_id):
        spark = batch.sparkSession
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{path}/seen/trigger={batch_id}")
        earlier = spark.read.schema("latest timestamp, trigger long").parquet(f"{path}/seen").where(F.col("trigger") < batch_id)
        bound = earlier.agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("bound"))
        late = batch.join(F.broadcast(bound), F.col("ts") < F.col("bound")).drop("bound")
        late.write.mode("overwrite").parquet(f"{path}/late/trigger={batch_id}")

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The quarantined rows of all triggers."""
    return spark.read.parquet(f"{path}/late").drop("trigger")
