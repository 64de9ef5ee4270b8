"""Quarantine of rows that come too late for the reports."""

import time

from pyspark.sql import functions as F

from fleetlife.streaming import traffic


def test_rows_behind_the_watermark_are_kept_aside(spark, tmp_path):
    start = spark.createDataFrame([(0,)], "k int").select(F.timestamp_seconds(F.lit(1_700_000_000)).alias("t")).first()["t"]
    triggers = [[0, 3_000], [2_500, 2_000, 9_000], [8_500, 100, 9_500]]
    source = tmp_path / "in"
    for i, seconds in enumerate(triggers):
        rows = spark.createDataFrame([(i, s) for s in seconds], "i int, s int")
        stamped = rows.select("i", "s", (F.lit(start) + F.make_dt_interval(secs=F.col("s"))).alias("ts"))
        stamped.coalesce(1).write.mode("append").parquet(str(source))
        time.sleep(1.1)  # files are taken by time of change
    stream = spark.readStream.schema("i int, s int, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(source))
    traffic.write_late(stream, str(tmp_path / "out"), str(tmp_path / "check"), "15 minutes").awaitTermination()
    late = {(r["i"], r["s"]) for r in traffic.read_late(spark, str(tmp_path / "out")).collect()}
    assert late == {(1, 2_000), (2, 100)}
