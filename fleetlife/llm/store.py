"""Intermediate tables in the folder all executors share."""

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; below the warehouse where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of rows that go to Python in one Arrow batch, where whole texts do.
BATCH = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """Jobs run inside hand rows to Python in batches of about BATCH bytes, however long the texts are.

    By rows alone a batch holds 10,000 texts, twice over in the buffers of each task, outside
    the heap. What is returned from here must have run: the setting goes back at the end.
    """
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, BATCH)
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
