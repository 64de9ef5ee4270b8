"""Durable state tables and size-checked joins.

Learned state (regimes, scaling statistics, split thresholds) is small but is
computed from everything, so it is computed once and then joined by broadcast,
provided its size stays under a bound. Past the bound it lives in the checkpoint
folder and the same join runs as a salted shuffle join.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTLED_ROWS = 20_000
BROADCAST_BYTES = 64 << 20
SALTS = 64


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; below the warehouse, shared as well, where it is unset."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write a table under the checkpoint folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Upper estimate of the planner: file sizes, or the exact size of local rows."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def settle(df: DataFrame, rows: int = SETTLED_ROWS) -> DataFrame:
    """Compute a small table once.

    Up to ``rows`` rows are held as local rows, whose size the planner knows exactly;
    what is larger is a file in the checkpoint folder. Either way later jobs do
    not depend on the executors that computed it.
    """
    held = df.limit(rows + 1).toArrow()
    if held.num_rows <= rows:
        return df.sparkSession.createDataFrame(held, df.schema)
    return stored(df)


def attach(df: DataFrame, table: DataFrame, on, how="inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a settled table to a large frame without moving the large frame.

    ``table`` is broadcast when its known size is at most ``max_bytes``. Otherwise
    every row of it is repeated per salt and the large side picks its salt from its
    own content, so that a key that holds most rows is still spread over tasks.
    """
    on = [on] if isinstance(on, str) else list(on)
    if estimated_bytes(table) <= max_bytes:
        return df.join(F.broadcast(table), on, how)
    picked = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int")
    repeated = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("__salt", picked).join(repeated, [*on, "__salt"], how).drop("__salt")
