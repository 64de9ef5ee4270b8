"""Partitioned Parquet tables with committed runs, and CSV reports."""

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetlife.cluster import attach, settle
from fleetlife.operators.trajectory import BLOCK_ROWS, block_of

PARTITIONS = ("subset", "run_id", "split")
ATTEMPT = "attempt"
ROWS_PER_FILE = 5_000_000
COMMITS = "run_id string, attempt string, committed_at timestamp, subset string, split string, rows long"


def commits_folder(path: str) -> str:
    return f"{path.rstrip('/')}_commits"


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """Rows per subset and split of each committed attempt; a run may have been committed again."""
    return spark.read.schema(COMMITS).parquet(commits_folder(path))


def _commit(written: DataFrame, path: str, run_id: str, attempt: str) -> None:
    """The manifest of an attempt, as one file: readers see all of the attempt or nothing."""
    counts = written.groupBy("subset", "split").agg(F.count(F.lit(1)).alias("rows"))
    manifest = counts.select(F.lit(run_id).alias("run_id"), F.lit(attempt).alias(ATTEMPT), F.current_timestamp().alias("committed_at"), F.col("subset").cast("string"), F.col("split").cast("string"), "rows")
    manifest.coalesce(1).write.mode("append").parquet(commits_folder(path))


def _attempt(spark: SparkSession, path: str, run_id: str, attempt: str) -> DataFrame:
    """Rows of one attempt; only its folders are listed, so runs may differ in their columns."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/subset=*/run_id={run_id}/split=*/{ATTEMPT}={attempt}")
    return rows.withColumn("run_id", F.lit(run_id)).drop(ATTEMPT)


def write_processed(df: DataFrame, path: str, run_id: str, files: int | None = None) -> None:
    """Write the rows of a run under subset / run_id / split.

    Every call is an attempt with folders of its own, and its manifest is written last. What a broken
    attempt left behind is never read, and the run can simply be written again: the attempt
    committed last counts. Files are never replaced, so readers of an earlier attempt are not disturbed.
    A run without rows leaves nothing to commit.

    Rows are spread by partition, unit and block, so that a subset (or one unit) with
    most of the rows fills many files; ``files`` bounds how many per write.
    """
    spark, attempt = df.sparkSession, f"a{uuid.uuid4().hex}"
    # An empty manifest opens the table, so that it can be read while nothing is committed.
    spark.createDataFrame([], COMMITS).coalesce(1).write.mode("append").parquet(commits_folder(path))
    seen = Observation()
    rows = df.withColumn("run_id", F.lit(run_id)).withColumn(ATTEMPT, F.lit(attempt)).observe(seen, F.count(F.lit(1)).alias("rows"))
    spread = [*PARTITIONS, F.pmod(F.xxhash64("unit_id", block_of(F.col("cycle"), BLOCK_ROWS)), F.lit(files or 1))]
    arranged = rows.repartition(*spread) if files else rows
    arranged.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*PARTITIONS, ATTEMPT).parquet(path)
    if seen.get["rows"]:
        _commit(_attempt(spark, path, run_id, attempt), path, run_id, attempt)


def read_processed(spark: SparkSession, path: str, subset=None, run_id=None, split=None) -> DataFrame:
    """Rows of committed runs, each from its last committed attempt; the given values prune directories."""
    newest = read_commits(spark, path).groupBy("run_id").agg(F.max_by(ATTEMPT, F.struct("committed_at", ATTEMPT)).alias(ATTEMPT))
    found = newest.where(F.col("run_id") == run_id).first() if run_id is not None else None
    if found:
        rows = _attempt(spark, path, run_id, found[ATTEMPT])
    else:
        rows = spark.read.parquet(path)
        columns = [c for c in rows.columns if c != ATTEMPT]
        # Run ids come from the manifests: folder names of digits only would be read as numbers.
        rows = attach(rows.drop("run_id"), settle(newest), ATTEMPT).select(*columns)
    for name, value in (("subset", subset), ("run_id", run_id), ("split", split)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows


def write_report(df: DataFrame, path: str, mode="overwrite") -> None:
    """Report as CSV with a header; written in parallel."""
    df.write.mode(mode).option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
