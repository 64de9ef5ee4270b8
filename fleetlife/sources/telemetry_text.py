"""Text scans: telemetry lines, terminal-RUL lines and the set of input files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlife.operators.trajectory import number_rows
from fleetlife.schema import MEASUREMENTS, SUBSETS, TERMINAL_COLUMN

# A file, or a folder of part files under the name of one.
SUBSET_IN_NAME = r"_([A-Za-z0-9]+)\.txt(?:/[^/]*)?$"


def _lines(spark: SparkSession, paths) -> DataFrame:
    raw = spark.read.text(paths)
    return raw.select(
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"),
        F.upper(F.regexp_extract(F.col("_metadata.file_path"), SUBSET_IN_NAME, 1)).alias("subset"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def parse_telemetry(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Telemetry rows and quarantined lines from (subset, line).

    Tokens are taken by position and cast to the 26 columns; tokens beyond them
    are ignored. Blank lines are no rows. A line with a missing or unreadable
    token goes to the second frame, with the token count.
    """
    clean = F.regexp_replace("line", r"^\s+|\s+$", "")
    tokens = lines.select("subset", "line", F.split(clean, r"\s+").alias("t")).where(F.element_at("t", 1) != "")
    # The readings are cast as one array, which keeps the generated code small.
    numbers = F.transform(F.slice("t", 3, len(MEASUREMENTS)), lambda token: token.try_cast("double"))
    parsed = tokens.select("subset", "line", "t", numbers.alias("x"))
    unit_id, cycle = (F.get("t", F.lit(i)).try_cast("int") for i in (0, 1))
    readable = (
        unit_id.isNotNull()
        & cycle.isNotNull()
        & (F.size("x") == len(MEASUREMENTS))
        & ~F.exists("x", lambda value: value.isNull())
    )
    readings = [F.get("x", F.lit(i)).alias(name) for i, name in enumerate(MEASUREMENTS)]
    rows = parsed.where(readable).select("subset", unit_id.alias("unit_id"), cycle.alias("cycle"), *readings)
    rejected = parsed.where(~readable).select("subset", "line", F.size("t").alias("tokens"))
    return rows, rejected


def scan_telemetry(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """Rows and quarantined lines of telemetry files; the subset is in the file name."""
    return parse_telemetry(_lines(spark, paths).select("subset", "line"))


def scan_terminal_rul(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """Terminal RUL per unit: the n-th non-blank line of a file belongs to unit n.

    Lines are numbered per file from the sizes of its splits, so large files are
    read in parallel. Returns (rows, rejected lines); a rejected line still
    counts as a position.
    """
    lines = _lines(spark, paths).where(F.length("line") > 0)
    placed = lines.withColumn("__order", F.monotonically_increasing_id())
    numbered = number_rows(placed, ["subset", "file"], "block_start", ["__order"], "unit_id")
    value = F.col("line").try_cast("int")
    valid = value.isNotNull() & (value >= 0) & ~F.col("line").rlike(r"\s")
    reason = (
        F.when(F.col("line").rlike(r"\s"), "more than one value")
        .when(value.isNull(), "not an integer")
        .otherwise("negative")
    )
    rows = numbered.where(valid).select("subset", "unit_id", value.alias(TERMINAL_COLUMN))
    rejected = numbered.where(~F.coalesce(valid, F.lit(False))).select("subset", "unit_id", "line", reason.alias("reason"))
    return rows, rejected


def normalise_subsets(subsets=None) -> list[str]:
    """Upper-case and check a subset selection; None or "ALL" means all of them."""
    if subsets is None or (isinstance(subsets, str) and subsets.upper() == "ALL"):
        return list(SUBSETS)
    wanted = [subsets.upper()] if isinstance(subsets, str) else [name.upper() for name in subsets]
    unknown = [name for name in wanted if name not in SUBSETS]
    if unknown:
        raise ValueError(f"unsupported subset: {', '.join(unknown)}")
    return wanted


def input_patterns(folder: str, subsets) -> dict[str, list[str]]:
    """The three input files of every subset, or folders of part files in their place."""
    return {
        "train": [f"{folder}/train_{name}.txt" for name in subsets],
        "test": [f"{folder}/test_{name}.txt" for name in subsets],
        "terminal": [f"{folder}/RUL_{name}.txt" for name in subsets],
    }


def missing_inputs(spark: SparkSession, folder: str, subsets) -> list[str]:
    """Expected input files that do not exist (file listing, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    absent = []
    for paths in input_patterns(folder, subsets).values():
        for path in paths:
            location = jvm.org.apache.hadoop.fs.Path(path)
            if not location.getFileSystem(conf).exists(location):
                absent.append(path)
    return absent
