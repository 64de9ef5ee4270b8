"""Remaining-useful-life labels and the checks on them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.operators.endpoints import single_records
from fleetlife.operators.trajectory import block_window, own_rows, to_blocks, unit_last_cycle, with_unit_facts
from fleetlife.schema import TERMINAL_COLUMN, UNIT


def label_complete(df: DataFrame, keys=UNIT) -> DataFrame:
    """Label run-to-failure histories: cycles left until the last one."""
    last = unit_last_cycle(df, keys)
    labelled = with_unit_facts(df, last, keys)
    return labelled.select(*df.columns, (F.col("last_cycle") - F.col("cycle")).cast("int").alias("RUL"))


def label_truncated(df: DataFrame, terminal: DataFrame, keys=UNIT) -> DataFrame:
    """Label histories cut before failure: official terminal RUL plus cycles to the cut.

    A unit without an official record, or with several, is an error of the job.
    """
    facts = unit_last_cycle(df, keys).join(single_records(terminal, keys), list(keys), "left")
    unit = F.concat_ws(" ", *(F.col(k).cast("string") for k in keys))
    missing = F.raise_error(F.concat(F.lit("no official record for unit "), unit)).cast("int")
    facts = facts.withColumn(TERMINAL_COLUMN, F.when(F.col(TERMINAL_COLUMN).isNull(), missing).otherwise(F.col(TERMINAL_COLUMN)))
    labelled = with_unit_facts(df, facts, keys)
    rul = F.col(TERMINAL_COLUMN) + F.col("last_cycle") - F.col("cycle")
    return labelled.select(*df.columns, rul.cast("int").alias("RUL"))


def label_steps(df: DataFrame, keys=UNIT, contiguous=False) -> DataFrame:
    """Change of RUL from the previous row of the unit; null on the first row."""
    blocked = to_blocks(df, 1, keys, contiguous=contiguous)
    step = F.col("RUL") - F.lag("RUL", 1).over(block_window(keys))
    return own_rows(blocked.withColumn("rul_step", step))


def label_step_violations(df: DataFrame, keys=UNIT, contiguous=False) -> DataFrame:
    """Rows where RUL does not fall by exactly one."""
    return label_steps(df, keys, contiguous).where(F.col("rul_step") != -1)


def terminal_rows(df: DataFrame, keys=UNIT) -> DataFrame:
    """Terminal (cycle, RUL) of every unit: the maximum of a struct."""
    last = df.groupBy(*keys).agg(F.max(F.struct("cycle", "RUL")).alias("last"))
    return last.select(*keys, "last.cycle", "last.RUL")


def terminal_disagreements(labelled: DataFrame, terminal: DataFrame, keys=UNIT) -> DataFrame:
    """Units whose terminal label is missing on a side or differs from the official one."""
    ours = terminal_rows(labelled, keys).select(*keys, F.col("RUL").alias("labelled_rul"))
    both = ours.join(terminal.select(*keys, TERMINAL_COLUMN), list(keys), "full")
    return both.where(~F.col("labelled_rul").eqNullSafe(F.col(TERMINAL_COLUMN)))
