"""Error reports on predictions.

Predictions carry the keys, ``RUL`` (true) and ``prediction``; any further columns
(model, run, seed) can be grouped by.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.cluster import stored
from fleetlife.functions.expressions import regression_metrics, score_contribution

TOP = 3


def with_errors(predictions: DataFrame) -> DataFrame:
    error = F.col("prediction") - F.col("RUL")
    return predictions.withColumn("error", error).withColumn("score_contribution", score_contribution(F.col("error")))


def row_metrics(predictions: DataFrame, by=("subset",)) -> DataFrame:
    """rmse, mae, summed score, bias and late rate per group: one combined aggregate."""
    return with_errors(predictions).groupBy(*by).agg(*regression_metrics(F.col("error")))


def diagnostics(predictions: DataFrame, extra=()) -> DataFrame:
    """Per-endpoint error and score contribution, in the reporting layout."""
    return with_errors(predictions).select(
        *extra,
        "subset",
        "unit_id",
        F.col("cycle").alias("cutoff_cycle"),
        F.col("RUL").alias("true_RUL"),
        "prediction",
        "error",
        "score_contribution",
    )


def worst_first(report: DataFrame, n: int | None = None) -> DataFrame:
    """Diagnostics by falling contribution; with ``n``, a top-n without a full sort."""
    ordered = report.orderBy(F.col("score_contribution").desc(), "subset", "unit_id", "cutoff_cycle")
    return ordered if n is None else ordered.limit(n)


def _worst(predictions_with_errors: DataFrame, by) -> DataFrame:
    """Sum of the TOP largest contributions per group; the rank filter keeps as many
    rows per task and group before anything moves."""
    errors = predictions_with_errors.select(*by, "score_contribution")
    order = Window.partitionBy(*by).orderBy(F.col("score_contribution").desc())
    top = errors.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TOP)
    return top.groupBy(*by).agg(F.sum("score_contribution").alias(f"top_{TOP}_score_contribution"))


def _extremes() -> list:
    return [
        F.greatest(F.lit(0.0), F.max("error")).alias("worst_positive_error"),
        F.least(F.lit(0.0), F.min("error")).alias("worst_negative_error"),
        F.max("score_contribution").alias("largest_score_contribution"),
    ]


def _errors_once(predictions: DataFrame, by) -> DataFrame:
    """Group, error and contribution only, computed once for the two reads that tails need."""
    return stored(with_errors(predictions).select(*by, "error", "score_contribution"))


def tail_metrics(predictions: DataFrame, by=("subset",)) -> DataFrame:
    """Worst late and early error (clamped at 0), largest contribution, sum of the TOP largest."""
    errors = _errors_once(predictions, by)
    return errors.groupBy(*by).agg(*_extremes()).join(_worst(errors, by), list(by))


def all_metrics(predictions: DataFrame, by=("subset",)) -> DataFrame:
    """Row and tail metrics together."""
    errors = _errors_once(predictions, by)
    main = errors.groupBy(*by).agg(*regression_metrics(F.col("error")), *_extremes())
    return main.join(_worst(errors, by), list(by))


def robustness_summary(by_seed: DataFrame, by=("subset", "candidate", "role")) -> DataFrame:
    """Mean and median of the metrics over seeds, and the worst seed, per candidate."""
    measures = []
    for name in ("mae", "rmse", "rul_score"):
        measures += [F.avg(name).alias(f"mean_{name}"), F.median(name).alias(f"median_{name}")]
    return by_seed.groupBy(*by).agg(
        *measures,
        F.max("rul_score").alias("worst_seed_rul_score"),
        F.max("worst_positive_error").alias("worst_positive_error"),
    )


def head_to_head(by_seed: DataFrame) -> DataFrame:
    """Champion and competitor score side by side per subset and seed."""

    def scores(role):
        return by_seed.where(F.col("role") == role).select("subset", "seed", F.col("rul_score").alias(f"{role}_rul_score"))

    return scores("champion").join(scores("competitor"), ["subset", "seed"])


def win_rates(by_seed: DataFrame) -> DataFrame:
    """Share of seeds in which the champion's score is strictly lower."""
    win = F.col("champion_rul_score") < F.col("competitor_rul_score")
    return head_to_head(by_seed).groupBy("subset").agg(F.avg(win.cast("int")).alias("champion_win_rate"))


def robustness_report(by_seed: DataFrame, by=("subset", "candidate", "role"), digits=3) -> DataFrame:
    report = robustness_summary(by_seed, by).join(win_rates(by_seed), "subset", "left")
    return round_columns(report, digits)


def round_columns(df: DataFrame, digits=3) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if f.dataType.typeName() == "double"}
    return df.select(*(F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns))


def comparison_sheet(results: DataFrame, by=("subset", "model", "feature_set"), digits=3) -> DataFrame:
    """All metrics of ``all_metrics`` per (subset, model, feature set), rounded for reading."""
    measures = [f.name for f in results.schema.fields if f.name not in by and f.dataType.typeName() == "double"]
    return results.select(*by, *(F.round(name, digits).alias(f"test_{name}") for name in measures))


def feature_parity(left: DataFrame, right: DataFrame, features, keys=("subset", "unit_id", "cycle"), rtol=1e-10, atol=1e-12) -> DataFrame:
    """Cells in which two feature frames differ beyond tolerance; null equals NaN.

    Wide rows are joined once on their keys; only cells that differ become rows.
    """

    def side(df, name):
        cells = F.array(*(F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in features))
        return df.select(*keys, cells.alias(name))

    names = F.array(*(F.lit(c) for c in features))
    both = side(left, "x").join(side(right, "y"), list(keys), "full")
    nothing = F.array_repeat(F.lit(None).cast("double"), len(features))
    cells = F.arrays_zip(names.alias("feature"), F.coalesce("x", nothing).alias("a"), F.coalesce("y", nothing).alias("b"))

    def differs(cell):
        far = F.abs(cell["a"] - cell["b"]) > atol + rtol * F.abs(cell["b"])
        return F.coalesce(far, F.lit(False)) | (cell["a"].isNull() != cell["b"].isNull())

    return both.select(*keys, F.inline(F.filter(cells, differs)))


def request_outcomes(log: DataFrame, by=("subset", "model_type")) -> DataFrame:
    """Requested, successful and failed predictions per group."""
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "error").alias("failed"),
    )


def failed_requests(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == "error")
