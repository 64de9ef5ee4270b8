"""JSON prediction requests: one body holds the observations of one unit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.schema import REQUEST, SUBSETS, TELEMETRY_COLUMNS


def parse_requests(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observation rows and rejected requests from (request_id, body).

    All rules work inside the body (array functions), so nothing is shuffled. Works
    on batch and streaming frames alike.
    """
    opened = bodies.select("request_id", "body", F.from_json("body", REQUEST).alias("r"))
    observed = F.col("r.observations")

    def incomplete(o):
        bad = (o["unit_id"] < 1) | (o["cycle"] < 1)
        for name in TELEMETRY_COLUMNS:
            bad = bad | o[name].isNull()
        return F.coalesce(bad, F.lit(True))

    units = F.size(F.array_distinct(F.transform(observed, lambda o: o["unit_id"])))
    subset = F.upper(F.col("r.subset_id"))
    reason = (
        F.when(F.col("r").isNull() | subset.isNull() | F.col("r.model_type").isNull(), "unreadable request")
        .when(~subset.isin(*SUBSETS), "unsupported subset")
        .when(observed.isNull() | (F.size(observed) < 1), "no observations")
        .when(F.exists(observed, incomplete), "incomplete observation")
        .when(units != 1, "more than one unit")
    )
    judged = opened.withColumn("reason", reason)
    rows = judged.where(F.col("reason").isNull()).select(
        "request_id", subset.alias("subset"), F.col("r.model_type").alias("model_type"), F.inline(observed)
    )
    return rows, judged.where(F.col("reason").isNotNull()).select("request_id", "body", "reason")


def to_requests(rows: DataFrame, keys=("request_id", "subset", "model_type")) -> DataFrame:
    """Bodies from observation rows; meant for bounded histories such as sampled tails."""
    observation = F.struct(*TELEMETRY_COLUMNS)
    grouped = rows.groupBy(*keys).agg(F.collect_list(observation).alias("observations"))
    body = F.to_json(F.struct(F.col("subset").alias("subset_id"), "model_type", "observations"))
    return grouped.select("request_id", body.alias("body"))
