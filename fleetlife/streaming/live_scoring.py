"""RUL predictions on a stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.operators import regimes, scaling
from fleetlife.plans import models, state
from fleetlife.schema import UNIT, sensors_in


def scaled_stream(rows: DataFrame, fitted: state.Fitted) -> DataFrame:
    """Regime and scaling by broadcast state; rows of unseen regimes are left out."""
    assigned = regimes.join_regimes(rows, fitted.mapping).where(F.col("regime").isNotNull())
    return scaling.apply_scaler(assigned, fitted.scaler, sensors_in(rows.columns))


def unseen_stream(rows: DataFrame, fitted: state.Fitted) -> DataFrame:
    """Quarantine: rows whose settings were not seen in training."""
    return regimes.join_regimes(rows, fitted.mapping).where(F.col("regime").isNull())


def live_predictions(features: DataFrame, model) -> DataFrame:
    """Predicted RUL for every in-order row of a feature stream."""
    usable = features.where(F.col("status") == "ok") if "status" in features.columns else features
    return models.predict(model, usable).select(*UNIT, "cycle", F.col("prediction").alias("predicted_rul"))


def write_scores(rows: DataFrame, path: str, checkpoint: str, score, available_now=True):
    """Score the whole histories of each trigger with a batch function and store them.

    For sources that deliver complete histories, such as request bodies. ``score`` takes
    the trigger's rows and returns predictions. Each trigger has its own folder, so a
    retried one is idempotent.
    """

    def store(batch, batch_id):
        score(batch).write.mode("overwrite").parquet(f"{path}/trigger={batch_id}")

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
