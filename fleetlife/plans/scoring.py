"""Batch RUL scoring of raw histories with stored state and a stored model."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.operators import selection, sequences, temporal, trajectory
from fleetlife.plans import models, state
from fleetlife.schema import SEQUENCE_LENGTH, UNIT, feature_set, sensors_in


def _used_sensors(fitted: state.Fitted, features) -> list[str]:
    """Sensors the features are made of."""
    retained = state.retained_sensors(fitted)
    return [s for s in retained if any(f == s or f.startswith(f"{s}_") for f in features)]


def prepare(rows: DataFrame, fitted: state.Fitted, features, keys=UNIT, contiguous=False, strict=True) -> DataFrame:
    """Raw rows to model features: the training steps, with stored state.

    Histories must be whole: smoothed features are seeded by the first row given.
    """
    used = _used_sensors(fitted, features)
    others = [name for name in rows.columns if name not in sensors_in(rows.columns)]
    scaled = state.apply(rows.select(*others, *used), fitted, strict)
    if feature_set(features) == "temporal":
        scaled = temporal.temporal_features(scaled, used, keys=keys, contiguous=contiguous)
    carried = [name for name in (*keys, "cycle") if name in scaled.columns]
    return scaled.select(*carried, *features)


def score_last(rows: DataFrame, fitted: state.Fitted, model, features, keys=UNIT, contiguous=False, strict=True) -> DataFrame:
    """Predicted RUL at the last observed cycle of every unit.

    Only rows that the last one's features read are prepared: itself for baseline features,
    the longest frame before it for temporal ones.
    """
    ends = trajectory.unit_last_cycle(rows, keys).withColumnRenamed("last_cycle", "end_cycle")
    if feature_set(features) == "temporal":
        needed = sequences.tails(rows, ends, temporal.reach() + 1, keys, contiguous)
        prepared = prepare(needed.drop("end_cycle"), fitted, features, keys, False, strict)
        at_end = prepared.join(ends.withColumnRenamed("end_cycle", "cycle"), [*keys, "cycle"])
    else:
        at_end = prepare(trajectory.last_rows(rows, [c for c in rows.columns], keys), fitted, features, keys, contiguous, strict)
    return models.predict(model, at_end).select(*keys, "cycle", F.col("prediction").alias("predicted_rul"))


def score_last_sequences(rows: DataFrame, fitted: state.Fitted, scorer, features, length=SEQUENCE_LENGTH, keys=UNIT, contiguous=False) -> DataFrame:
    """Predicted RUL per unit from its last ``length`` prepared rows."""
    if length < 1:
        raise ValueError("the sequence length must be at least 1")
    dense = selection.dense_float_features(prepare(rows, fitted, features, keys, contiguous), features)
    ends = trajectory.unit_last_cycle(rows, keys).withColumnRenamed("last_cycle", "end_cycle")
    made = sequences.endpoint_sequences(dense, ends, features, length, keys, contiguous)
    return models.score_sequences(made, scorer).withColumnRenamed("prediction", "predicted_rul").drop("sequence")
