"""Column names, types and default parameters of the fleet telemetry model."""

from pyspark.sql import types as T

# The column layout of the telemetry files and the fleet subsets.
SUBSETS = ("FD001", "FD002", "FD003", "FD004")
SETTINGS = ("setting_1", "setting_2", "setting_3")
SENSORS = tuple(f"sensor_{n}" for n in range(1, 22))
MEASUREMENTS = SETTINGS + SENSORS
TELEMETRY_COLUMNS = ("unit_id", "cycle") + MEASUREMENTS
TERMINAL_COLUMN = "final_observed_rul"

# Parameters every report and feature set is defined with.
LAGS = (1, 5)
ROLLING_WINDOWS = (5, 10, 20)
EWMA_ALPHA = 0.2
SEQUENCE_LENGTH = 30
SETTING_DECIMALS = (0, 2, 0)
RUL_CAP = 125
SPLIT_SEED = 42
VALIDATION_FRACTION = 0.2
OBSERVED_FRACTION = 0.5

# A trajectory is identified by its subset and its unit.
UNIT = ("subset", "unit_id")
PROTECTED = ("subset", "unit_id", "cycle", "RUL")
METADATA = ("subset", "run_id", "split", "unit_id", "cycle", "RUL", "operating_regime")
FEATURE_MARKERS = ("_lag_", "_diff_", "_rolling_", "_ewma")

TELEMETRY = T.StructType(
    [T.StructField("unit_id", T.IntegerType()), T.StructField("cycle", T.IntegerType())]
    + [T.StructField(name, T.DoubleType()) for name in MEASUREMENTS]
)

TERMINAL = T.StructType(
    [
        T.StructField("subset", T.StringType(), False),
        T.StructField("unit_id", T.IntegerType(), False),
        T.StructField(TERMINAL_COLUMN, T.IntegerType(), False),
    ]
)

REQUEST = T.StructType(
    [
        T.StructField("subset_id", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("observations", T.ArrayType(TELEMETRY)),
    ]
)

SENSOR_STATS = T.StructType(
    [
        T.StructField("sensor", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]
)

# One row of learned preprocessing state per (subset, run).
STATE = T.StructType(
    [
        T.StructField(
            "regime_mapping",
            T.ArrayType(
                T.StructType(
                    [T.StructField(name, T.DoubleType()) for name in SETTINGS]
                    + [T.StructField("regime", T.IntegerType())]
                )
            ),
        ),
        T.StructField("dropped_feature_columns", T.ArrayType(T.StringType())),
        T.StructField("retained_sensor_columns", T.ArrayType(T.StringType())),
        T.StructField(
            "regime_sensor_scaler",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("regime", T.IntegerType()),
                        T.StructField("sensors", T.ArrayType(SENSOR_STATS)),
                    ]
                )
            ),
        ),
        T.StructField("global_sensor_scaler", T.ArrayType(SENSOR_STATS)),
    ]
)


def sensors_in(columns):
    """The sensors present in ``columns``, in their standard order."""
    present = set(columns)
    return [name for name in SENSORS if name in present]


def measurements_in(columns):
    present = set(columns)
    return [name for name in MEASUREMENTS if name in present]


def feature_columns(columns):
    """Everything a model may learn from: all columns but the metadata."""
    return [name for name in columns if name not in METADATA]


def feature_set(columns):
    temporal = any(marker in name for name in columns for marker in FEATURE_MARKERS)
    return "temporal" if temporal else "baseline"


def is_integral(data_type):
    return isinstance(data_type, T.IntegralType)


def is_numeric(data_type):
    return isinstance(data_type, T.NumericType)
