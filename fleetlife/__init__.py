"""Spark-native analytics for run-to-failure fleet telemetry."""
