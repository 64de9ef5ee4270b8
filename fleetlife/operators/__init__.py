"""DataFrame operators on telemetry, labels, predictions and runs."""
