"""Machine telemetry on Spark: documents, wide rows, alarms, machine status."""
