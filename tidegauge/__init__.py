"""tidegauge: telemetry analytics written as Spark DataFrame operators."""
