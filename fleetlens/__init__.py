"""Fleet telemetry analytics expressed as Spark DataFrame operators."""
