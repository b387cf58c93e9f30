"""Device-fleet telemetry analytics as Spark DataFrame operators."""
