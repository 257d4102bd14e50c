"""GPU telemetry on Spark: ingest, queue, collect and query, as DataFrame operators."""
