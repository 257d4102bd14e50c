"""Reading and writing reading files and the queue and telemetry tables."""
