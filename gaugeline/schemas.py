"""Table layouts and fixed operating points."""

from __future__ import annotations

from pyspark.sql import types as T

# Operating points of the telemetry pipeline.
VIRTUAL_PARTITIONS = 256
FLUSH_INTERVAL = "500 milliseconds"
FETCH_LIMIT = 1000
LEASE_MAX = 100
LEASE_SECONDS = 30
TOPIC = "telemetry"
WINDOW_START = "1970-01-01T00:00:00Z"
WINDOW_END = "2100-01-01T00:00:00Z"
ZERO_TIME = "0001-01-01T00:00:00Z"

# Column orders of the files and tables.
READING_COLUMNS = [
    "timestamp", "metric_name", "gpu_id", "device", "uuid", "model_name",
    "hostname", "container", "pod", "namespace", "value", "labels_raw",
]
TEXT_COLUMNS = [c for c in READING_COLUMNS if c not in ("timestamp", "value")]
NULLABLE_TEXT = [
    "uuid", "device", "model_name", "hostname", "container", "pod", "namespace", "labels_raw",
]
ENTRY_COLUMNS = [
    "uuid", "gpu_id", "metric_name", "timestamp", "device", "model_name", "hostname",
    "container", "pod", "namespace", "value", "labels_raw", "ingested_at",
]
TELEMETRY_COLUMNS = [
    "id", "uuid", "msg_uuid", "gpu_id", "metric_name", "timestamp", "device", "model_name",
    "hostname", "container", "pod", "namespace", "value", "labels_raw", "ingested_at",
]
QUEUE_COLUMNS = ["id", "topic", "msg_uuid", "payload", "created_at", "partition_key"]
MESSAGE_STATES = ["ready", "in_flight", "acked"]


def _type_of(column: str) -> T.DataType:
    if column in ("timestamp", "ingested_at", "created_at"):
        return T.TimestampType()
    if column == "id":
        return T.LongType()
    if column == "partition_key":
        return T.IntegerType()
    if column == "value":
        return T.DoubleType()
    return T.StringType()


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _type_of(c)) for c in columns])


READING_SCHEMA = _schema(READING_COLUMNS)
TELEMETRY_SCHEMA = _schema(TELEMETRY_COLUMNS)
QUEUE_SCHEMA = _schema(QUEUE_COLUMNS)
