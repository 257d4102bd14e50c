"""The whole pipeline as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators.collect import persist_telemetry
from gaugeline.operators.merge import insert_if_absent
from gaugeline.operators.readings import gpu_telemetry
from gaugeline.plans import adapters as A


def end_to_end(events: DataFrame) -> DataFrame:
    """Readings, some delivered twice, published to the queue and collected into telemetry."""
    nothing = events.filter("false")
    queued = insert_if_absent(
        A.queue_keys(nothing), A.queue(A.redelivered(events)), ["topic", "msg_uuid"], ["id"]
    )
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return persist_telemetry(A.telemetry(nothing), queued, at)


def busiest_gpu_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.load(spark, sf_dir)
    return A.plain_times(gpu_telemetry(end_to_end(events), A.busiest_gpu(events)))
