"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from gaugeline.functions import identity
from gaugeline.operators import queue, readings
from gaugeline.plans import adapters
from gaugeline.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
BATCH = [n for n in sorted(QUERIES) if not n.startswith(("stream_", "csv_", "table_"))]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in text


def test_fetch_is_a_top_k(spark):
    text = plan(queue.fetch_batch(adapters.queue(adapters.load(spark, SF)), 0, 63))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_fetch_per_owner_keeps_candidates_before_the_shuffle(spark):
    owned = adapters.queue_keys(adapters.load(spark, SF)).withColumn("payload", F.lit(""))
    text = plan(queue.fetch_batch_per_owner(owned, queue.partition_ranges(spark, 4), 10))
    assert text.count("WindowGroupLimit") >= 2


def test_scan_reads_only_what_is_asked(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "t")
    adapters.telemetry(adapters.load(spark, SF)).write.parquet(path)
    table = spark.read.parquet(path)
    text = plan(readings.list_gpus(table))
    assert "ReadSchema: struct<uuid:string>" in text and "PushedFilters: [IsNotNull(uuid)]" in text
    text = plan(readings.gpu_telemetry(table, "GPU-000001", "2024-01-05T00:00:00Z"))
    assert "EqualTo(uuid,GPU-000001)" in text and "GreaterThanOrEqual(timestamp,2024-01-05" in text


def test_hash_and_owner_need_no_shuffle(spark):
    df = spark.range(10).withColumn("k", identity.fnv1a_partition(F.col("id").cast("string")))
    assert "Exchange" not in plan(df.withColumn("o", queue.owner_of(F.col("k"), 3)))
