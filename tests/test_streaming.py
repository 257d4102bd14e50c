import datetime as dt

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import adapters
from gaugeline.sources import csv_files, tables
from gaugeline.streaming import pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark):
    return adapters.load(spark, SF)


def test_csv_to_queue_to_telemetry(spark, events, tmp_path):
    """Readings without ids: every row is a message of its own, even equal rows."""
    rows = adapters.readings(events).drop("id")
    same = rows.limit(1)
    csv_files.write_telemetry_csv(rows.unionByName(same).unionByName(same).repartition(3), str(tmp_path / "csv"))
    n = events.count() + 2
    queue, checkpoint = str(tmp_path / "queue"), str(tmp_path / "c1")
    source = csv_files.stream_telemetry_csv(spark, str(tmp_path / "csv"), 1)
    for _ in range(2):  # the second start finds nothing new
        pipeline.publish_stream(source, queue, checkpoint, available_now=True).awaitTermination()
    stored = tables.scan_queue(spark, queue)
    assert stored.count() == stored.select("id").distinct().count() == stored.select("msg_uuid").distinct().count() == n
    assert stored.agg(F.min("id"), F.max("id")).head() == (0, n - 1)
    # A stream with a checkpoint of its own goes on after the greatest id.
    pipeline.publish_stream(source, queue, str(tmp_path / "c0"), available_now=True).awaitTermination()
    stored = tables.scan_queue(spark, queue)
    assert stored.count() == stored.select("id").distinct().count() == 2 * n
    n = 2 * n

    telemetry, bad = str(tmp_path / "telemetry"), str(tmp_path / "bad")
    for checkpoint in ("c2", "c3"):  # a fresh checkpoint delivers everything again
        pipeline.collect_stream(
            tables.stream_queue(spark, queue, 1), telemetry, bad, str(tmp_path / checkpoint), available_now=True
        ).awaitTermination()
        assert tables.scan_telemetry(spark, telemetry).count() == n
    assert not tables.table_exists(spark, bad)


def test_repeated_batch_is_a_no_op(spark, events, tmp_path):
    queue = str(tmp_path / "queue")
    rows = adapters.readings(events)
    for _ in range(2):
        pipeline.publish_batch(rows, queue, "q-0", keys=["id"])
        pipeline.publish_batch(rows.filter("id < 10"), queue, "q-1", keys=["id"])
    assert tables.scan_queue(spark, queue).count() == rows.count()
    again = str(tmp_path / "again")
    for _ in range(2):
        pipeline.publish_batch(rows, again, "q-0")
    assert tables.scan_queue(spark, again).count() == rows.count()


def test_staged_ids_survive_a_replay(spark, events, tmp_path):
    rows = adapters.readings(events).drop("id")
    queue, staging = str(tmp_path / "queue"), str(tmp_path / "staged")
    seen = []
    for _ in range(2):
        pipeline.publish_batch(rows, queue, "q-3", staging=staging)
        seen.append({(r.id, r.msg_uuid) for r in tables.scan_queue(spark, queue).collect()})
    assert seen[0] == seen[1]
    assert sorted(i for i, _ in seen[0]) == list(range(rows.count()))
    assert not tables.table_exists(spark, f"{staging}/q-3")


def test_failed_store_is_delivered_again(spark, events, tmp_path, monkeypatch):
    queue, telemetry = str(tmp_path / "queue"), str(tmp_path / "telemetry")
    pipeline.publish_batch(adapters.readings(events), queue, "q-0", keys=["id"])

    def run():
        return pipeline.collect_stream(
            tables.stream_queue(spark, queue), telemetry, str(tmp_path / "bad"), str(tmp_path / "c"), available_now=True)

    def fail(*_):
        raise RuntimeError("disk full")

    monkeypatch.setattr(pipeline, "append_telemetry", fail)
    with pytest.raises(Exception, match="disk full"):
        run().awaitTermination()
    monkeypatch.undo()
    run().awaitTermination()
    assert tables.scan_telemetry(spark, telemetry).count() == events.count()


def test_delete_from_a_live_queue(spark, events, tmp_path, monkeypatch):
    queue, telemetry = str(tmp_path / "queue"), str(tmp_path / "telemetry")
    rows = adapters.readings(events).drop("id")
    n = rows.count()
    for name in ("q-0", "q-1"):
        pipeline.publish_batch(rows, queue, name)

    def collect():
        pipeline.collect_stream(tables.stream_queue(spark, queue), telemetry, str(tmp_path / "bad"),
                                str(tmp_path / "c"), available_now=True).awaitTermination()

    def ids():
        return sorted(r.id for r in tables.scan_queue(spark, queue).select("id").collect())

    collect()
    tables.delete_from_queue(spark, queue, spark.range(10 * n, 10 * n + 5))
    assert ids() == list(range(2 * n))
    # All of the second flush; the first one's files stay as they are.
    before = sorted(p.name for p in (tmp_path / "queue" / "ingest_batch=q-0").iterdir())
    tables.delete_from_queue(spark, queue, spark.range(n, 2 * n))
    assert ids() == list(range(n))
    assert before == sorted(p.name for p in (tmp_path / "queue" / "ingest_batch=q-0").iterdir())
    pipeline.publish_batch(rows, queue, "q-1")  # a late repetition of what is deleted
    assert ids() == list(range(n))
    pipeline.publish_batch(rows.limit(3), queue, "q-2")  # does not use deleted ids again
    assert ids() == [*range(n), 2 * n, 2 * n + 1, 2 * n + 2]

    # A delete that is broken off between its files: the next writer ends it.
    monkeypatch.setattr(tables, "_move", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError, match="gone"):
        tables.delete_from_queue(spark, queue, spark.range(0, 10))
    monkeypatch.undo()
    pipeline.publish_batch(rows, queue, "q-0")
    assert ids() == [*range(10, n), 2 * n, 2 * n + 1, 2 * n + 2]
    collect()
    assert tables.scan_telemetry(spark, telemetry).count() == 2 * n + 3


def test_bad_messages_are_set_aside_once(spark, events, tmp_path):
    messages = adapters.queue(events).withColumn(
        "payload", F.when(F.col("id") < 5, "nope").otherwise(F.col("payload")))
    telemetry, bad = str(tmp_path / "telemetry"), str(tmp_path / "bad")
    for _ in range(2):
        pipeline.collect_batch(messages, telemetry, bad, "c-0")
    assert spark.read.parquet(bad).count() == 5
    assert tables.scan_telemetry(spark, telemetry).count() == events.count() - 5


def test_unacked(spark, tmp_path):
    t = dt.datetime(2025, 1, 1)
    rows = [("in-time", t, 30), ("late", t, 31), ("never", t, None), ("end", t + dt.timedelta(hours=1), 0)]
    df = spark.createDataFrame(rows, "lease_id string, sent_at timestamp, after int")
    df.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    twice = source.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(50))))
    acked = twice.filter("after IS NOT NULL").select(
        "lease_id", F.expr("sent_at + make_dt_interval(0, 0, 0, after)").alias("acked_at"))
    lost = pipeline.unacked_stream(source.select("lease_id", "sent_at"), acked)
    lost.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.schema(lost.schema).parquet(str(tmp_path / "out")).collect()
    assert sorted(r.lease_id for r in got) == ["late", "never"]


def test_whole_rows_are_compared_only_for_mixed_batches(spark, events, tmp_path, monkeypatch):
    """Batches of nothing but new messages, or of none, are judged by their keys."""
    queue, telemetry, bad = (str(tmp_path / n) for n in ("queue", "telemetry", "bad"))
    wide, usual = [], pipeline.insert_if_absent

    def insert(held, batch, keys, order=None):
        wide.append(set(batch.columns) > set(keys))
        return usual(held, batch, keys, order)

    monkeypatch.setattr(pipeline, "insert_if_absent", insert)
    rows = adapters.readings(events).where("id < 60")

    def run(batch, name):
        wide.clear()
        pipeline.publish_batch(batch, queue, name, keys=["id"])
        published = any(wide)
        messages = adapters.queue(events).where(F.col("id").isin([r.id for r in batch.select("id").distinct().collect()]))
        wide.clear()
        pipeline.collect_batch(messages if batch.count() == messages.count() else messages.unionByName(messages), telemetry, bad, name)
        stored = [tables.scan_queue(spark, queue), tables.scan_telemetry(spark, telemetry)]
        return published, any(wide), [sorted(r.id for r in s.select("id").collect()) for s in stored]

    early, later = rows.where("id < 20"), rows.where("id >= 10")
    assert run(early, "new") == (False, False, [list(range(20))] * 2)
    assert run(early, "known") == (False, False, [list(range(20))] * 2)
    assert run(later, "mixed") == (True, True, [list(range(60))] * 2)
    copies = adapters.readings(events).where("id >= 60 AND id < 70")
    assert run(copies.unionByName(copies), "copies") == (True, True, [list(range(70))] * 2)
