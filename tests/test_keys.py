"""Key tables: an insert reads the buckets of its own keys, and what is broken off is made good."""

import pytest
from pyspark.sql import functions as F

from gaugeline.plans import adapters
from gaugeline.sources import files, keys, tables
from gaugeline.sources.keys import KeyTable
from gaugeline.streaming import pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark):
    return adapters.load(spark, SF)


def files_read(spark, df):
    """Files that the scans of a query opened, by its metrics after it ran."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        found = [leaves.apply(i).metrics() for i in range(leaves.size())]
        return sum(m.apply("numFiles").value() for m in found if m.contains("numFiles"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def named(spark, numbers, *names):
    return spark.createDataFrame([tuple(f"{n}-{i}" for n in names) for i in numbers], ", ".join(f"{n} string" for n in names))


@pytest.mark.parametrize("columns", [["msg_uuid"], ["topic", "msg_uuid"]])
def test_held_keys_are_those_of_a_join(spark, tmp_path, monkeypatch, columns):
    monkeypatch.setattr(keys, "LOG_KEYS", 40)
    monkeypatch.setattr(keys, "LOG_FILES", 2)
    known = KeyTable(spark, str(tmp_path / "k"), columns)
    assert not known.exists() and known.held(named(spark, range(3), *columns)).count() == 0
    known.build(named(spark, range(0, 100, 2), *columns))
    for n in range(6):  # a few keys each, to the log, which is dealt out twice
        known.append(named(spark, range(200 + 10 * n, 203 + 10 * n), *columns), f"b{n}", 3)
    known.append(named(spark, range(400, 460), *columns), "big", 60)
    got = {(r[-2], r.batch) for r in known.held(named(spark, range(0, 500), *columns)).collect()}
    want = {(f"msg_uuid-{i}", "") for i in range(0, 100, 2)} | {(f"msg_uuid-{i}", "big") for i in range(400, 460)}
    assert got == want | {(f"msg_uuid-{200 + 10 * n + i}", f"b{n}") for n in range(6) for i in range(3)}
    log = f"{known.path}/generation=0/bucket=-1"
    assert len(files.names(spark, log)) <= 3


def test_few_keys_read_few_files(spark, tmp_path):
    known = KeyTable(spark, str(tmp_path / "k"), ["msg_uuid"])
    known.build(spark.range(20_000).select(F.concat(F.lit("msg_uuid-"), "id").alias("msg_uuid")))
    assert len(files.names(spark, f"{known.path}/generation=0")) == keys.BUCKETS
    few = files_read(spark, known.held(named(spark, range(3), "msg_uuid")))
    more = files_read(spark, known.held(named(spark, range(30), "msg_uuid")))
    assert 1 <= few <= 3 and few < more <= 30


def test_many_files_become_a_new_generation(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "LOG_FILES", 1)
    monkeypatch.setattr(keys, "BUCKET_FILES", 0)
    known = KeyTable(spark, str(tmp_path / "k"), ["msg_uuid"])
    known.build(named(spark, range(5), "msg_uuid"))
    for n in (10, 20):
        known.append(named(spark, [n], "msg_uuid"), str(n), 1)
    assert files.names(spark, known.path) == ["generation=1"]
    assert known.scan().count() == 7 and known.held(named(spark, [20, 3, 30], "msg_uuid")).count() == 2
    # A generation that is not complete does not count.
    known._write(known.scan().limit(1), 2, "overwrite")
    files.remove(spark, f"{known.path}/generation=2/_SUCCESS")
    assert known.scan().count() == 7


def test_work_per_flush_does_not_grow_with_the_queue(spark, events, tmp_path):
    """Neither numbering nor looking up message ids opens the queue's own files; only new flushes are written."""
    rows = adapters.readings(events).drop("id")
    queue = str(tmp_path / "queue")
    seen = []
    for n in range(4):
        pipeline.publish_batch(rows.where(F.col("value") > -1).limit(20).withColumn("pod", F.lit(f"p{n}")), queue, f"q-{n}", keys=["pod", "value", "timestamp"])
        known = tables.queue_keys(spark, queue)
        batch = tables.scan_batches(spark, queue, [f"q-{n}"])
        seen.append(files_read(spark, known.held(batch.limit(1))))
        assert pipeline.still_queued(known, batch, queue, f"q-{n}") is None
    assert seen[-1] <= keys.LOG_FILES and tables.next_id(spark, queue) == tables.scan_queue(spark, queue).count()
    assert all(not n.startswith("ingest_batch") for n in files.names(spark, f"{queue}/_next_id"))


def test_ids_stay_unique_across_marks(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MARKS", 2)
    queue, rows = str(tmp_path / "queue"), adapters.readings(events).drop("id").limit(7)
    for n in range(5):
        pipeline.publish_batch(rows, queue, f"q-{n}")
    assert len(files.names(spark, f"{queue}/_next_id")) <= 3
    tables.append_queue(adapters.queue(events).limit(2).withColumn("id", F.col("id") + 1000), queue, "by-hand")
    last = tables.scan_queue(spark, queue).agg(F.max("id")).head()[0]
    assert last >= 1000 and tables.next_id(spark, queue) == last + 1
    pipeline.publish_batch(rows, queue, "q-9")
    stored = tables.scan_queue(spark, queue)
    assert stored.count() == stored.select("id").distinct().count() == 7 * 6 + 2


def test_deleted_messages_may_be_published_again(spark, events, tmp_path):
    queue, rows = str(tmp_path / "queue"), adapters.readings(events)
    pipeline.publish_batch(rows, queue, "q-0", keys=["id"])
    n = tables.scan_queue(spark, queue).count()
    tables.delete_from_queue(spark, queue, tables.scan_queue(spark, queue).where("id < 5").select("id"))
    gone = n - tables.scan_queue(spark, queue).count()
    pipeline.publish_batch(rows, queue, "q-1", keys=["id"])
    assert gone > 0 and tables.scan_queue(spark, queue).count() == n
    pipeline.publish_batch(rows, queue, "q-2", keys=["id"])
    assert tables.scan_queue(spark, queue).count() == n


@pytest.mark.parametrize("lost", ["append_telemetry", "append"])
def test_keys_without_rows_are_not_believed(spark, events, tmp_path, monkeypatch, lost):
    """The writer is lost between keys and rows; another stream, under another name, brings the messages again."""
    messages, table, bad = adapters.queue(events), str(tmp_path / "t"), str(tmp_path / "bad")
    pipeline.collect_batch(messages.where("id < 20"), table, bad, "c-0")

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(*(pipeline, lost) if lost == "append_telemetry" else (KeyTable, lost), fail)
    with pytest.raises(RuntimeError, match="lost"):
        pipeline.collect_batch(messages, table, bad, "c-1")
    monkeypatch.undo()
    assert tables.telemetry_keys(spark, table).pending() == ["c-1"]
    for name in ("d-0", "c-1", "c-1", "d-1"):
        pipeline.collect_batch(messages, table, bad, name)
        assert tables.scan_telemetry(spark, table).count() == events.count()
    assert tables.telemetry_keys(spark, table).pending() == []


def test_lost_after_the_rows(spark, events, tmp_path, monkeypatch):
    messages, table, bad = adapters.queue(events), str(tmp_path / "t"), str(tmp_path / "bad")
    monkeypatch.setattr(KeyTable, "end", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        pipeline.collect_batch(messages, table, bad, "c-0")
    monkeypatch.undo()
    pipeline.collect_batch(messages, table, bad, "c-0")
    assert tables.scan_telemetry(spark, table).count() == events.count()


def test_rows_added_by_hand_are_known(spark, events, tmp_path):
    messages, table, bad = adapters.queue(events), str(tmp_path / "t"), str(tmp_path / "bad")
    pipeline.collect_batch(messages.where("id < 20"), table, bad, "c-0")
    other = str(tmp_path / "o")
    pipeline.collect_batch(messages.where("id >= 20 and id < 40"), other, bad, "c-0")
    tables.append_telemetry(tables.scan_telemetry(spark, other), table)
    pipeline.collect_batch(messages, table, bad, "c-1")
    assert tables.scan_telemetry(spark, table).count() == events.count()
