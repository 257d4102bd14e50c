import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.operators import leases, queue, ranking

T0 = dt.datetime(2025, 6, 1, 12, 0, 0)


def ranges(spark, n, total=256):
    return [tuple(r) for r in queue.partition_ranges(spark, n, total).orderBy("owner").collect()]


def test_partition_ranges(spark):
    assert ranges(spark, 1) == [(0, 0, 255)]
    assert ranges(spark, 0) == ranges(spark, -3) == [(0, 0, 255)]
    assert ranges(spark, 3) == [(0, 0, 84), (1, 85, 169), (2, 170, 255)]
    many = ranges(spark, 300)
    assert many[-1] == (299, 0, 255) and all(r[1:] == (0, -1) for r in many[:-1])


@settings(max_examples=8, deadline=None)
@given(n=st.integers(1, 40), total=st.integers(1, 64))
def test_ranges_cover_every_key_once(spark, n, total):
    keys = spark.range(total).select(F.col("id").cast("int").alias("partition_key"))
    joined = queue.assign_owner(keys, queue.partition_ranges(spark, n, total))
    computed = joined.withColumn("o", queue.owner_of(F.col("partition_key"), n, total)).collect()
    assert sorted(r.partition_key for r in computed) == list(range(total))
    assert all(r.owner == r.o for r in computed)


def messages(spark, n, owner="0", ids="id * 3"):
    return spark.range(n).select(
        F.expr(ids).alias("id"), F.lit("t").alias("topic"), F.expr("concat('u', id)").alias("msg_uuid"),
        F.lit("{}").alias("payload"), F.lit(T0).alias("created_at"),
        F.expr(f"cast({owner} as int)").alias("partition_key"),
    )


def test_fetch_batch(spark):
    q = messages(spark, 100, "id % 256")
    assert [r.id for r in queue.fetch_batch(q, 10, 20, 5).collect()] == [30, 33, 36, 39, 42]
    assert queue.fetch_batch(q, 10, 20).count() == 11


@pytest.mark.parametrize("limit", [50, 1500])
def test_fetch_per_owner_with_a_hot_owner(spark, limit):
    q = messages(spark, 5000, "if(id % 10 < 8, 1, 200)").repartition(16)
    got = queue.fetch_batch_per_owner(q, queue.partition_ranges(spark, 4), limit).collect()
    plain = {0: [], 3: []}
    for i in range(5000):
        plain[0 if i % 10 < 8 else 3].append(i * 3)
    for owner, ids in plain.items():
        assert sorted(r.id for r in got if r.owner == owner) == ids[:limit]


def test_first_rows_over_several_blocks(spark):
    df = messages(spark, 4000, "id % 2", f"id * {1 << 17}").repartition(5)
    got = ranking.first_per_group(df, ["partition_key"], "id", 1200).collect()
    for key in (0, 1):
        want = [i << 17 for i in range(4000) if i % 2 == key][:1200]
        assert sorted(r.id for r in got if r.partition_key == key) == want


@pytest.mark.parametrize("ids", ["id", "id * 1000003", "id * 4611686018427 + 5", "id - 700"])
def test_fifo_rank(spark, ids):
    """Dense, sparse, very sparse and negative ids; one group has most rows."""
    df = messages(spark, 1500, "if(id % 7 = 0, 1, 0)", ids).repartition(5)
    got = ranking.fifo_rank(df, ["partition_key"]).collect()
    for key in (0, 1):
        rows = sorted((r.id, r["rank"]) for r in got if r.partition_key == key)
        assert [r for _, r in rows] == list(range(1, len(rows) + 1))
    assert len(got) == 1500


def test_fifo_rank_over_several_blocks(spark):
    df = messages(spark, 3000, "0", f"id * {1 << 18}")
    got = sorted((r.id, r["rank"]) for r in ranking.fifo_rank(df, ["partition_key"]).collect())
    assert [r for _, r in got] == list(range(1, 3001))


def test_pages_keep_every_row_in_order(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), "id"
    )
    got = ranking.pages(df, ["g"], ["id"], F.col("id"), 100, "ids").orderBy("g", "page").collect()
    assert max(len(r.ids) for r in got) <= 100
    for g in {r.g for r in got}:
        joined = [i for r in got if r.g == g for i in r.ids]
        assert joined == sorted(joined)
    assert sum(len(r.ids) for r in got) == 3000


def test_lease_batches(spark):
    owned = messages(spark, 250, "if(id < 205, 0, 1)").withColumnRenamed("partition_key", "owner")
    got = queue.lease_batches(owned, 100).groupBy("owner", "batch").count().collect()
    assert sorted((r.owner, r.batch, r["count"]) for r in got) == [(0, 0, 100), (0, 1, 100), (0, 2, 5), (1, 0, 45)]


LEASE = "lease_id string, ids array<long>, served_at timestamp, lease_seconds int"
ACK = "lease_id string, acked_at timestamp"


def delivery(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    granted = spark.createDataFrame([
        ("a", [0, 3], at(0), 60), ("b", [6], at(0), 1), ("c", [9], at(0), 30), ("d", [12, 15], at(20), 30),
        ("e", [6], at(15), 30), ("f", [18], at(90), 30),
    ], LEASE)
    acked = spark.createDataFrame([
        ("a", at(60)), ("a", at(61)), ("c", at(31)), ("e", at(20)), ("x", at(5)),
    ], ACK)
    return granted, acked, at


def test_effective_acks_and_counts(spark):
    granted, acked, at = delivery(spark)
    assert sorted((r.lease_id, r.acked) for r in leases.effective_acks(granted, acked).collect()) == [("a", 2), ("e", 1)]
    counts = leases.acked_count(granted, acked.unionByName(acked)).collect()
    assert sorted((r.lease_id, r.replies, r.acked) for r in counts) == [
        ("a", 2, 0), ("a", 2, 2), ("c", 2, 0), ("e", 2, 1), ("x", 2, 0)]


def test_message_state(spark):
    granted, acked, at = delivery(spark)
    q = messages(spark, 8)
    state = {r.id: (r.state, r.served) for r in leases.message_state(q, granted, acked, at(40)).collect()}
    assert state == {
        0: ("in_flight", 1), 3: ("in_flight", 1), 6: ("acked", 2), 9: ("ready", 1), 12: ("in_flight", 1),
        15: ("in_flight", 1), 18: ("ready", 0), 21: ("ready", 0),
    }
    assert [r.id for r in leases.redelivery(q, granted, acked, at(40)).collect()] == [9]
    later = {r.id: r.state for r in leases.message_state(q, granted, acked, at(62)).collect()}
    assert later[0] == later[3] == "acked" and later[12] == "ready"


def test_lease_expires_only_after_its_time(spark):
    granted, acked, at = delivery(spark)

    def expired(s):
        return sorted(r.lease_id for r in leases.expired_leases(granted, acked, at(s)).collect())

    assert expired(1) == [] and expired(1.000001) == ["b"]
    assert expired(30) == ["b"] and expired(31) == ["b", "c"]


def test_exclude_delete_and_utilization(spark):
    granted, acked, at = delivery(spark)
    q = messages(spark, 8, "id * 40")
    batch = queue.fetch_batch(q, 0, 255, 4)
    kept = queue.exclude_outstanding(batch, leases.outstanding_leases(granted, acked, at(40)))
    assert [r.id for r in kept.orderBy("id").collect()] == [6, 9]
    done = spark.createDataFrame([(0,), (3,), (99,), (3,)], "id long")
    assert queue.delete_acked(q, done).count() == 6
    assert queue.deleted_count(q, done).first().deleted_count == 2
    assert queue.delete_acked(q, done.filter("false")).count() == 8
    assert queue.deleted_count(q, done.filter("false")).first().deleted_count == 0
    used = queue.backlog_utilization(q, queue.partition_ranges(spark, 2), 4).orderBy("owner").collect()
    assert [(r.backlog, r.utilization) for r in used] == [(4, 1.0), (3, 0.75)]
    none = queue.backlog_utilization(q, queue.partition_ranges(spark, 2), 0).collect()
    assert [r.utilization for r in none] == [0.0, 0.0]


def test_compact_queue(spark, tmp_path):
    done = spark.createDataFrame([(0,)], "id long")
    queue.compact_queue(messages(spark, 8), done, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 7


@pytest.mark.parametrize("total", [100, 512])
def test_any_number_of_partitions_is_fetched_in_full(spark, total):
    rows = spark.range(total).select(
        F.col("id"), F.lit("t").alias("topic"), F.lit("m").alias("msg_uuid"), F.lit("{}").alias("payload"),
        F.lit(None).cast("timestamp").alias("created_at"), F.col("id").cast("int").alias("partition_key"))
    ranges = queue.partition_ranges(spark, 4, total)
    assert queue.fetch_batch_per_owner(rows, ranges).select("id").distinct().count() == total
    used = queue.backlog_utilization(rows, ranges, total).collect()
    assert sum(r.backlog for r in used) == total and all(r.backlog == total // 4 for r in used)


def test_running_backlog(spark, tmp_path):
    """Counts follow inserts and deletes over restarts; nothing is stored but the last batches."""
    from gaugeline.streaming import backlog

    schema = "id long, partition_key int"
    ups, downs, table, checkpoint = (str(tmp_path / n) for n in ("up", "down", "table", "c"))
    assert backlog.stored_backlog(spark, table).count() == 0
    put, gone = [], []
    for step in range(4):
        new = [(10 * step + i, i % 3) for i in range(7)]
        done = [r for r in put if r[0] % 10 < step]
        done = [r for r in done if r not in gone]
        spark.createDataFrame(new, schema).write.mode("append").parquet(ups)
        spark.createDataFrame(done, schema).write.mode("append").parquet(downs)
        put, gone = put + new, gone + done
        backlog.backlog_stream(spark.readStream.schema(schema).parquet(ups), spark.readStream.schema(schema).parquet(downs),
                               table, checkpoint, available_now=True).awaitTermination()
        got = {r.partition_key: r.waiting for r in backlog.stored_backlog(spark, table).collect()}
        assert got == {k: sum(r[1] == k for r in put) - sum(r[1] == k for r in gone) for k in range(3)}
    assert len(list((tmp_path / "table").iterdir())) <= 2
