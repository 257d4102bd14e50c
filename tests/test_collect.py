import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeline.operators import collect, constraints, merge, publish, upgrades
from gaugeline.schemas import TELEMETRY_SCHEMA

U = "550e8400-e29b-41d4-a716-44665544000"


def message(i, uuid="GPU-1", value=87.3, lease="l", payload=None):
    text = payload or f'{{"uuid":"{uuid}","gpu_id":"0","metric_name":"m","value":{value},"timestamp":"2025-01-01T00:00:0{i}Z"}}'
    return (i, lease, U + str(i), text)


def leased(spark, *messages):
    return spark.createDataFrame(list(messages), "id long, lease_id string, msg_uuid string, payload string")


def empty(spark):
    return spark.createDataFrame([], TELEMETRY_SCHEMA)


def test_two_new_then_again_then_mixed(spark):
    first = leased(spark, message(1), message(2, value=42949672960))
    stored = collect.persist_telemetry(empty(spark), first)
    assert sorted(r.value for r in stored.collect()) == [87.3, 42949672960.0]
    assert collect.persist_telemetry(stored, first).isEmpty()
    mixed = leased(spark, message(2), message(3))
    assert [r.id for r in collect.persist_telemetry(stored, mixed).collect()] == [3]
    counts = collect.persist_counts(stored, mixed).first()
    assert (counts.persisted, counts.duplicates) == (1, 1)


def test_inserts_with_matching_keys_only_agree(spark):
    target = spark.range(0, 100, 2).withColumn("v", F.lit("old"))
    batch = spark.range(60).withColumn("v", F.lit("new")).unionByName(spark.range(60).withColumn("v", F.lit("newer")))
    want = [(i, "new") for i in range(1, 60, 2)]
    for held in (target, merge.matching_keys(target, batch, ["id"])):
        got = merge.insert_if_absent(held, batch, ["id"], ["v"]).collect()
        assert sorted((r.id, r.v) for r in got) == want


def test_insert_twice_is_insert_once(spark):
    batch = spark.range(30).select((F.col("id") % 10).alias("k"), "id")
    once = merge.insert_if_absent(None, batch, ["k"], ["id"])
    assert sorted((r.k, r.id) for r in once.collect()) == [(i, i) for i in range(10)]
    assert merge.insert_if_absent(once, batch, ["k"], ["id"]).isEmpty()


def test_first_row_of_a_hot_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("k"), "id").repartition(8)
    got = {r.k: r.id for r in merge.dedup_first(df, ["k"], ["id"]).collect()}
    assert got[0] == 0 and len(got) == 1 + len([i for i in range(20_000) if i % 3 == 2])


def test_duplicates_across_leases(spark):
    rows = leased(spark, message(1, lease="a"), (2, "b", U + "1", "{}"), message(3, lease="b"))
    got = {r.lease_id: (r.persisted, r.duplicates) for r in collect.persist_counts(empty(spark), rows).collect()}
    assert got == {"a": (1, 0), "b": (1, 1)}


def test_lease_outcome(spark):
    from gaugeline.functions.payload import parse_payload

    rows = leased(spark, message(1, lease="bad", payload="x"), message(2, lease="mixed", payload="[]"), message(3, lease="mixed"))
    got = {r.lease_id: tuple(r)[1:] for r in collect.lease_outcome(parse_payload(rows)).collect()}
    assert got == {"bad": ("skip", False, 0, 1), "mixed": ("persist", True, 1, 1)}


def test_quarantine_and_strict(spark):
    rows = leased(spark, message(1), message(2, uuid=""), (3, "l", "u1", message(3)[3]), message(4, payload="x"))
    checked = collect.telemetry_rows(rows)
    assert [r.id for r in collect.storable(checked).collect()] == [1]
    assert {r.id: r.problem for r in collect.quarantined(checked).collect()} == {
        2: collect.NO_UUID, 3: collect.BAD_MSG_UUID, 4: collect.BAD_PAYLOAD}
    with pytest.raises(Exception, match=collect.NO_UUID):
        collect.storable(collect.telemetry_rows(rows.filter("id <> 3"), "strict")).collect()


def test_empty_texts_become_null(spark):
    row = collect.telemetry_rows(leased(spark, message(1))).first()
    assert row.device is None and row.labels_raw is None and row.uuid == "GPU-1"


def apportioned(spark, sizes, accepted, duplicates):
    rows = [(1, "t", i, n) for i, n in enumerate(sizes)]
    requests = spark.createDataFrame(rows, "flush_id int, topic string, request_id long, n long")
    totals = spark.createDataFrame([(1, "t", accepted, duplicates)], "flush_id int, topic string, accepted long, duplicates long")
    return publish.apportion(requests, totals).orderBy("request_id").collect()


def test_apportion(spark):
    assert [r.accepted for r in apportioned(spark, [3, 3, 4], 7, 3)] == [2, 2, 3]


@settings(max_examples=6, deadline=None)
@given(sizes=st.lists(st.integers(0, 9), min_size=1, max_size=12), part=st.integers(0, 100))
def test_apportion_is_the_plain_rule(spark, sizes, part):
    total = sum(sizes)
    accepted = total * part // 100
    got = apportioned(spark, sizes, accepted, total - accepted)
    for name, whole in (("accepted", accepted), ("duplicates", total - accepted)):
        shares = [whole * n // total if total else 0 for n in sizes[:-1]]
        assert [r[name] for r in got] == [*shares, whole - sum(shares)]


def test_publish_counts(spark):
    held = spark.createDataFrame([("a", "1"), ("a", "9")], "topic string, msg_uuid string")
    batch = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "2"), ("b", "1")], "topic string, msg_uuid string")
    got = {r.topic: (r.accepted, r.duplicates) for r in publish.publish_counts(held, batch).collect()}
    assert got == {"a": (1, 2), "b": (1, 0)}


def test_versions(spark):
    v1 = spark.createDataFrame([(1, U + "1")], "id long, uuid string")
    v7 = upgrades.upgrade_telemetry(v1, 1)
    row = v7.first()
    assert (row.msg_uuid, row.uuid, row.device, row.hostname) == (U + "1", U + "1", None, None)
    assert upgrades.downgrade_telemetry(v7, 7, 1).columns == v1.columns
    with pytest.raises(Exception, match="not a UUID"):
        upgrades.downgrade_telemetry(v7.withColumn("uuid", F.lit("GPU-1")), 7, 1).collect()
    with pytest.raises(Exception, match="msg_uuid is missing"):
        upgrades.upgrade_telemetry(v1.withColumn("uuid", F.lit(None).cast("string")), 1).collect()
    q1 = spark.createDataFrame(
        [(1, "t", U + "1", '{"gpu_id":"a"}', "acked", 2)],
        "id long, topic string, msg_uuid string, payload string, state string, attempts int",
    )
    q7 = upgrades.upgrade_queue(q1, 1)
    assert q7.columns == ["id", "topic", "msg_uuid", "payload", "partition_key"] and q7.first().partition_key == 0
    assert upgrades.upgrade_queue(q1, 1, rehash=True).first().partition_key == 44
    old = upgrades.downgrade_queue(q7, 7, 1).first()
    assert (old.state, old.attempts, old.leased_by) == ("ready", 0, None)
    assert upgrades.upgrade_queue(upgrades.downgrade_queue(q7, 7, 2), 2).columns == q7.columns


def test_constraints(spark):
    df = spark.createDataFrame(
        [(1, "t", "a", "ready"), (1, "t", "a", "lost"), (2, None, "a", None), (3, None, "a", "acked")],
        "id long, topic string, msg_uuid string, state string",
    )
    report = constraints.constraint_report(
        df, not_null=["id", "topic"], unique=[["id"], ["topic", "msg_uuid"]], check=constraints.QUEUE_V1_RULES["check"]
    )
    assert {r.constraint: r.violations for r in report.collect()} == {
        "not_null(id)": 0, "not_null(topic)": 2, "check(state)": 1, "unique(id)": 1, "unique(topic, msg_uuid)": 1}
