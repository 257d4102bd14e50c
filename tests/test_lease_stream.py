"""Leases as a stream: each way a lease can end, restarts, and state that goes with its lease."""

import datetime as dt

import pytest

from gaugeline.streaming import leases

T = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)
GRANTS = "lease_id string, ids array<bigint>, served_at timestamp, lease_seconds int"
ACKS = "lease_id string, acked_at timestamp"


def after(seconds):
    return T + dt.timedelta(seconds=seconds)


def test_every_way_a_lease_ends(spark, tmp_path):
    grants = [[(n, [i], after(0), 30) for i, n in enumerate(["in-time", "last-moment", "too-late", "never", "twice", "first"])],
              [("acked-before", [7], after(100), 30), ("late-grant", [8], after(170), 30)],
              [("open", [9], after(1000), 600)]]
    acks = [[("in-time", after(10)), ("last-moment", after(30)), ("too-late", after(30.001)), ("twice", after(5)), ("twice", after(6)),
             ("first", after(40)), ("first", after(29)), ("unknown", after(1)), ("acked-before", after(99)), ("late-grant", after(60))],
            [("too-late", after(110))], [("tick", after(1100))]]
    paths = [str(tmp_path / n) for n in ("grants", "acks", "out", "checkpoint")]
    for some, told in zip(grants, acks, strict=True):
        spark.createDataFrame(some, GRANTS).write.mode("append").parquet(paths[0])
        spark.createDataFrame(told, ACKS).write.mode("append").parquet(paths[1])
        leases.lease_state_stream(spark.readStream.schema(GRANTS).parquet(paths[0]), spark.readStream.schema(ACKS).parquet(paths[1]),
                                  paths[2], paths[3], available_now=True).awaitTermination()
    rows = spark.read.parquet(paths[2]).collect()
    got = {(r.lease_id, r.status): r.at.replace(tzinfo=dt.timezone.utc) for r in rows}
    assert len(got) == len(rows)
    ends = {k: s for k, s in got if s != "in_flight"}
    assert ends == {"in-time": "acked", "last-moment": "acked", "too-late": "expired", "never": "expired", "twice": "acked",
                    "first": "acked", "acked-before": "acked", "late-grant": "acked"}
    assert got["twice", "acked"] == after(5) and got["first", "acked"] == after(29) and got["never", "expired"] == after(30)
    status = {r.lease_id: (r.status, r.ids) for r in leases.lease_status(spark.read.parquet(paths[2])).collect()}
    assert status == {k: (s, [["in-time", "last-moment", "too-late", "never", "twice", "first", "", "acked-before", "late-grant"].index(k)])
                      for k, s in ends.items()} | {"open": ("in_flight", [9])}
    # Of all leases only the one in flight has state left.
    name = "spark.sql.streaming.stateStore.providerClass"
    usual = spark.conf.get(name)
    spark.conf.set(name, leases.ROCKSDB)
    try:
        kept = spark.read.format("statestore").option("stateVarName", "lease").load(paths[3]).select("key.lease_id").collect()
    finally:
        spark.conf.set(name, usual)
    assert [r.lease_id for r in kept] == ["open"]


@pytest.mark.parametrize("replay", ["grants", "acks"])
def test_repeated_input_changes_nothing(spark, tmp_path, replay):
    paths = {n: str(tmp_path / n) for n in ("grants", "acks", "out", "checkpoint")}
    rows = {"grants": spark.createDataFrame([("a", [1], after(0), 30)], GRANTS), "acks": spark.createDataFrame([("b", after(3))], ACKS)}
    for step in range(2):
        for name, df in rows.items():
            if step == 0 or name == replay:
                df.write.mode("append").parquet(paths[name])
        leases.lease_state_stream(spark.readStream.schema(GRANTS).parquet(paths["grants"]), spark.readStream.schema(ACKS).parquet(paths["acks"]),
                                  paths["out"], paths["checkpoint"], available_now=True).awaitTermination()
    assert [(r.lease_id, r.status) for r in spark.read.parquet(paths["out"]).collect()] == [("a", "in_flight")]
