"""Lease state as it changes: one small state and one timer per lease that is in flight."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TRANSITIONS = "lease_id string, ids array<bigint>, status string, at bigint, served_at bigint"
GRANT, ACK = 0, 1


def _changed(key: tuple, ids: list[int], status: str, at: int, served_at: int) -> Row:
    return Row(lease_id=key[0], ids=list(ids), status=status, at=at, served_at=served_at)


class LeaseState(StatefulProcessor):
    """Transitions of one lease: in_flight when it is granted, then acked, or expired when its time is over.

    Times are microseconds; timers count milliseconds. State is kept from the grant to the end of the lease. An
    acknowledgement that finds no lease is kept for ``keep`` milliseconds of event time, in case the lease comes after it.
    """

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lease = handle.getValueState("lease", "ids array<bigint>, served_at bigint, until bigint, timer bigint")
        self.early = handle.getValueState("early", "acked_at bigint, timer bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for row in sorted(rows, key=lambda r: (r.micros, r.kind)):
            if row.kind == GRANT and not self.lease.exists():
                until = row.micros + row.allowed
                yield _changed(key, row.ids, "in_flight", row.micros, row.micros)
                if self.early.exists() and self.early.get()[0] <= until:
                    acked_at, timer = self.early.get()
                    self.early.clear()
                    self.handle.deleteTimer(timer)
                    yield _changed(key, row.ids, "acked", acked_at, row.micros)
                    continue
                # The first millisecond that is past the lease's last moment.
                timer = until // 1000 + 1
                self.lease.update((list(row.ids), row.micros, until, timer))
                self.handle.registerTimer(timer)
            elif row.kind == ACK and self.lease.exists():
                ids, served_at, until, timer = self.lease.get()
                if row.micros <= until:
                    self.lease.clear()
                    self.handle.deleteTimer(timer)
                    yield _changed(key, ids, "acked", row.micros, served_at)
            elif row.kind == ACK and not self.early.exists():
                timer = row.micros // 1000 + self.keep
                self.early.update((row.micros, timer))
                self.handle.registerTimer(timer)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.lease.exists() and self.lease.get()[3] <= now:
            ids, served_at, until, _ = self.lease.get()
            self.lease.clear()
            yield _changed(key, ids, "expired", until, served_at)
        if self.early.exists() and self.early.get()[1] <= now:
            self.early.clear()

    def close(self) -> None:
        pass


def lease_transitions(leases: DataFrame, acks: DataFrame, delay: str = "1 minute", keep_seconds: int = 300) -> DataFrame:
    """Streams of granted leases and acknowledgements to a stream of (lease_id, ids, status, at, served_at).

    A lease is granted at ``served_at`` for ``lease_seconds``. Its first acknowledgement in time settles it; later ones, repeated ones and
    those of unknown leases change nothing. It expires once both inputs' watermark, ``delay`` behind the latest time seen, has passed its
    end, so an acknowledgement in time that arrives up to ``delay`` late still counts. Needs the RocksDB state store.
    """
    granted = leases.select(
        "lease_id", F.col("served_at").cast("timestamp").alias("time"), F.lit(GRANT).alias("kind"),
        F.col("ids").cast("array<bigint>").alias("ids"), (F.col("lease_seconds").cast("bigint") * 1_000_000).alias("allowed"))
    acked = acks.select(
        "lease_id", F.col("acked_at").cast("timestamp").alias("time"), F.lit(ACK).alias("kind"),
        F.lit(None).cast("array<bigint>").alias("ids"), F.lit(0).cast("bigint").alias("allowed"))
    events = granted.unionByName(acked).withWatermark("time", delay).withColumn("micros", F.unix_micros("time"))
    changed = events.groupBy("lease_id").transformWithState(
        LeaseState(keep_seconds * 1000), TRANSITIONS, outputMode="Append", timeMode="EventTime")
    return changed.withColumns({c: F.timestamp_micros(c) for c in ("at", "served_at")})


def lease_state_stream(leases: DataFrame, acks: DataFrame, path: str, checkpoint: str, trigger: str = "1 second",
                       available_now: bool = False, delay: str = "1 minute") -> StreamingQuery:
    """Write the transitions of leases to a table as they happen; a restart goes on from the checkpoint."""
    spark = leases.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    usual = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)  # a stream keeps the settings it starts with
    try:
        writer = lease_transitions(leases, acks, delay).writeStream.format("parquet").outputMode("append")
        writer = writer.option("checkpointLocation", checkpoint)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
        return writer.start(path)
    finally:
        spark.conf.set(name, usual)


def lease_status(transitions: DataFrame) -> DataFrame:
    """The last status of every lease of a table of transitions: lease_id, ids, status."""
    settled = (F.col("status") != "in_flight").cast("int")
    return transitions.groupBy("lease_id").agg(F.max(F.struct(settled.alias("settled"), "status", "ids")).alias("last")).select(
        "lease_id", "last.ids", "last.status")
