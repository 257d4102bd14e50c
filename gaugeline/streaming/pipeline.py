"""Streams from readings to the queue, from the queue to telemetry, and of lost deliveries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeline.functions.identity import assign_msg_uuid, fnv1a_partition
from gaugeline.functions.payload import to_payload
from gaugeline.functions.scalars import stamp_processed_at
from gaugeline.operators.collect import quarantined, storable, telemetry_rows
from gaugeline.operators.merge import insert_if_absent, matching_keys
from gaugeline.operators.publish import queue_rows
from gaugeline.schemas import FLUSH_INTERVAL, TELEMETRY_COLUMNS, TOPIC, VIRTUAL_PARTITIONS
from gaugeline.sources.files import remove
from gaugeline.sources.keys import KeyTable
from gaugeline.sources.tables import (
    append_queue,
    append_telemetry,
    batch_complete,
    finish_delete,
    next_id,
    queue_keys,
    raise_mark,
    reserve_ids,
    scan_batches,
    scan_queue,
    scan_telemetry,
    table_exists,
    telemetry_keys,
)


def _run(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str,
    available_now: bool,
) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    return writer.start()


def _batch_name(batch: DataFrame, batch_id: int) -> str:
    """The same for every attempt at a batch, different for every query."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def _read_staged(rows: DataFrame, folder: str, queue_path: str) -> tuple[DataFrame, int, int]:
    """``rows`` written once, the first id for them and their number: a replay reads what the first complete attempt wrote.

    Ids are reserved for them, after the greatest one that was ever given; rows that bring their own reserve those.
    """
    spark = rows.sparkSession
    if not table_exists(spark, folder) or not table_exists(spark, f"{folder}/_done"):
        rows.write.mode("overwrite").parquet(f"{folder}/rows")
        staged = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
        size, last = staged.agg(F.count("*"), F.max("id") if "id" in rows.columns else F.lit(None)).head()
        if "id" not in rows.columns:
            first = reserve_ids(spark, queue_path, size)
        else:
            first = next_id(spark, queue_path)
            if last is not None and last >= first:
                raise_mark(spark, queue_path, last)
        spark.createDataFrame([(first, size)], "first bigint, size bigint").coalesce(1).write.mode("overwrite").parquet(f"{folder}/_done")
    done = spark.read.schema("first bigint, size bigint").parquet(f"{folder}/_done").head()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows"), done[0], done[1]


def number_rows(staged: DataFrame, first: int, position: str = "_at") -> DataFrame:
    """Turn positions of ``monotonically_increasing_id`` into dense, rising ``id``s from ``first``.

    The offsets are one row per writing task, so their window and broadcast are small.
    """
    task = F.shiftright(position, 33)
    counts = staged.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    in_task = F.col(position).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        staged.withColumn("_task", task).join(F.broadcast(offsets), "_task")
        .withColumn("id", F.lit(first).cast("bigint") + F.col("_offset") + in_task)
        .drop("_task", "_offset", position)
    )


def publish_batch(
    readings: DataFrame,
    queue_path: str,
    batch: str,
    keys: list[str] | None = None,
    staging: str | None = None,
    topic: str = TOPIC,
    partitions: int = VIRTUAL_PARTITIONS,
    at: Column | None = None,
) -> None:
    """Put a batch of readings on the queue; repeating the same batch changes nothing.

    With ``keys`` message ids follow from the source and are inserted if absent. Without,
    every reading is a new message with a random message id. Batches are staged first, so that
    neither ids nor message ids change when a batch is repeated, and staging is removed once
    the batch is in the queue. Readings without an ``id`` get the next ones of the queue: one
    publisher at a time, as for inserts.
    """
    spark = readings.sparkSession
    rows = to_payload(stamp_processed_at(readings, at)).withColumns({
        "topic": F.lit(topic),
        "partition_key": fnv1a_partition(F.col("gpu_id"), partitions),
    })
    rows = assign_msg_uuid(rows, keys)
    staging = staging or f"{queue_path.rstrip('/')}-staged"
    finish_delete(spark, queue_path)
    if batch_complete(spark, queue_path, batch):
        return
    given = ["id"] if "id" in readings.columns else []
    placed = rows.select(*given, "topic", "msg_uuid", "payload", "partition_key").withColumn(
        "_at", F.monotonically_increasing_id()
    )
    folder = f"{staging.rstrip('/')}/{batch}"
    staged, first, size = _read_staged(placed, folder, queue_path)
    messages = queue_rows(staged.drop("_at") if given else number_rows(staged, first), at)
    if keys is not None:
        known, held = queue_keys(spark, queue_path), None
        if table_exists(spark, queue_path):
            if not known.exists():
                known.build(scan_queue(spark, queue_path))
            held = still_queued(known, staged, queue_path, batch)
        # Of the keys alone it shows whether payloads need to be compared at all.
        fresh = insert_if_absent(held, staged.select(*known.keys), known.keys).count()
        if not fresh:
            messages = messages.filter(F.lit(False))
        elif fresh < size:
            messages = insert_if_absent(held, messages, known.keys, ["id"])
        # Keys first: one without its message, left by an attempt that was broken off, is looked for and not found.
        known.append(staged, batch, size)
    append_queue(messages, queue_path, batch, True, True)
    remove(spark, folder)


def still_queued(known: KeyTable, rows: DataFrame, queue_path: str, batch: str) -> DataFrame | None:
    """The keys of ``rows`` that other batches have brought and the queue still has.

    The key table names those batches, and no others are read; none if no key is known, as for new messages.
    """
    found = known.held(rows).filter(F.col("batch") != batch)
    batches = [r[0] for r in found.select("batch").distinct().collect()]  # at most one for each row of the batch
    if not batches:
        return None
    stored = scan_batches(rows.sparkSession, queue_path, None if "" in batches else batches)
    return stored.select(*known.keys).join(found.select(*known.keys), known.keys, "left_semi").distinct()


def publish_stream(
    readings: DataFrame,
    queue_path: str,
    checkpoint: str,
    keys: list[str] | None = None,
    trigger: str = FLUSH_INTERVAL,
    available_now: bool = False,
    topic: str = TOPIC,
    partitions: int = VIRTUAL_PARTITIONS,
    at: Column | None = None,
) -> StreamingQuery:
    """Continuously put readings on the queue, a flush per trigger."""

    def flush(batch: DataFrame, batch_id: int) -> None:
        publish_batch(
            batch, queue_path, _batch_name(batch, batch_id), keys,
            f"{checkpoint.rstrip('/')}-staged", topic, partitions, at,
        )

    return _run(readings, flush, checkpoint, trigger, available_now)


def collect_batch(
    messages: DataFrame,
    telemetry_path: str,
    quarantine_path: str,
    batch: str,
    mode: str = "quarantine",
    at: Column | None = None,
) -> None:
    """Store a batch of messages; repeating it, or a part of it, adds nothing.

    A message id is stored once, whatever time it comes with. The table's key table is asked, of which only the
    buckets of the batch's ids are read; the table itself only for keys that a broken-off batch has left.
    """
    spark = messages.sparkSession
    # Read four times below: the payloads should be parsed once.
    rows = telemetry_rows(messages, mode).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        now = at if at is not None else F.current_timestamp()
        good = storable(rows).withColumn("ingested_at", now).select(*TELEMETRY_COLUMNS)
        # Fills the cache, so that Spark knows the size of the batch.
        size, fit = rows.agg(F.count(F.lit(1)), F.count_if(F.col("problem").isNull())).head()
        if size:
            known = telemetry_keys(spark, telemetry_path)
            if table_exists(spark, telemetry_path) and not known.exists():
                known.build(scan_telemetry(spark, telemetry_path))
            held = already_stored(known, good, telemetry_path) if known.exists() else None
            known.begin(batch)
            append_fresh(known, held, good, fit, batch, telemetry_path)
            known.end(batch)
        bad = quarantined(rows)
        if mode == "quarantine" and not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/batch={batch}")
    finally:
        rows.unpersist()


def append_fresh(known: KeyTable, held: DataFrame | None, good: DataFrame, fit: int, batch: str, telemetry_path: str) -> None:
    """Append the ``fit`` rows of ``good`` whose keys are not ``held``, one per key, their keys first.

    The number of new keys tells whether there is nothing to add, or no row that has to be left out; whole rows are
    compared only in between. Nothing here may be cached: writing keys makes Spark list the folders of cached plans again,
    and ``held`` would then have the batch's own keys.
    """
    new = insert_if_absent(held, good.select(*known.keys), known.keys)
    fresh = new.count()
    if not fresh and held is not None:
        return
    whole = fresh == fit
    known.append(good if whole else new, batch, fresh)
    append_telemetry(good if whole else insert_if_absent(held, good, known.keys, ["id"]), telemetry_path, None, True)


def already_stored(known: KeyTable, rows: DataFrame, telemetry_path: str) -> DataFrame | None:
    """The keys of ``rows`` that the table has, none if all are new. Keys of pending batches count only if the table has their rows."""
    found, pending = known.held(rows), known.pending()
    if found.isEmpty():
        return None
    if not pending:
        return found
    doubtful = found.filter(F.col("batch").isin(pending))
    sure = found.filter(~F.col("batch").isin(pending)).select(*known.keys)
    return sure.unionByName(matching_keys(scan_telemetry(rows.sparkSession, telemetry_path), doubtful, known.keys)).distinct()


def collect_stream(
    queue: DataFrame,
    telemetry_path: str,
    quarantine_path: str,
    checkpoint: str,
    trigger: str = "1 second",
    available_now: bool = False,
    mode: str = "quarantine",
    at: Column | None = None,
) -> StreamingQuery:
    """Continuously store queued messages.

    The checkpoint is the acknowledgement: a batch is done once it is stored, and a batch that
    fails is delivered again and de-duplicated.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        collect_batch(
            batch, telemetry_path, quarantine_path, _batch_name(batch, batch_id), mode, at
        )

    return _run(queue, store, checkpoint, trigger, available_now)


def stream_dedup(
    df: DataFrame, keys: list[str], horizon: str, time: str = "timestamp", salts: int = 16
) -> DataFrame:
    """Drop copies that arrive within ``horizon``; the state is bounded by it.

    Copies are first dropped per key and input task, so that a key with very many of them
    reaches the task that holds its state as at most ``salts`` rows. For copies of any
    age, insert into the sink if absent instead.
    """
    salted = df.withWatermark(time, horizon).withColumn(
        "_salt", F.pmod(F.spark_partition_id(), F.lit(salts))
    )
    fewer = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return fewer.dropDuplicatesWithinWatermark(keys)


def unacked_stream(
    sends: DataFrame,
    acks: DataFrame,
    timeout: str = "30 seconds",
    delay: str = "1 minute",
) -> DataFrame:
    """Deliveries (``lease_id``, ``sent_at``) without an ``acked_at`` within ``timeout``.

    A delivery is reported once both watermarks have passed its time-out. Repeated
    acknowledgements are dropped before they meet the deliveries.
    """
    sent = sends.withWatermark("sent_at", delay)
    once = stream_dedup(acks.select("lease_id", "acked_at"), ["lease_id", "acked_at"], delay, "acked_at")
    acked = once.withColumnRenamed("lease_id", "ack_id")
    in_time = (
        (F.col("lease_id") == F.col("ack_id"))
        & (F.col("acked_at") >= F.col("sent_at"))
        & (F.col("acked_at") <= F.col("sent_at") + F.expr(f"INTERVAL {timeout}"))
    )
    return sent.join(acked, in_time, "leftOuter").filter("ack_id IS NULL").drop("ack_id", "acked_at")
