"""Every operator as a query over the given tables, with the SQL that checks it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions import identity, payload, scalars
from gaugeline.operators import (
    collect,
    constraints,
    cursors,
    leases,
    merge,
    publish,
    queue,
    readings,
    upgrades,
)
from gaugeline.plans import adapters as A
from gaugeline.plans import flagship
from gaugeline.plans import sql as S
from gaugeline.schemas import ENTRY_COLUMNS, READING_COLUMNS, TELEMETRY_COLUMNS
from gaugeline.session import work_folder
from gaugeline.sources import csv_files, files, tables
from gaugeline.sources.gpu_days import GpuDays
from gaugeline.streaming import backlog, pipeline
from gaugeline.streaming import leases as lease_states

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WINDOW = ("2024-01-05T00:00:00Z", "2024-01-20T12:00:00Z")
IN_WINDOW = "\"timestamp\" BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'"
ENTRY_SQL = ", ".join(f'"{c}"' for c in ENTRY_COLUMNS)
TELEMETRY_SQL = ", ".join(f'"{c}"' for c in TELEMETRY_COLUMNS)
READING_SQL = ", ".join(f'"{c}"' for c in READING_COLUMNS)
SPLIT_DAY = dt.date(2024, 1, 10)
EARLY_SQL = "TIMESTAMP '2024-01-10 00:00:00'"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: A.plain_times(run(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


# --- The query surface -------------------------------------------------------------------


@query("list_gpus", S.with_(S.TELEMETRY, "SELECT DISTINCT uuid FROM telemetry WHERE uuid IS NOT NULL"))
def _(spark, sf_dir):
    return readings.list_gpus(A.telemetry(A.load(spark, sf_dir)))


@query("gpus_response", S.with_(S.TELEMETRY, """
    SELECT CAST(n // 7 AS BIGINT) AS page, CAST(n % 7 AS INTEGER) AS position, id FROM (
      SELECT uuid AS id, row_number() OVER (ORDER BY uuid) - 1 AS n
      FROM (SELECT DISTINCT uuid FROM telemetry WHERE uuid IS NOT NULL))"""))
def _(spark, sf_dir):
    """The GPU list in pages of seven, with the place of each GPU."""
    response = readings.gpus_response(A.telemetry(A.load(spark, sf_dir)), page_size=7)
    return response.select("page", F.posexplode("gpus").alias("position", "gpu")).select("page", "position", "gpu.id")


def _closed_days(spark: SparkSession, sf_dir: str) -> GpuDays:
    """A stored table whose days before a split are closed, then late readings of errors for some of these days."""
    events = A.load(spark, sf_dir)
    folder = work_folder(spark, "telemetry")
    late = (F.col("event_type") == "error") & (F.dayofmonth("ts") < 4)
    tables.append_telemetry(A.telemetry(events.filter(~late)), folder)
    days = GpuDays(spark, folder)
    days.close(SPLIT_DAY)
    tables.append_telemetry(A.telemetry(events.filter(late)), folder)
    return days


@query("gpus_by_day", S.with_(S.TELEMETRY, """
    SELECT uuid, count(*) AS readings, min("timestamp") AS first_at, max("timestamp") AS last_at
    FROM telemetry WHERE uuid IS NOT NULL GROUP BY uuid"""))
def _(spark, sf_dir):
    """Merged from summaries of closed days and readings of open ones and of those with late readings."""
    return _closed_days(spark, sf_dir).gpus()


@query("gpus_response_by_day", ORACLES["gpus_response"])
def _(spark, sf_dir):
    """The pages of gpus_response, from summaries by day."""
    response = readings.gpus_response(_closed_days(spark, sf_dir).gpus(), page_size=7)
    return response.select("page", F.posexplode("gpus").alias("position", "gpu")).select("page", "position", "gpu.id")


BUSIEST = "(SELECT uuid FROM telemetry GROUP BY uuid ORDER BY count(*) DESC, uuid LIMIT 1)"


@query("gpu_telemetry", S.with_(S.TELEMETRY, f"SELECT {ENTRY_SQL} FROM telemetry WHERE uuid = {BUSIEST}"))
def _(spark, sf_dir):
    events = A.load(spark, sf_dir)
    return readings.gpu_telemetry(A.telemetry(events), A.busiest_gpu(events))


@query(
    "gpu_telemetry_window",
    S.with_(S.TELEMETRY, f"SELECT {ENTRY_SQL} FROM telemetry WHERE uuid = {BUSIEST} AND {IN_WINDOW}"),
)
def _(spark, sf_dir):
    events = A.load(spark, sf_dir)
    return readings.gpu_telemetry(A.telemetry(events), A.busiest_gpu(events), *WINDOW)


@query("time_window", S.with_(S.TELEMETRY, f"SELECT {ENTRY_SQL} FROM telemetry WHERE {IN_WINDOW}"))
def _(spark, sf_dir):
    rows = A.telemetry(A.load(spark, sf_dir))
    return readings.in_time_window(rows, *readings.resolve_window(*WINDOW)).select(*ENTRY_COLUMNS)


@query(
    "telemetry_response",
    S.with_(S.TELEMETRY, f"""
    SELECT uuid AS requested, CAST(n // 20 AS BIGINT) AS page, CAST(n % 20 AS INTEGER) AS position, {ENTRY_SQL}
    FROM (SELECT *, row_number() OVER (PARTITION BY uuid ORDER BY "timestamp", id) - 1 AS n
          FROM telemetry WHERE {IN_WINDOW} AND uuid IS NOT NULL)
    UNION ALL
    SELECT g.uuid, 0, NULL, {", ".join("NULL" for _ in ENTRY_COLUMNS)}
    FROM (SELECT DISTINCT uuid FROM telemetry UNION SELECT 'GPU-none') g
    WHERE NOT EXISTS (SELECT 1 FROM telemetry t WHERE t.uuid = g.uuid AND {IN_WINDOW})"""),
)
def _(spark, sf_dir):
    """The whole response for every GPU and an unknown one, in pages of 20, with the place of each entry."""
    rows = A.telemetry(A.load(spark, sf_dir))
    unknown = spark.range(1).select(F.lit("GPU-none").alias("gpu_id"))
    asked = rows.select(F.col("uuid").alias("gpu_id")).distinct().unionByName(unknown)
    response = readings.telemetry_response(rows, asked, *WINDOW, page_size=20).withColumnRenamed("gpu_id", "requested")
    placed = response.select("requested", "page", F.posexplode_outer("entries").alias("position", "entry"))
    return placed.select("requested", "page", "position", "entry.*")


# --- Scalar functions --------------------------------------------------------------------

FNV_TEXTS = {"by_gpu": "gpu_id", "by_uuid": "uuid", "by_labels": "'é✓ ' || labels_raw"}


@query(
    "fnv1a_partition",
    S.with_(S.READINGS, "SELECT id, " + ", ".join(
        f"CAST({S.fnv(text)} % 256 AS INTEGER) AS {name}" for name, text in FNV_TEXTS.items()
    ) + " FROM readings"),
)
def _(spark, sf_dir):
    rows = A.readings(A.load(spark, sf_dir))
    return rows.select(
        "id", *[identity.fnv1a_partition(F.expr(t)).alias(n) for n, t in FNV_TEXTS.items()]
    )


# Number texts in all the forms found in files, the same text in both engines.
NUMBER_TEXTS = """
  CASE CAST(event_id % 12 AS INTEGER)
    WHEN 0 THEN CAST(cents AS {text}) WHEN 1 THEN '  ' || CAST(cents AS {text}) || ' '
    WHEN 2 THEN CAST(cents AS {text}) || 'e-2' WHEN 3 THEN '-.' || CAST(cents AS {text})
    WHEN 4 THEN '+' || CAST(cents AS {text}) || '.' WHEN 5 THEN CAST(cents AS {text}) || 'd'
    WHEN 6 THEN '' WHEN 7 THEN 'n/a' WHEN 8 THEN CAST(cents AS {text}) || 'E+3'
    WHEN 9 THEN '1_0' WHEN 10 THEN 'inf' ELSE 'NaN' END"""
CENTS = "CAST(round(value * 100) AS BIGINT)"


@query("parse_value", f"""
    WITH texts AS (
      SELECT event_id, {NUMBER_TEXTS.format(text='VARCHAR')} AS text
      FROM (SELECT event_id, {CENTS} AS cents FROM events)),
    read AS (
      SELECT event_id, CASE WHEN trim(text) IN ('inf', 'NaN') THEN trim(text) ELSE 'number' END AS kind,
             CASE WHEN regexp_full_match(trim(text), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')
                  THEN CAST(trim(text) AS DOUBLE) ELSE 0.0 END AS v
      FROM texts)
    SELECT event_id, kind, CASE WHEN kind = 'number' THEN CAST(v AS DOUBLE) END AS value FROM read""")
def _(spark, sf_dir):
    events = A.load(spark, sf_dir).withColumn("cents", F.expr(CENTS))
    value = scalars.parse_value(F.expr(NUMBER_TEXTS.format(text="STRING")))
    kind = F.when(F.isnan("v"), "NaN").when(F.col("v") == float("inf"), "inf").otherwise("number")
    return events.select("event_id", value.alias("v")).select(
        "event_id", kind.alias("kind"), F.when(kind == "number", F.col("v")).alias("value")
    )


# Time texts around the event's own time: accepted forms first, then refused ones.
TIME_TEXTS = """
  CASE CAST(event_id % 8 AS INTEGER)
    WHEN 0 THEN day || 'T' || clock || '.' || micros || 'Z'
    WHEN 1 THEN ' ' || day || 'T' || clock || ',' || micros || '789+05:30 '
    WHEN 2 THEN day || 'T' || clock || '-20:15' WHEN 3 THEN day || 'T' || clock || 'Z'
    WHEN 4 THEN day WHEN 5 THEN day || ' ' || clock WHEN 6 THEN day || 'T' || clock
    ELSE '2026-02-30T' || clock || 'Z' END"""


@query("parse_rfc3339", f"""
    WITH parts AS (
      SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M:%S') AS clock,
             strftime(ts, '%f') AS micros FROM events),
    texts AS (SELECT event_id, ts, micros, trim({TIME_TEXTS}) AS text FROM parts),
    read AS (
      SELECT event_id,
        CASE WHEN regexp_full_match(text, '[0-9-]{{10}}T[0-9:]{{8}}([.,][0-9]+)?(Z|[+-][0-9][0-9]:[0-9][0-9])')
                  AND text NOT LIKE '2026-02-30%'
             THEN CAST(replace(substr(text, 1, 19), 'T', ' ') AS TIMESTAMP)
                  + to_microseconds(CAST(coalesce(nullif(regexp_extract(text, '[.,]([0-9]{{6}})', 1), ''), '0') AS BIGINT))
                  - CASE WHEN text LIKE '%Z' THEN INTERVAL 0 MINUTE
                         ELSE to_minutes(CAST((CASE WHEN text[-6] = '-' THEN -1 ELSE 1 END)
                              * (60 * CAST(text[-5:-4] AS INTEGER) + CAST(text[-2:] AS INTEGER)) AS BIGINT)) END
        END AS t
      FROM texts)
    SELECT event_id, t AS parsed,
           coalesce(regexp_replace(regexp_replace(strftime(t, '%Y-%m-%dT%H:%M:%S.%f'),
                    '([.][0-9]*?)0+$', '\\1'), '[.]$', '') || 'Z', '') AS text
    FROM read""")
def _(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    events = A.load(spark, sf_dir).withColumns({
        "day": F.date_format(ts, "yyyy-MM-dd"), "clock": F.date_format(ts, "HH:mm:ss"),
        "micros": F.date_format(ts, "SSSSSS"),
    })
    parsed = events.select("event_id", scalars.parse_rfc3339(F.expr(TIME_TEXTS)).alias("parsed"))
    return parsed.withColumn("text", scalars.format_rfc3339nano(F.col("parsed")))


@query("format_float", """
    SELECT event_id, CAST(whole AS VARCHAR) AS whole_text,
           CAST(whole // 64 AS VARCHAR)
             || CASE WHEN whole % 64 = 0 THEN ''
                     ELSE rtrim('.' || lpad(CAST((whole % 64) * 15625 AS VARCHAR), 6, '0'), '0') END AS part_text
    FROM (SELECT event_id, CAST(round(value * 100) AS BIGINT) * 1048576 + event_id AS whole FROM events)""")
def _(spark, sf_dir):
    whole = F.expr("CAST(round(value * 100) AS BIGINT) * 1048576 + event_id")
    return A.load(spark, sf_dir).select("event_id", whole.alias("whole")).select(
        "event_id",
        scalars.format_float(F.col("whole").cast("double")).alias("whole_text"),
        scalars.format_float(F.col("whole").cast("double") / 64).alias("part_text"),
    )


@query("format_float_digits", """
    SELECT event_id, rtrim(ltrim(replace(regexp_replace(CAST(x AS VARCHAR), 'e.*$', ''), '.', ''), '0'), '0') AS digits
    FROM (SELECT event_id, abs(value) / 3 * pow(2.0, CAST(event_id % 800 - 400 AS DOUBLE)) AS x FROM events)""")
def _(spark, sf_dir):
    """The digits of numbers of many sizes that need 15 to 17 of them."""
    x = F.expr("abs(value) / 3 * pow(2D, CAST(event_id % 800 - 400 AS DOUBLE))")
    text = scalars.format_float(F.col("x"))
    return A.load(spark, sf_dir).select("event_id", x.alias("x")).select(
        "event_id", F.btrim(F.regexp_replace(text, r"\.", ""), F.lit("0")).alias("digits"))


@query("trim_fields", f"WITH {S.READINGS.strip()} SELECT id, {READING_SQL} FROM readings")
def _(spark, sf_dir):
    rows = A.readings(A.load(spark, sf_dir))
    padded = rows.withColumns({
        "device": F.concat(F.lit("\t "), F.col("device"), F.lit(" ")),
        "labels_raw": F.concat(F.lit(" "), F.col("labels_raw"), F.lit("\r\n")),
    })
    return scalars.trim_fields(padded)


@query("null_if_empty", S.with_(S.TELEMETRY, f"SELECT id, {READING_SQL} FROM telemetry"))
def _(spark, sf_dir):
    return scalars.null_if_empty(A.readings(A.load(spark, sf_dir)))


@query("default_value", """
    SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS value FROM events""")
def _(spark, sf_dir):
    rows = A.readings(A.load(spark, sf_dir)).select(
        "id", F.when(F.col("metric_name") != "error", F.col("value")).alias("value")
    )
    return scalars.default_value(rows)


@query("stamp_processed_at", S.with_(S.READINGS, """
    SELECT id, TIMESTAMP '2024-02-01 00:00:00' AS "timestamp", uuid, value FROM readings"""))
def _(spark, sf_dir):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    stamped = scalars.stamp_processed_at(A.readings(A.load(spark, sf_dir)), at)
    return stamped.select("id", "timestamp", "uuid", "value")


ID_FORMS = """
  CASE CAST(event_id % 6 AS INTEGER)
    WHEN 0 THEN m WHEN 1 THEN upper(m) WHEN 2 THEN 'URN:uuid:' || m WHEN 3 THEN '{' || m || '}'
    WHEN 4 THEN replace(m, '-', '') ELSE 'u' || substr(m, 2, 35) END"""


@query("canonical_uuid", f"""
    WITH ids AS (SELECT event_id, {S.message_id('event_id')} AS m FROM events)
    SELECT event_id, CASE WHEN event_id % 6 < 5 THEN m END AS msg_uuid FROM ids""")
def _(spark, sf_dir):
    ids = A.load(spark, sf_dir).withColumn("m", identity.keyed_uuid([F.col("event_id")]))
    return ids.select("event_id", identity.canonical_uuid(F.expr(ID_FORMS)).alias("msg_uuid"))


@query("msg_uuid", f"SELECT event_id, {S.message_id('event_id')} AS msg_uuid FROM events")
def _(spark, sf_dir):
    return identity.assign_msg_uuid(A.load(spark, sf_dir), ["event_id"]).select("event_id", "msg_uuid")


# --- Payloads and envelopes --------------------------------------------------------------


@query("msg_uuid_of_keys", f"""
    WITH k AS (SELECT event_id, 1 AS way, event_type || ':' || user_id AS a, CAST(event_id AS VARCHAR) AS b FROM events
               UNION ALL SELECT event_id, 2, event_type, user_id || ':' || event_id FROM events
               UNION ALL SELECT event_id, 3, event_type || '#', NULL FROM events)
    SELECT event_id, way, {S.message_id(S.key_list("a", "b"))} AS msg_uuid, count(*) OVER (PARTITION BY a, b) AS same FROM k""")
def _(spark, sf_dir):
    """Two keys that hold the separator: the same text when joined, but different ids."""
    events = A.load(spark, sf_dir)
    ways = [("concat(event_type, ':', user_id)", "cast(event_id as string)"), ("event_type", "concat(user_id, ':', event_id)"),
            ("concat(event_type, '#')", "cast(null as string)")]
    rows = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("way"), F.expr(a).alias("a"), F.expr(b).alias("b")) for i, (a, b) in enumerate(ways)]))
    made = identity.assign_msg_uuid(events.select("event_id", rows.alias("r")).select("event_id", "r.*"), ["a", "b"])
    same = made.groupBy("msg_uuid").agg(F.count("*").alias("same"))
    return made.join(same, "msg_uuid").select("event_id", "way", "msg_uuid", "same")


@query("payload_roundtrip", S.with_(S.READINGS, f"""
    SELECT id, gpu_id AS extracted, true AS parse_ok, {READING_SQL} FROM readings"""))
def _(spark, sf_dir):
    sent = payload.to_payload(A.readings(A.load(spark, sf_dir))).select("id", "payload")
    rows = sent.withColumn("extracted", payload.extract_gpu_id("payload"))
    return payload.parse_payload(rows).select("id", "extracted", "parse_ok", *READING_COLUMNS)


# Payloads of other writers: key case, missing, repeated, null and mistyped members.
FOREIGN = """
  CASE CAST(id % 8 AS INTEGER)
    WHEN 0 THEN '{"UUID": "' || uuid || '", "Gpu_Id": "' || gpu_id || '", "VALUE": 2.5e1}'
    WHEN 1 THEN '{"uuid": "x", "uuid": "' || uuid || '", "uuid": null, "value": 3}'
    WHEN 2 THEN '{"uuid": "' || uuid || '", "extra": {"a": [1, {"b": 2}]}}'
    WHEN 3 THEN '{"uuid": "' || uuid || '", "gpu_id": 3}'
    WHEN 4 THEN '{"uuid": "' || uuid || '", "value": "3"}'
    WHEN 5 THEN '{"uuid": "' || uuid || '", "timestamp": "yesterday"}'
    WHEN 6 THEN '["' || uuid || '"]'
    ELSE '{"uuid": "' || uuid || '"} {' END"""


@query("payload_foreign", S.with_(S.READINGS, """
    SELECT id, id % 8 < 3 AS parse_ok, CASE WHEN id % 8 < 3 THEN uuid END AS uuid,
           CASE WHEN id % 8 = 0 THEN gpu_id WHEN id % 8 < 3 THEN '' END AS gpu_id,
           CASE CAST(id % 8 AS INTEGER) WHEN 0 THEN 25.0 WHEN 1 THEN 3.0 WHEN 2 THEN 0.0 END::DOUBLE AS value,
           CASE CAST(id % 8 AS INTEGER) WHEN 0 THEN gpu_id WHEN 3 THEN NULL WHEN 6 THEN NULL
                WHEN 7 THEN NULL ELSE '' END AS extracted
    FROM readings"""))
def _(spark, sf_dir):
    rows = A.readings(A.load(spark, sf_dir)).select("id", F.expr(FOREIGN).alias("payload"))
    rows = rows.withColumn("extracted", payload.extract_gpu_id("payload"))
    parsed = payload.parse_payload(rows)
    ok = F.col("parse_ok")
    return parsed.select(
        "id", "parse_ok", *[F.when(ok, F.col(c)).alias(c) for c in ("uuid", "gpu_id", "value")],
        "extracted",
    )


@query("publish_validate", S.with_(S.REQUESTS, "SELECT request_id, topic, n, error FROM validated"))
def _(spark, sf_dir):
    checked = publish.validate_publish(A.requests(A.load(spark, sf_dir)))
    return checked.select("request_id", "topic", F.size("messages").cast("bigint").alias("n"), "error")


@query("publish_explode", S.with_(S.REQUESTS, 'SELECT request_id, topic, "index" FROM judged JOIN requests USING (request_id)'))
def _(spark, sf_dir):
    rows = publish.explode_publish(A.requests(A.load(spark, sf_dir)))
    return rows.select("request_id", "topic", F.col("index").cast("bigint").alias("index"))


@query("publish_messages", S.with_(S.REQUESTS, f"""
    SELECT request_id, v.topic, "index", gpu_id,
           {S.message_id(S.key_list("request_id", '"index"'))} AS msg_uuid, p.partition_key
    FROM judged j JOIN validated v USING (request_id)
    JOIN (SELECT gpu_id, CAST({S.fnv('gpu_id')} % 256 AS INTEGER) AS partition_key
          FROM (SELECT DISTINCT gpu_id FROM readings)) p USING (gpu_id)
    WHERE v.error IS NULL"""))
def _(spark, sf_dir):
    rows = publish.publish_messages(A.requests(A.load(spark, sf_dir)))
    return rows.select(
        "request_id", "topic", F.col("index").cast("bigint").alias("index"), "gpu_id", "msg_uuid",
        "partition_key",
    )


# Bodies that are not what a careful sender writes, by the last digits of the request's number: text, error, number of messages.
ODD_BODIES = {
    1: ("concat('{\"topic\": 3, \"messages\": ', list, '}')", "'invalid JSON'", "NULL"),
    2: ("concat('{\"Messages\": ', list, ', \"TOPIC\": \"t\"}')", "bad", "n"),
    3: ("'nope'", "'invalid JSON'", "NULL"),
    4: ("concat('[', list, ']')", "'invalid JSON'", "NULL"),
    5: ("'{\"topic\": \"t\", \"messages\": {}}'", "'invalid JSON'", "NULL"),
    6: ("'{\"topic\": \"t\", \"messages\": \"x\"}'", "'invalid JSON'", "NULL"),
    7: ("concat('{\"topic\": \"t\", \"messages\": ', list, '} and more')", "bad", "n"),
    8: ("concat('{\"topic\": \"t\", \"messages\": ', list, ', \"messages\": null}')", "'messages must not be empty'", "NULL"),
    9: ("concat('{\"topic\": \"t\", \"messages\": ', list)", "'invalid JSON'", "NULL"),
    10: ("concat('{\"topic\": \"\", \"topic\": \"t\", \"topic\": null, \"messages\": ', list, '}')", "bad", "n"),
    11: ("' null '", "'topic is required'", "NULL"),
}
ODD = 17


def _by_digits(column: int, other: str) -> str:
    return "CASE " + " ".join(f"WHEN request_id % {ODD} = {k} THEN {v[column]}" for k, v in ODD_BODIES.items()) + f" ELSE {other} END"


@query("publish_body", S.with_(S.REQUESTS, f"""
    SELECT v.request_id, {_by_digits(1, "error")} AS error, CAST({_by_digits(2, "n")} AS BIGINT) AS n
    FROM (SELECT v.request_id, v.error, v.n, r.bad FROM validated v JOIN requests r USING (request_id)) v"""))
def _(spark, sf_dir):
    """The same requests as raw bodies, some of them odd or not readable."""
    rows = A.requests(A.load(spark, sf_dir)).withColumn(
        "list", F.concat(F.lit("["), F.array_join("messages", ", "), F.lit("]")))
    usual = "concat('{\"topic\": \"', topic, '\", \"messages\": ', list, '}')"
    parsed = payload.parse_publish_body(rows.select("request_id", F.expr(_by_digits(0, usual)).alias("body")))
    checked = publish.validate_publish(parsed)
    n = F.when(F.col("messages").isNotNull(), F.size("messages").cast("bigint"))
    return checked.select("request_id", "error", n.alias("n"))


# --- Publishing --------------------------------------------------------------------------


@query("publish_dedup", S.with_(S.QUEUE, f"""
    SELECT id, topic, msg_uuid, created_at, partition_key FROM queue WHERE "timestamp" >= {EARLY_SQL}"""))
def _(spark, sf_dir):
    """All messages, some twice, into a queue that holds the early ones."""
    events = A.load(spark, sf_dir)
    held = A.queue_keys(events.filter(A.is_early()))
    new = merge.insert_if_absent(held, A.queue(A.redelivered(events)), ["topic", "msg_uuid"], ["id"])
    return new.select("id", "topic", "msg_uuid", "created_at", "partition_key")


@query("dedup_first", S.with_(S.READINGS, """
    SELECT metric_name, uuid, id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY metric_name, uuid ORDER BY "timestamp", id) AS nth
      FROM readings) WHERE nth = 1"""))
def _(spark, sf_dir):
    rows = A.readings(A.load(spark, sf_dir))
    first = merge.dedup_first(rows, ["metric_name", "uuid"], ["timestamp", "id"])
    return first.select("metric_name", "uuid", "id", "value")


@query("publish_counts", f"""
    SELECT event_type AS topic, count(*) FILTER (WHERE ts >= {EARLY_SQL}) AS accepted,
           count(*) FILTER (WHERE ts < {EARLY_SQL}) + CASE WHEN event_type = 'error' THEN count(*) ELSE 0 END AS duplicates
    FROM events GROUP BY event_type""")
def _(spark, sf_dir):
    events = A.load(spark, sf_dir)

    def by_type(rows):
        keyed = identity.assign_msg_uuid(A.readings(rows), ["id"])
        return keyed.select(F.col("metric_name").alias("topic"), "msg_uuid")

    return publish.publish_counts(by_type(events.filter(A.is_early())), by_type(A.redelivered(events)))


@query("group_by_topic", S.with_(S.REQUESTS, """
    SELECT topic, count(*) AS requests, CAST(sum(n) AS BIGINT) AS messages FROM requests GROUP BY topic"""))
def _(spark, sf_dir):
    return publish.group_by_topic(A.requests(A.load(spark, sf_dir)))


@query("publish_apportion", """
    WITH requests AS (
      SELECT event_id AS request_id, CAST(ts AS DATE) AS flush_id, event_type AS topic,
             1 + CAST(round(value * 100) AS BIGINT) % 5 AS n FROM events),
    sized AS (
      SELECT *, sum(n) OVER (PARTITION BY flush_id, topic) AS total,
             max(request_id) OVER (PARTITION BY flush_id, topic) AS last FROM requests),
    shares AS (
      SELECT *, (total * 7) // 10 AS acc, total - (total * 7) // 10 AS dup,
             ((total * 7) // 10) * n // total AS a, (total - (total * 7) // 10) * n // total AS d FROM sized)
    SELECT request_id, flush_id, topic, n,
           CAST(CASE WHEN request_id = last
                THEN acc - (sum(a) OVER (PARTITION BY flush_id, topic) - a) ELSE a END AS BIGINT) AS accepted,
           CAST(CASE WHEN request_id = last
                THEN dup - (sum(d) OVER (PARTITION BY flush_id, topic) - d) ELSE d END AS BIGINT) AS duplicates
    FROM shares""")
def _(spark, sf_dir):
    requests = A.load(spark, sf_dir).select(
        F.col("event_id").alias("request_id"), F.to_date("ts").alias("flush_id"),
        F.col("event_type").alias("topic"), F.expr(f"1 + {CENTS} % 5").alias("n"),
    )
    totals = requests.groupBy("flush_id", "topic").agg(F.sum("n").alias("total")).select(
        "flush_id", "topic", F.expr("total * 7 div 10").alias("accepted"),
        F.expr("total - total * 7 div 10").alias("duplicates"),
    )
    return publish.apportion(requests, totals)


# --- Collecting --------------------------------------------------------------------------


@query("persist_telemetry", S.with_(S.TELEMETRY, f"""
    SELECT {TELEMETRY_SQL} FROM telemetry WHERE "timestamp" >= {EARLY_SQL}""".replace(
        '"ingested_at"', "TIMESTAMP '2024-02-01 00:00:00' AS ingested_at")))
def _(spark, sf_dir):
    """Queued messages, some twice, into a telemetry table that holds the early ones."""
    events = A.load(spark, sf_dir)
    held = A.telemetry(events.filter(A.is_early()))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return collect.persist_telemetry(held, A.queue(A.redelivered(events)), at)


def leased_rows(events: DataFrame) -> DataFrame:
    """Message keys with their lease."""
    batches = queue.lease_batches(A.owned(events))
    return batches.select(
        "id", "msg_uuid", F.concat_ws("-", F.lit("lease"), "owner", "batch").alias("lease_id")
    )


@query("persist_counts", S.with_(S.OWNED, f"""
    SELECT 'lease-' || owner || '-' || batch AS lease_id,
           count(*) FILTER (WHERE b."timestamp" >= {EARLY_SQL}) AS persisted,
           count(*) FILTER (WHERE b."timestamp" < {EARLY_SQL})
             + count(*) FILTER (WHERE r.metric_name = 'error') AS duplicates
    FROM batches b JOIN readings r USING (id) GROUP BY owner, batch"""))
def _(spark, sf_dir):
    events = A.load(spark, sf_dir)
    leased = leased_rows(events)
    errors = events.filter("event_type = 'error'").select(F.col("event_id").alias("id"))
    twice = leased.unionByName(leased.join(errors, "id", "left_semi"))
    held = A.queue_keys(events.filter(A.is_early()))
    return collect.persist_counts(held, twice)


BROKEN = "CASE WHEN metric_name = 'error' OR uuid < 'GPU-000010' THEN '{\"gpu_id\": 1}' ELSE payload END"


@query("lease_outcome", S.with_(S.READINGS, """
    SELECT hostname AS lease_id,
           CASE WHEN bool_or(ok) THEN 'persist' ELSE 'skip' END AS outcome, bool_or(ok) AS acked,
           count(*) FILTER (WHERE ok) AS persistable, count(*) FILTER (WHERE NOT ok) AS quarantined
    FROM (SELECT hostname, NOT (metric_name = 'error' OR uuid < 'GPU-000010') AS ok FROM readings)
    GROUP BY hostname"""))
def _(spark, sf_dir):
    """A lease per host; some messages, and on one host all of them, cannot be read."""
    sent = payload.to_payload(A.readings(A.load(spark, sf_dir)))
    messages = sent.select(F.col("hostname").alias("lease_id"), F.expr(BROKEN).alias("payload"))
    return collect.lease_outcome(payload.parse_payload(messages))


@query("lease_outcome_refused", S.with_(S.READINGS, """
    SELECT hostname AS lease_id,
           CASE WHEN bool_or(refused) THEN 'fail' WHEN bool_or(ok) THEN 'persist' ELSE 'skip' END AS outcome,
           bool_or(ok) AND NOT bool_or(refused) AS acked,
           CASE WHEN bool_or(refused) THEN 0 ELSE count(*) FILTER (WHERE ok) END AS persistable,
           count(*) FILTER (WHERE NOT ok) AS quarantined
    FROM (SELECT hostname, ok, ok AND metric_name = 'view' AND uuid > 'GPU-000700' AS refused
          FROM (SELECT *, NOT (metric_name = 'error' OR uuid < 'GPU-000010') AS ok FROM readings))
    GROUP BY hostname"""))
def _(spark, sf_dir):
    """The same leases; some readable messages have ids that the table refuses."""
    sent = identity.assign_msg_uuid(payload.to_payload(A.readings(A.load(spark, sf_dir))), ["id"])
    bad_id = F.when(F.expr("metric_name = 'view' AND uuid > 'GPU-000700'"), "u1").otherwise(F.col("msg_uuid"))
    messages = sent.select(
        "id", F.col("hostname").alias("lease_id"), bad_id.alias("msg_uuid"), F.expr(BROKEN).alias("payload")
    )
    return collect.lease_outcome(collect.telemetry_rows(messages))


@query("quarantine", S.with_(S.READINGS, f"""
    SELECT id, CASE WHEN metric_name = 'error' OR uuid < 'GPU-000010' THEN 'payload cannot be read'
                    ELSE 'msg_uuid is not a UUID' END AS problem
    FROM readings WHERE metric_name IN ('error', 'view') OR uuid < 'GPU-000010'"""))
def _(spark, sf_dir):
    sent = identity.assign_msg_uuid(payload.to_payload(A.readings(A.load(spark, sf_dir))), ["id"])
    bad_id = F.when(F.col("metric_name") == "view", "u1").otherwise(F.col("msg_uuid"))
    messages = sent.select("id", bad_id.alias("msg_uuid"), F.expr(BROKEN).alias("payload"))
    return collect.quarantined(collect.telemetry_rows(messages)).select("id", "problem")


# --- The queue ---------------------------------------------------------------------------


def ranges_of(spark: SparkSession) -> DataFrame:
    return queue.partition_ranges(spark, A.OWNERS)


@query("partition_ranges", S.with_(S.QUEUE, """
    SELECT r.owner, r."start", r."end", r."start" || '-' || r."end" AS range_text, count(q.id) AS messages
    FROM (SELECT CAST(i AS INTEGER) AS owner, CAST(i * 85 AS INTEGER) AS "start",
                 CAST(CASE WHEN i = 2 THEN 255 ELSE i * 85 + 84 END AS INTEGER) AS "end" FROM range(3) t(i)) r
    LEFT JOIN queue q ON q.partition_key BETWEEN r."start" AND r."end"
    GROUP BY ALL"""))
def _(spark, sf_dir):
    """Three owners' ranges, through their text form, with the messages each one has."""
    made = queue.partition_ranges(spark, 3).withColumn("range_text", F.concat_ws("-", "start", "end"))
    read = made.select("owner", "range_text", scalars.parse_range(F.col("range_text"), 0, 255).alias("r"))
    ranges = read.select(
        "owner", F.col("r.start").cast("int").alias("start"), F.col("r.end").cast("int").alias("end"),
        "range_text",
    )
    owned = queue.assign_owner(A.queue_keys(A.load(spark, sf_dir)).select("partition_key"), ranges)
    counted = owned.groupBy("owner").agg(F.count(F.lit(1)).alias("messages"))
    return ranges.join(counted, "owner", "left").withColumn(
        "messages", F.coalesce("messages", F.lit(0).cast("bigint"))
    )


@query("partition_owner", S.with_(S.OWNED, "SELECT id, partition_key, CAST(owner AS INTEGER) AS owner, CAST(owner AS INTEGER) AS computed FROM owned"))
def _(spark, sf_dir):
    rows = A.queue_keys(A.load(spark, sf_dir)).select("id", "partition_key")
    return queue.assign_owner(rows, ranges_of(spark)).withColumn(
        "computed", queue.owner_of(F.col("partition_key"), A.OWNERS)
    )


@query("partition_range_filter", S.with_(S.QUEUE, "SELECT id, partition_key FROM queue WHERE partition_key BETWEEN 64 AND 191"))
def _(spark, sf_dir):
    rows = A.queue_keys(A.load(spark, sf_dir)).select("id", "partition_key")
    return queue.in_partition_range(rows, 64, 191)


def parsed_message(df: DataFrame) -> DataFrame:
    """Payload texts differ between engines in spelling only: compare what they say."""
    parsed = payload.parse_payload(df)
    others = [c for c in df.columns if c != "payload"]
    return parsed.select(*others, "uuid", "value")


@query("fetch_batch", S.with_(S.QUEUE, """
    SELECT id, topic, msg_uuid, uuid, value FROM queue WHERE partition_key BETWEEN 64 AND 191
    ORDER BY id LIMIT 1000"""))
def _(spark, sf_dir):
    return parsed_message(queue.fetch_batch(A.queue(A.load(spark, sf_dir)), 64, 191))


@query("fetch_batch_per_owner", S.with_(S.OWNED, """
    SELECT CAST(owner AS INTEGER) AS owner, id, topic, msg_uuid FROM (
      SELECT *, row_number() OVER (PARTITION BY owner ORDER BY id) AS nth FROM owned) WHERE nth <= 200"""))
def _(spark, sf_dir):
    fetched = queue.fetch_batch_per_owner(A.queue(A.load(spark, sf_dir)), ranges_of(spark), 200)
    return fetched.select("owner", "id", "topic", "msg_uuid")


@query("fetch_after_cursor", S.with_(S.OWNED, """
    SELECT CAST(owner AS INTEGER) AS owner, id, topic, msg_uuid FROM (
      SELECT *, row_number() OVER (PARTITION BY owner ORDER BY id) AS nth
      FROM (SELECT *, max(id) OVER () // 8 AS step FROM owned) WHERE owner = 3 OR id > (owner + 1) * step) WHERE nth <= 200"""))
def _(spark, sf_dir):
    """A stored queue of eight flushes; of four owners three have stored cursors, each one further on."""
    stored, marks = work_folder(spark, "queue"), work_folder(spark, "cursors")
    rows = A.queue(A.load(spark, sf_dir))
    step = rows.agg(F.max("id")).head()[0] // 8
    for flush in range(8):
        last = 1 << 60 if flush == 7 else (flush + 1) * step
        tables.append_queue(rows.filter((F.col("id") > flush * step - (flush == 0)) & (F.col("id") <= last)).coalesce(1), stored, f"flush-{flush}")
    for ahead in (1, 0):  # the second, lower marks change nothing
        cursors.save_cursors(spark.createDataFrame([(o, (o + ahead) * step) for o in range(3)], cursors.CURSORS), marks)
    return cursors.fetch_after_cursor(
        tables.scan_queue(spark, stored), ranges_of(spark), cursors.read_cursors(spark, marks), 200).select("owner", "id", "topic", "msg_uuid")


@query("lease_batches", S.with_(S.OWNED, "SELECT id, CAST(owner AS INTEGER) AS owner, batch FROM batches"))
def _(spark, sf_dir):
    return queue.lease_batches(A.owned(A.load(spark, sf_dir))).select("id", "owner", "batch")


@query("lease_table", S.with_(S.LEASES, """
    SELECT lease_id, len(ids) AS n, array_to_string(ids, ',') AS ids, served_at, lease_seconds FROM leases"""))
def _(spark, sf_dir):
    return A.leases(A.load(spark, sf_dir)).select(
        "lease_id", F.size("ids").cast("bigint").alias("n"),
        F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"), "served_at", "lease_seconds",
    )


@query("exclude_outstanding", S.with_(S.LEASES, """
    SELECT id, topic, msg_uuid FROM (
      SELECT id, topic, msg_uuid FROM queue WHERE partition_key BETWEEN 0 AND 255 ORDER BY id LIMIT 1000)
    WHERE id NOT IN (
      SELECT unnest(ids) FROM leases l LEFT JOIN acks a USING (lease_id),
             (SELECT min(served_at) + INTERVAL 5 SECOND AS now FROM leases) c
      WHERE l.served_at <= c.now AND c.now - l.served_at <= INTERVAL 30 SECOND
        AND (a.acked_at IS NULL OR a.acked_at > c.now OR a.acked_at - l.served_at > INTERVAL 30 SECOND))"""))
def _(spark, sf_dir):
    """A fetch while the first lease is out."""
    events = A.load(spark, sf_dir)
    granted = A.leases(events)
    outstanding = leases.outstanding_leases(granted, A.acks(granted), A.after_first_lease(granted))
    batch = queue.fetch_batch(A.queue(events), 0, 255).drop("payload")
    return queue.exclude_outstanding(batch, outstanding)


def acked_ids(granted: DataFrame, acked: DataFrame) -> DataFrame:
    done = leases.effective_acks(granted, acked).select("lease_id")
    return granted.join(done, "lease_id").select(F.explode("ids").alias("id"))


DONE = """,
done AS (
  SELECT unnest(l.ids) AS id FROM leases l JOIN acks a USING (lease_id)
  WHERE a.acked_at - l.served_at <= INTERVAL 30 SECOND)"""


@query("delete_acked", S.with_(S.LEASES + DONE, "SELECT id, topic, msg_uuid, partition_key FROM queue WHERE id NOT IN (SELECT id FROM done)"))
def _(spark, sf_dir):
    events = A.load(spark, sf_dir)
    granted = A.leases(events)
    kept = queue.delete_acked(A.queue_keys(events), acked_ids(granted, A.acks(granted)))
    return kept.select("id", "topic", "msg_uuid", "partition_key")


@query("queue_after_delete", S.with_(S.LEASES + DONE, "SELECT id, topic, msg_uuid, partition_key FROM queue WHERE id NOT IN (SELECT id FROM done)"))
def _(spark, sf_dir):
    """Acknowledged messages deleted from a stored queue; a flush that is sent again afterwards adds nothing."""
    events = A.load(spark, sf_dir)
    rows, granted = A.readings(events), A.leases(events)
    folder = work_folder(spark, "queue")
    for half in (0, 1):
        pipeline.publish_batch(rows.filter(F.col("id") % 2 == half), folder, f"flush-{half}", keys=["id"])
    tables.delete_from_queue(spark, folder, acked_ids(granted, A.acks(granted)))
    pipeline.publish_batch(rows.filter("id % 2 = 0"), folder, "flush-0", keys=["id"])
    return tables.scan_queue(spark, folder).select("id", "topic", "msg_uuid", "partition_key")


@query("deleted_count", S.with_(S.LEASES + DONE, "SELECT count(*) AS deleted_count FROM done"))
def _(spark, sf_dir):
    events = A.load(spark, sf_dir)
    granted = A.leases(events)
    return queue.deleted_count(A.queue_keys(events), acked_ids(granted, A.acks(granted)))


@query("backlog_utilization", S.with_(S.OWNED, """
    SELECT CAST(o.i AS INTEGER) AS owner, count(q.id) AS backlog, least(count(q.id), 5000) / 5000.0::DOUBLE AS utilization
    FROM range(4) o(i) LEFT JOIN owned q ON q.owner = o.i GROUP BY o.i"""))
def _(spark, sf_dir):
    return queue.backlog_utilization(A.queue_keys(A.load(spark, sf_dir)), ranges_of(spark), 5000)


# --- Delivery state ----------------------------------------------------------------------


def delivery(spark: SparkSession, sf_dir: str):
    events = A.load(spark, sf_dir)
    granted = A.leases(events)
    return events, granted, A.acks(granted)


@query("effective_acks", S.with_(S.LEASES, """
    SELECT lease_id, acked_at, len(ids) AS acked FROM leases JOIN acks USING (lease_id)
    WHERE acked_at - served_at <= INTERVAL 30 SECOND"""))
def _(spark, sf_dir):
    _, granted, acked = delivery(spark, sf_dir)
    return leases.effective_acks(granted, acked)


@query("acked_count", S.with_(S.LEASES, """
    SELECT lease_id, acked_at, count(*) AS replies,
           coalesce(any_value(n) FILTER (WHERE nth = 1 AND held <= INTERVAL 30 SECOND), 0) AS acked
    FROM (SELECT a.lease_id, a.acked_at, a.acked_at - l.served_at AS held, len(l.ids) AS n,
                 rank() OVER (PARTITION BY a.lease_id ORDER BY a.acked_at) AS nth
          FROM (SELECT * FROM acks UNION ALL SELECT * FROM acks
                UNION ALL SELECT lease_id, acked_at + INTERVAL 1 SECOND FROM acks
                UNION ALL SELECT 'no-' || lease_id, acked_at FROM acks) a LEFT JOIN leases l USING (lease_id))
    GROUP BY lease_id, acked_at"""))
def _(spark, sf_dir):
    """Each acknowledgement twice, once more a second later, and for an unknown lease."""
    _, granted, acked = delivery(spark, sf_dir)
    later = acked.withColumn("acked_at", F.col("acked_at") + F.expr("INTERVAL 1 SECOND"))
    unknown = acked.withColumn("lease_id", F.concat(F.lit("no-"), F.col("lease_id")))
    arrived = acked.unionByName(acked).unionByName(later).unionByName(unknown)
    return leases.acked_count(granted, arrived)


@query("expired_leases", S.with_(S.STATES, """
    SELECT lease_id, served_at, len(ids) AS n FROM status WHERE status = 'expired'"""))
def _(spark, sf_dir):
    _, granted, acked = delivery(spark, sf_dir)
    expired = leases.expired_leases(granted, acked, A.as_of(granted))
    return expired.select("lease_id", "served_at", F.size("ids").cast("bigint").alias("n"))


@query("message_state", S.with_(S.STATES, "SELECT id, state, served FROM states"))
def _(spark, sf_dir):
    events, granted, acked = delivery(spark, sf_dir)
    return leases.message_state(A.queue_keys(events), granted, acked, A.as_of(granted))


@query("redelivery", S.with_(S.STATES, """
    SELECT s.id, q.msg_uuid, q.partition_key, s.served FROM states s JOIN queue q USING (id)
    WHERE s.state = 'ready' AND s.served > 0"""))
def _(spark, sf_dir):
    events, granted, acked = delivery(spark, sf_dir)
    again = leases.redelivery(A.queue_keys(events), granted, acked, A.as_of(granted))
    return again.select("id", "msg_uuid", "partition_key", "served")


# --- Table versions ----------------------------------------------------------------------

TELEMETRY_V1 = ["id", "uuid", "gpu_id", "metric_name", "timestamp", "model_name", "container",
                "pod", "namespace", "value", "labels_raw", "ingested_at"]


@query("upgrade_telemetry", S.with_(S.TELEMETRY, f"""
    SELECT {", ".join(f'"{c}"' for c in TELEMETRY_V1 if c != "uuid")}, msg_uuid AS uuid, msg_uuid,
           CAST(NULL AS VARCHAR) AS device, CAST(NULL AS VARCHAR) AS hostname FROM telemetry"""))
def _(spark, sf_dir):
    """A version 1 table, whose uuid was the message id."""
    rows = A.telemetry(A.load(spark, sf_dir))
    old = rows.withColumn("uuid", F.col("msg_uuid")).select(*TELEMETRY_V1)
    return upgrades.upgrade_telemetry(old, from_version=1)


@query("downgrade_telemetry", S.with_(S.TELEMETRY, f"""
    SELECT {", ".join(f'"{c}"' for c in TELEMETRY_V1 if c != "uuid")}, msg_uuid AS uuid FROM telemetry"""))
def _(spark, sf_dir):
    rows = A.telemetry(A.load(spark, sf_dir)).withColumn("uuid", F.upper("msg_uuid"))
    return upgrades.downgrade_telemetry(rows, from_version=7, to_version=1)


def queue_v1(events: DataFrame) -> DataFrame:
    return A.queue(events).drop("partition_key").withColumns({
        "state": F.when(F.col("id") % 2 == 0, "ready").otherwise("in_flight"),
        "leased_by": F.lit("c1"), "lease_id": F.col("msg_uuid"), "lease_until": F.col("created_at"),
        "attempts": F.lit(1), "updated_at": F.col("created_at"),
    })


@query("upgrade_queue", S.with_(S.QUEUE, "SELECT id, topic, msg_uuid, created_at, uuid, value, 0 AS partition_key FROM queue"))
def _(spark, sf_dir):
    return parsed_message(upgrades.upgrade_queue(queue_v1(A.load(spark, sf_dir)), from_version=1))


@query("upgrade_queue_rehash", S.with_(S.QUEUE, "SELECT id, topic, msg_uuid, created_at, partition_key FROM queue"))
def _(spark, sf_dir):
    new = upgrades.upgrade_queue(queue_v1(A.load(spark, sf_dir)), from_version=1, rehash=True)
    return new.drop("payload")


@query("downgrade_queue", S.with_(S.QUEUE, """
    SELECT id, topic, msg_uuid, created_at, 'ready' AS state, CAST(NULL AS VARCHAR) AS leased_by,
           CAST(NULL AS VARCHAR) AS lease_id, CAST(NULL AS TIMESTAMP) AS lease_until, 0 AS attempts,
           created_at AS updated_at FROM queue"""))
def _(spark, sf_dir):
    old = upgrades.downgrade_queue(A.queue(A.load(spark, sf_dir)), 7, 1, F.col("created_at"))
    return old.drop("payload")


@query("constraint_report", S.with_(S.TELEMETRY, """
    SELECT "constraint", violations FROM (
      SELECT unnest(['not_null(id)', 'not_null(uuid)', 'not_null(msg_uuid)', 'not_null(gpu_id)',
                     'not_null(metric_name)', 'not_null(timestamp)', 'not_null(ingested_at)',
                     'check(value)', 'unique(id)', 'unique(msg_uuid)']) AS "constraint",
             unnest([0, n_error, 0, 0, 0, 0, 0, n_big, n_error, n_error]) AS violations
      FROM (SELECT count(*) FILTER (WHERE metric_name = 'error') AS n_error,
                   count(*) FILTER (WHERE value > 100) + count(*) FILTER (WHERE value > 100 AND metric_name = 'error') AS n_big
            FROM telemetry))"""))
def _(spark, sf_dir):
    """Error rows are there twice, the copy without uuid."""
    rows = A.telemetry(A.load(spark, sf_dir))
    copies = rows.filter("metric_name = 'error'").withColumn("uuid", F.lit(None).cast("string"))
    return constraints.constraint_report(
        rows.unionByName(copies), check={"value": "value <= 100"}, **constraints.TELEMETRY_RULES
    )


@query("constraint_report_queue", """
    WITH q AS (SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'lost'
                                           ELSE 'ready' END AS state FROM events),
    twice AS (SELECT * FROM q UNION ALL SELECT * FROM q WHERE id % 11 = 0)
    SELECT "constraint", violations FROM (
      SELECT unnest(['not_null(id)', 'not_null(topic)', 'not_null(msg_uuid)', 'not_null(payload)', 'not_null(state)',
                     'not_null(attempts)', 'not_null(created_at)', 'not_null(updated_at)', 'check(state)',
                     'unique(id)', 'unique(topic, msg_uuid)']) AS "constraint",
             unnest([0, 0, 0, 0, n_null, 0, 0, 0, n_lost, n_copy, n_copy]) AS violations
      FROM (SELECT count(*) FILTER (WHERE state IS NULL) AS n_null, count(*) FILTER (WHERE state = 'lost') AS n_lost,
                   count(*) FILTER (WHERE id % 11 = 0) // 2 AS n_copy FROM twice))""")
def _(spark, sf_dir):
    """A version 1 queue with unknown and missing states, and some rows twice."""
    state = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 5 == 0, "lost").otherwise("ready")
    rows = queue_v1(A.load(spark, sf_dir)).withColumn("state", state)
    twice = rows.unionByName(rows.filter("id % 11 = 0"))
    return constraints.constraint_report(twice, **constraints.QUEUE_V1_RULES)


@query("telemetry_pipeline", S.with_(S.TELEMETRY, f"""
    SELECT {TELEMETRY_SQL} FROM telemetry""".replace(
        '"ingested_at"', "TIMESTAMP '2024-02-01 00:00:00' AS ingested_at")))
def _(spark, sf_dir):
    """Readings, some delivered twice, through the queue into an empty telemetry table."""
    return flagship.end_to_end(A.load(spark, sf_dir))


# --- Files and streams -------------------------------------------------------------------


def _events_folder(sf_dir: str) -> str:
    # A pattern, because a streaming source takes a single file only through one.
    return f"{sf_dir.rstrip('/')}/events.parque[t]"


@query("csv_roundtrip", S.with_(S.READINGS, f"SELECT {READING_SQL} FROM readings"))
def _(spark, sf_dir):
    rows = A.readings(A.load(spark, sf_dir))
    folder = work_folder(spark, "csv")
    csv_files.write_telemetry_csv(rows, folder)
    return csv_files.read_telemetry_csv(spark, folder, mode="strict")


@query("csv_split", S.with_(S.READINGS, """
    SELECT id, 'first' || chr(10) || '"' || id || '",' || chr(10) || 'last' AS labels_raw, value, "timestamp" FROM readings"""))
def _(spark, sf_dir):
    """Two files, and one more for each million readings, with line breaks and quotes in every record, each cut by several tasks."""
    rows = A.readings(A.load(spark, sf_dir))
    texts = F.concat(F.lit("first\n\""), F.col("id"), F.lit("\",\nlast"))
    folder = work_folder(spark, "csv-split")
    csv_files.write_telemetry_csv(rows.withColumns({"labels_raw": texts, "pod": F.col("id").cast("string")}).repartition(
        2 + rows.count() // 1_000_000), folder)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    # Small files are to be cut as well; large ones into hundreds of splits, not one for every 64 KB.
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(max(64 << 10, files.size(spark, folder) // 400), 128 << 20)))
    try:
        back = csv_files.read_telemetry_csv(spark, folder, multi_line="split")
        stored = work_folder(spark, "csv-read")
        back.write.parquet(stored)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    return spark.read.parquet(stored).select(F.col("pod").cast("bigint").alias("id"), "labels_raw", "value", "timestamp")


@query("csv_rejects", S.with_(S.READINGS, """
    SELECT id || ',short' AS record, 2 AS fields FROM readings WHERE id % 7 = 0"""))
def _(spark, sf_dir):
    """One record in seven has two fields only. A file for every task of the scan, each cut by as many tasks as it needs."""
    rows = csv_files.csv_texts(A.readings(A.load(spark, sf_dir)).withColumn("pod", F.col("id").cast("string")))
    line = F.when(F.col("pod").cast("bigint") % 7 == 0, F.concat("pod", F.lit(",short"))).otherwise(
        F.array_join(F.array(*[F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in READING_COLUMNS]), ","))
    folder = work_folder(spark, "csv-rejects")
    # The first record of a task comes with the header of the task's file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    header = F.lit(",".join(READING_COLUMNS) + "\n")
    rows.select(F.when(first, F.concat(header, line)).otherwise(line).alias("value")).write.text(folder)
    return csv_files.read_rejected_csv(spark, folder, multi_line="split").select("record", "fields")


@query("csv_by_header", S.with_(S.READINGS, f"SELECT {READING_SQL} FROM readings"))
def _(spark, sf_dir):
    """Columns in another order, under other spellings, with one more."""
    rows = csv_files.csv_texts(A.readings(A.load(spark, sf_dir)))
    folder = work_folder(spark, "csv-header")
    renamed = rows.select(
        F.lit("x").alias("more"),
        *[F.col(c).alias(c.replace("_", "").upper()) for c in reversed(READING_COLUMNS)],
    )
    renamed.write.options(header="true", quote='"', escape='"', emptyValue="", nullValue="").csv(folder)
    return csv_files.read_telemetry_csv(spark, folder, by_header=True)


@query("csv_stream", S.with_(S.READINGS, f"SELECT {READING_SQL} FROM readings"))
def _(spark, sf_dir):
    folder = work_folder(spark, "csv")
    csv_files.write_telemetry_csv(A.readings(A.load(spark, sf_dir)), folder)
    return _drain(csv_files.stream_telemetry_csv(spark, folder), "csv-stream")


@query("table_roundtrip", S.with_(S.TELEMETRY, f"SELECT {TELEMETRY_SQL} FROM telemetry WHERE {IN_WINDOW}"))
def _(spark, sf_dir):
    """Telemetry appended to its table and read back for a window, whose days are pruned."""
    folder = work_folder(spark, "telemetry")
    tables.append_telemetry(A.telemetry(A.load(spark, sf_dir)), folder)
    stored = tables.scan_telemetry(spark, folder)
    window = readings.in_time_window(stored, *readings.resolve_window(*WINDOW))
    return window.select(*TELEMETRY_COLUMNS)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = A.load(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(_events_folder(sf_dir))


def _published(spark: SparkSession, sf_dir: str) -> str:
    folder = work_folder(spark, "queue")
    stream = A.readings(_event_stream(spark, sf_dir))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    for attempt in ("first", "again"):
        # The second query starts afresh on the same source and must add nothing.
        pipeline.publish_stream(
            stream, folder, work_folder(spark, f"checkpoint-{attempt}"), ["id"],
            available_now=True, at=at,
        ).awaitTermination()
    return folder


@query("stream_publish", S.with_(S.QUEUE, """
    SELECT id, topic, msg_uuid, partition_key, TIMESTAMP '2024-02-01 00:00:00' AS created_at, uuid, value FROM queue"""))
def _(spark, sf_dir):
    return parsed_message(tables.scan_queue(spark, _published(spark, sf_dir)))


@query("stream_collect", S.with_(S.TELEMETRY, f"""
    SELECT {", ".join(f'"{c}"' for c in TELEMETRY_COLUMNS if c not in ("timestamp", "ingested_at"))},
           TIMESTAMP '2024-02-01 00:00:00' AS "timestamp", TIMESTAMP '2024-02-02 00:00:00' AS ingested_at
    FROM telemetry"""))
def _(spark, sf_dir):
    """From readings through the queue into telemetry, both as streams."""
    queued = _published(spark, sf_dir)
    folder = work_folder(spark, "collected")
    for attempt in ("first", "again"):
        pipeline.collect_stream(
            tables.stream_queue(spark, queued), folder, work_folder(spark, "quarantine"),
            work_folder(spark, f"checkpoint-{attempt}"), available_now=True,
            at=F.lit("2024-02-02 00:00:00").cast("timestamp"),
        ).awaitTermination()
    return tables.scan_telemetry(spark, folder).select(*TELEMETRY_COLUMNS)


def _drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there, into a table, and read that."""
    spark = stream.sparkSession
    folder = work_folder(spark, name)
    stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", work_folder(spark, f"checkpoint-{name}")
    ).trigger(availableNow=True).start(folder).awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)


@query("stream_publish_ids", S.with_(S.READINGS, """
    SELECT count(*) AS messages, count(*) AS ids, count(*) AS msg_uuids FROM readings"""))
def _(spark, sf_dir):
    """Two publishers, one after the other, each with half of the readings: no id comes twice."""
    rows = A.readings(A.load(spark, sf_dir))
    folder = work_folder(spark, "queue")
    for half in (0, 1):
        pipeline.publish_batch(rows.filter(F.col("id") % 2 == half).drop("id"), folder, f"writer-{half}")
    return tables.scan_queue(spark, folder).agg(
        F.count("*").alias("messages"), F.count_distinct("id").alias("ids"),
        F.count_distinct("msg_uuid").alias("msg_uuids"))


@query("stream_replay", S.with_(S.READINGS, """
    SELECT count(*) AS messages, count(*) AS stored FROM readings"""))
def _(spark, sf_dir):
    """A batch with random message ids published twice, and collected after each attempt."""
    rows = A.readings(A.load(spark, sf_dir))
    queued, folder = work_folder(spark, "queue"), work_folder(spark, "collected")
    for attempt in (0, 1):
        pipeline.publish_batch(rows, queued, "same")
        pipeline.collect_batch(
            tables.scan_queue(spark, queued), folder, work_folder(spark, "quarantine"), f"attempt-{attempt}")
    stored = tables.scan_telemetry(spark, folder).agg(F.count("*").alias("stored"))
    return tables.scan_queue(spark, queued).agg(F.count("*").alias("messages")).join(stored)


@query("persist_redated", S.with_(S.READINGS, """
    SELECT id, TIMESTAMP '2024-03-01 00:00:00' AS "timestamp" FROM readings"""))
def _(spark, sf_dir):
    """Messages published again with a later time: a message id is stored once, with its first time."""
    rows = A.readings(A.load(spark, sf_dir))
    folder = work_folder(spark, "collected")
    for day in ("2024-03-01", "2024-03-09"):
        queued = work_folder(spark, "queue")
        pipeline.publish_batch(rows, queued, "same", keys=["id"], at=F.lit(f"{day} 00:00:00").cast("timestamp"))
        pipeline.collect_batch(tables.scan_queue(spark, queued), folder, work_folder(spark, "quarantine"), day)
    return tables.scan_telemetry(spark, folder).select("id", "timestamp")


@query("stream_dedup", S.with_(S.QUEUE, 'SELECT id, msg_uuid, "timestamp" FROM queue'))
def _(spark, sf_dir):
    """Every message twice within the horizon."""
    rows = identity.assign_msg_uuid(A.readings(_event_stream(spark, sf_dir)), ["id"])
    twice = rows.select("id", "msg_uuid", "timestamp", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    return _drain(pipeline.stream_dedup(twice.drop("copy"), ["msg_uuid"], "1 hour"), "dedup")


@query("stream_unacked", S.with_(S.READINGS, """
    SELECT 'd-' || id AS lease_id, "timestamp" AS sent_at FROM readings
    WHERE metric_name IN ('error', 'view')"""))
def _(spark, sf_dir):
    """Deliveries of clicks and the like are acknowledged in time, of views late, of errors never.

    A delivery far in the future, acknowledged at once, lets both watermarks pass all others.
    """
    events = A.load(spark, sf_dir)
    sent = A.readings(events).select(
        F.concat(F.lit("d-"), F.col("id")).alias("lease_id"), F.col("timestamp").alias("sent_at"), "metric_name"
    )
    end = sent.agg(F.max("sent_at").alias("t")).select(
        F.lit("d-end").alias("lease_id"), (F.col("t") + F.expr("INTERVAL 1 DAY")).alias("sent_at"),
        F.lit("end").alias("metric_name"),
    )
    delay = F.when(F.col("metric_name") == "view", F.expr("INTERVAL 31 SECONDS")).otherwise(F.expr("INTERVAL 10 SECONDS"))
    folder = work_folder(spark, "deliveries")
    sent.unionByName(end).write.parquet(folder)
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).parquet(folder)
    acked = spark.readStream.schema(schema).parquet(folder).filter("metric_name <> 'error'").select(
        "lease_id", (F.col("sent_at") + delay).alias("acked_at")
    )
    lost = pipeline.unacked_stream(stream.select("lease_id", "sent_at"), acked)
    return _drain(lost, "unacked")


@query("stream_lease_state", S.with_(S.STATES, "SELECT id, state, served FROM states"))
def _(spark, sf_dir):
    """message_state from leases and acknowledgements as streams, which stop half-way and start again.

    Besides what happened by then there is one acknowledgement of no lease, late enough for the watermark to reach that time.
    """
    events, granted, acked = delivery(spark, sf_dir)
    now = A.as_of(granted)
    grants, replies = work_folder(spark, "grants"), work_folder(spark, "replies")
    table, checkpoint = work_folder(spark, "transitions"), work_folder(spark, "checkpoint-leases")
    served = granted.filter(F.col("served_at").cast("timestamp") <= now)
    middle = served.agg(F.percentile_approx(F.col("served_at").cast("timestamp"), 0.5)).head()[0]
    late = spark.range(1).select(F.lit("none").alias("lease_id"), (now + F.expr("INTERVAL 1 MINUTE")).cast("timestamp").alias("acked_at"))
    for part in (0, 1):
        first = F.lit(part == 0)
        served.filter((F.col("served_at").cast("timestamp") <= F.lit(middle)) == first).write.mode("append").parquet(grants)
        known = acked.filter(F.col("acked_at").cast("timestamp") <= now)
        known = known.filter((F.col("acked_at").cast("timestamp") <= F.lit(middle)) == first).select("lease_id", F.col("acked_at").cast("timestamp"))
        (known.unionByName(late) if part else known).write.mode("append").parquet(replies)
        schemas = [spark.read.parquet(f).schema for f in (grants, replies)]
        lease_states.lease_state_stream(
            *[spark.readStream.schema(s).parquet(f) for s, f in zip(schemas, (grants, replies), strict=True)],
            table, checkpoint, available_now=True).awaitTermination()
    statuses = lease_states.lease_status(spark.read.parquet(table))
    return leases.states_of_messages(A.queue_keys(events), statuses)


@query("stream_backlog", S.with_(S.LEASES + DONE, """
    SELECT CAST(o.i AS INTEGER) AS owner, count(q.id) AS backlog, least(count(q.id), 5000) / 5000.0::DOUBLE AS utilization
    FROM range(4) o(i) LEFT JOIN (SELECT * FROM owned WHERE id NOT IN (SELECT id FROM done)) q ON q.owner = o.i GROUP BY o.i"""))
def _(spark, sf_dir):
    """The backlog from running counts of messages put on the queue and deleted, in two starts of the stream."""
    events, granted, acked = delivery(spark, sf_dir)
    messages = A.queue_keys(events).select("id", "partition_key")
    gone = messages.join(acked_ids(granted, acked).select("id"), "id", "left_semi")
    folders = [work_folder(spark, n) for n in ("inserted", "deleted")]
    table, checkpoint = work_folder(spark, "backlog"), work_folder(spark, "checkpoint-backlog")
    for half in (0, 1):
        for rows, folder in zip((messages, gone), folders, strict=True):
            rows.filter(F.col("id") % 2 == half).write.mode("append").parquet(folder)
        backlog.backlog_stream(
            *[spark.readStream.schema(messages.schema).parquet(f) for f in folders], table, checkpoint, available_now=True).awaitTermination()
    return queue.utilization(backlog.stored_backlog(spark, table), ranges_of(spark), 5000)
