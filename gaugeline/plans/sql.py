"""The adapters of :mod:`gaugeline.plans.adapters` as SQL, for checking results."""

from __future__ import annotations

from gaugeline.functions.identity import FNV_MASK, FNV_OFFSET, FNV_PRIME


def key_list(*keys: str) -> str:
    """Several keys as one text, each with its length in front; NUL for NULL."""
    texts = [f"coalesce(CAST({k} AS VARCHAR), chr(0))" for k in keys]
    return " || ':' || ".join(f"length({t}) || '#' || {t}" for t in texts)


def message_id(key: str) -> str:
    h = f"md5('telemetry:' || {key})"
    return (
        f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
        f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)"
    )


def fnv(text: str) -> str:
    return (
        f"list_reduce(list_prepend({FNV_OFFSET}::UBIGINT, "
        f"[('0x' || substr(hex(encode({text})), 2*i-1, 2))::UBIGINT "
        f"FOR i IN range(1, octet_length(encode({text})) + 1)]), "
        f"lambda h, b: (xor(h, b) * {FNV_PRIME}::UBIGINT) % {FNV_MASK + 1}::UBIGINT)"
    )


READINGS = """
readings AS (
  SELECT event_id AS id, ts AS "timestamp", event_type AS metric_name,
         CAST(user_id % 8 AS VARCHAR) AS gpu_id, 'nvidia' || (user_id % 8) AS device,
         'GPU-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS uuid,
         CASE WHEN user_id % 2 = 0 THEN 'A100' ELSE 'H100' END AS model_name,
         'host-' || lpad(CAST(user_id // 8 AS VARCHAR), 4, '0') AS hostname,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE 'trainer' END AS container,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE 'pod-' || (user_id % 8) END AS pod,
         CASE WHEN event_id % 3 = 0 THEN '' ELSE 'ml' END AS namespace,
         value, props AS labels_raw
  FROM events)"""

TELEMETRY = READINGS + f""",
telemetry AS (
  SELECT id, nullif(uuid, '') AS uuid, {message_id('id')} AS msg_uuid, gpu_id, metric_name,
         "timestamp", nullif(device, '') AS device, nullif(model_name, '') AS model_name,
         nullif(hostname, '') AS hostname, nullif(container, '') AS container,
         nullif(pod, '') AS pod, nullif(namespace, '') AS namespace, value,
         nullif(labels_raw, '') AS labels_raw, "timestamp" + INTERVAL 1 SECOND AS ingested_at
  FROM readings)"""

# Hash the few distinct GPU ids once, then look them up.
QUEUE = READINGS + f""",
hashed AS (
  SELECT gpu_id, CAST(f % 256 AS INTEGER) AS partition_key
  FROM (SELECT gpu_id, {fnv('gpu_id')} AS f FROM (SELECT DISTINCT gpu_id FROM readings))),
queue AS (
  SELECT r.*, 'telemetry' AS topic, {message_id('r.id')} AS msg_uuid, h.partition_key,
         r."timestamp" + INTERVAL 1 SECOND AS created_at
  FROM readings r JOIN hashed h USING (gpu_id))"""

OWNED = QUEUE + """,
owned AS (
  SELECT id, topic, msg_uuid, "timestamp", partition_key,
         least(partition_key // 64, 3) AS owner
  FROM queue),
batches AS (
  SELECT *, (row_number() OVER (PARTITION BY owner ORDER BY id) - 1) // 100 AS batch FROM owned)"""

LEASES = OWNED + """,
leases AS (
  SELECT 'lease-' || owner || '-' || batch AS lease_id, owner, batch,
         list(id ORDER BY id) AS ids, max("timestamp") AS served_at, 30 AS lease_seconds
  FROM batches GROUP BY owner, batch),
acks AS (
  SELECT lease_id, served_at + INTERVAL 31 SECOND AS acked_at FROM leases WHERE batch % 5 = 0
  UNION ALL
  SELECT lease_id, served_at + INTERVAL 10 SECOND FROM leases WHERE batch % 5 <> 0 AND batch % 2 = 0)"""

STATES = LEASES + """,
clock AS (
  SELECT max(served_at) + INTERVAL 5 SECOND AS now FROM leases
  WHERE served_at < TIMESTAMP '2024-01-20 00:00:00'),
status AS (
  SELECT l.lease_id, l.ids, l.served_at, l.lease_seconds,
         CASE WHEN a.acked_at <= c.now AND a.acked_at - l.served_at <= INTERVAL 30 SECOND THEN 'acked'
              WHEN c.now - l.served_at > INTERVAL 30 SECOND THEN 'expired'
              ELSE 'in_flight' END AS status
  FROM leases l CROSS JOIN clock c LEFT JOIN acks a USING (lease_id)
  WHERE l.served_at <= c.now),
history AS (
  SELECT id, count(*) FILTER (WHERE status = 'acked') AS n_acked,
         count(*) FILTER (WHERE status = 'in_flight') AS n_flight, count(*) AS served
  FROM (SELECT unnest(ids) AS id, status FROM status) GROUP BY id),
states AS (
  SELECT q.id, CASE WHEN h.n_acked > 0 THEN 'acked' WHEN h.n_flight > 0 THEN 'in_flight'
                    ELSE 'ready' END AS state,
         coalesce(h.served, 0) AS served
  FROM queue q LEFT JOIN history h USING (id))"""

REQUESTS = READINGS + """,
messages AS (
  SELECT id // 4 AS request_id, id % 4 AS slot, id, metric_name, gpu_id,
         row_number() OVER (PARTITION BY id // 4 ORDER BY id) - 1 AS "index",
         CAST(substr(uuid, 5, 6) AS BIGINT) AS u
  FROM readings),
judged AS (
  SELECT *, CASE WHEN metric_name = 'error' AND u % 3 = 0 THEN 'gpu_id is required'
                 WHEN metric_name = 'error' AND u % 3 = 1 THEN 'gpu_id must be a string'
                 WHEN metric_name = 'signup' AND u % 3 = 2 THEN 'message must be a JSON object'
                 WHEN metric_name = 'signup' AND u % 7 = 0 THEN 'gpu_id is required' END AS problem
  FROM messages),
requests AS (
  SELECT request_id,
         CASE WHEN min_by(metric_name, "index") = 'purchase' THEN ''
              ELSE 't-' || min_by(metric_name, "index") END AS topic,
         count(*) AS n,
         min_by('messages[' || "index" || ']: ' || problem, "index")
           FILTER (WHERE problem IS NOT NULL) AS bad
  FROM judged GROUP BY request_id),
validated AS (
  SELECT request_id, topic, n, CASE WHEN topic = '' THEN 'topic is required' ELSE bad END AS error
  FROM requests)"""


def with_(prefix: str, query: str) -> str:
    return f"WITH {prefix.strip()}\n{query.strip()}"
