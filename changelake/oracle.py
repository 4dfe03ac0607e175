"""The same results as plain SQL over the driver's tables, for DuckDB.

Each text is written from the definition of its operator and not from the Spark code, in
the simplest form SQL has for it.
"""

from __future__ import annotations

_RELATIONS = """
k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         epoch_us(ts) // 1000 AS timestamp_ms
  FROM events),
raw_ops AS (
  SELECT event_id AS op_no, ts, timestamp_ms,
         CASE event_type WHEN 'error' THEN '.sys-error' WHEN 'click' THEN 'logs-click'
              WHEN 'view' THEN 'logs-view' WHEN 'purchase' THEN 'shop-purchase'
              ELSE 'shop-signup' END AS idx,
         concat('u', CAST(user_id AS STRING)) AS id,
         CAST(user_id % 3 AS INT) AS shard_id,
         CASE WHEN event_id % 97 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS result_type,
         CASE WHEN k % 10 = 0 THEN 'DELETE' ELSE 'INDEX' END AS op_type,
         CASE WHEN event_id % 5 = 0 THEN concat('r', CAST(event_id % 7 AS STRING)) END AS req_routing,
         CASE WHEN k % 10 <> 0
              THEN concat('{"n":', CAST(event_id AS STRING), ',"k":', CAST(k AS STRING), '}') END AS source
  FROM k),
delete_requests AS (
  SELECT op_no, idx, id, req_routing AS routing FROM raw_ops
  WHERE op_type = 'DELETE' AND req_routing IS NOT NULL),
change_log AS (
  SELECT op_no, idx, id, source,
         row_number() OVER (PARTITION BY idx, shard_id ORDER BY op_no) - 1 AS seq_no,
         CAST(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS BIGINT) AS primary_term,
         op_type, CASE WHEN op_type = 'INDEX' THEN req_routing END AS routing, shard_id, timestamp_ms
  FROM raw_ops WHERE result_type = 'SUCCESS'),
captured AS (SELECT * FROM change_log WHERE idx NOT LIKE '.%'),
arrived AS (
  SELECT *, (op_no * 2654435761) % 4294967296 AS arrival FROM captured
  UNION ALL
  SELECT *, 4294967296 + (op_no * 2654435761) % 4294967296 AS arrival FROM captured WHERE op_no % 10 = 3),
batch_width AS (SELECT greatest(1, 4294967296 * 50 // count(*)) AS width FROM events),
deliveries AS (
  SELECT arrived.*, concat('b', CAST(arrival // (SELECT width FROM batch_width) AS STRING)) AS batch_key FROM arrived),
lagging AS (SELECT * FROM deliveries WHERE arrival < 2576980377),
snapshot_docs AS (
  SELECT DISTINCT idx, shard_id, id, '{"seed":true}' AS source FROM captured WHERE op_no % 4 = 0)"""

_CHANGE = "idx, id, source, seq_no, primary_term, op_type, routing, shard_id, timestamp_ms"

_COUNTED = """
counted AS (
  SELECT *, (row_number() OVER (PARTITION BY idx, shard_id ORDER BY seq_no) - 1) // 25 AS batch_no
  FROM captured),
ranges AS (
  SELECT idx, shard_id, batch_no, count(*) AS event_count, min(seq_no) AS from_seq_no,
         max(seq_no) AS to_seq_no, max(primary_term) AS primary_term
  FROM counted GROUP BY ALL),
keyed AS (
  SELECT c.*, concat(c.idx, '/', CAST(c.shard_id AS STRING), '/', CAST(r.primary_term AS STRING), '_',
                     CAST(r.from_seq_no AS STRING), '_', CAST(r.to_seq_no AS STRING)) AS file_key
  FROM counted c JOIN ranges r USING (idx, shard_id, batch_no)),
lined AS (
  SELECT *, concat('{"index":"', idx, '","id":"', id, '"', ',"source":' || source,
                   ',"seq_no":', CAST(seq_no AS STRING), ',"primary_term":', CAST(primary_term AS STRING),
                   ',"op_type":"', op_type, '"', ',"routing":"' || routing || '"',
                   ',"shard_id":', CAST(shard_id AS STRING),
                   ',"timestamp_ms":', CAST(timestamp_ms AS STRING), '}') AS line
  FROM keyed),
manifest AS (
  SELECT concat('cdc/log/', file_key, '.ndjson') AS s3_key, count(*) AS event_count,
         min(seq_no) AS from_seq_no, max(seq_no) AS to_seq_no, max(primary_term) AS primary_term,
         idx, shard_id, CAST(sum(strlen(line) + 1) AS BIGINT) AS payload_bytes
  FROM lined GROUP BY file_key, idx, shard_id)"""

_ROUTED = """
deletes AS (SELECT * FROM captured WHERE op_type = 'DELETE'),
routed AS (
  SELECT d.* EXCLUDE (routing),
         (SELECT r.routing FROM delete_requests r
          WHERE r.idx = d.idx AND r.id = d.id AND r.op_no <= d.op_no
            AND r.op_no > coalesce((SELECT max(p.op_no) FROM deletes p
                                    WHERE p.idx = d.idx AND p.id = d.id AND p.op_no < d.op_no), -1)
          ORDER BY r.op_no DESC LIMIT 1) AS routing
  FROM deletes d),
routed_changes AS (
  SELECT {c} FROM captured WHERE op_type = 'INDEX' UNION ALL SELECT {c} FROM routed)""".format(c=_CHANGE)


def _newest(rows: str) -> str:
    return f"""SELECT * FROM (
  SELECT *, seq_no + 1 AS version,
         row_number() OVER (PARTITION BY idx, shard_id, id ORDER BY seq_no DESC) AS rn
  FROM {rows}) WHERE rn = 1"""


_REPLICA = "idx, shard_id, id, version, seq_no, primary_term, op_type, source, routing, timestamp_ms"


def _verdicts(rejected: str = "false", stored: str | None = None) -> str:
    floor = "0"
    if stored:
        floor = (
            "coalesce((SELECT s.version FROM stored s WHERE s.idx = d.idx AND "
            "s.shard_id = d.shard_id AND s.id = d.id), 0)"
        )
    return f"""verdicts AS (
  SELECT *, CASE WHEN {rejected} THEN 'FAILED'
                 WHEN seq_no + 1 > greatest(floor_version, coalesce(max(CASE WHEN NOT ({rejected}) THEN seq_no + 1 END)
                      OVER (PARTITION BY idx, shard_id, id ORDER BY arrival
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 THEN 'APPLIED' ELSE 'CONFLICT' END AS verdict
  FROM (SELECT d.*, {floor} AS floor_version FROM deliveries d))"""


_REJECTED = "op_no % 211 = 0"

_SUMMARY = """
tops AS (
  SELECT *, row_number() OVER (PARTITION BY batch_key ORDER BY seq_no DESC, arrival) AS rn FROM verdicts),
summary AS (
  SELECT batch_key, count(*) FILTER (verdict = 'APPLIED') AS succeeded,
         count(*) FILTER (verdict = 'CONFLICT') AS version_conflicts,
         count(*) FILTER (verdict = 'FAILED') AS failed, max(seq_no) AS max_seq_no,
         max(CASE WHEN rn = 1 THEN primary_term END) AS max_primary_term
  FROM tops GROUP BY batch_key)"""

_CHECKPOINT = """
checkpoint AS (
  SELECT idx, shard_id, max(seq_no) AS last_seq_no,
         max(CASE WHEN rn = 1 THEN primary_term END) AS last_primary_term,
         count(*) FILTER (verdict = 'APPLIED') AS events_replayed, max(arrival) AS last_updated_ms
  FROM (SELECT *, row_number() OVER (PARTITION BY idx, shard_id ORDER BY seq_no DESC, arrival) AS rn
        FROM verdicts)
  GROUP BY idx, shard_id)"""

_COPIES = f"""
active AS (SELECT * FROM ({_newest('captured')}) WHERE op_type = 'INDEX'),
passive AS (SELECT * FROM ({_newest('lagging')}) WHERE op_type = 'INDEX'),
paired AS (
  SELECT coalesce(a.idx, p.idx) AS idx, coalesce(a.shard_id, p.shard_id) AS shard_id,
         coalesce(a.id, p.id) AS id,
         CASE WHEN a.id IS NULL THEN 'MISSING_ACTIVE' WHEN p.id IS NULL THEN 'MISSING_PASSIVE'
              WHEN a.source IS NOT DISTINCT FROM p.source THEN 'MATCH' ELSE 'CONTENT_MISMATCH' END AS status
  FROM active a FULL OUTER JOIN passive p
    ON a.idx = p.idx AND a.shard_id = p.shard_id AND a.id = p.id)"""


def _with(*parts: str) -> str:
    *ctes, final = parts
    return "WITH RECURSIVE " + ",".join([_RELATIONS, *ctes]) + "\n" + final


_FAIL = _verdicts(_REJECTED)
_LATEST = f"SELECT {_REPLICA} FROM ({_newest('captured')})"

ORACLES: dict[str, str] = {
    "successful_ops": _with("SELECT op_no, idx, op_type FROM raw_ops WHERE result_type = 'SUCCESS'"),
    "index_filter": _with(
        "SELECT op_no, idx FROM raw_ops WHERE idx IN ('logs-click', 'shop-signup')"
    ),
    "to_change_event": _with(f"SELECT {_CHANGE} FROM change_log"),
    "event_size": _with(
        """SELECT idx, shard_id, seq_no,
                  100 + length(idx) + length(id) + coalesce(length(source), 0)
                      + coalesce(length(routing), 0) AS size
           FROM captured"""
    ),
    "delete_routing": _with(_ROUTED, "SELECT idx, shard_id, id, seq_no, op_no, routing FROM routed"),
    "capture_changes": _with(_ROUTED, f"SELECT {_CHANGE} FROM routed_changes"),
    "capture_metrics": _with(
        """SELECT count(*) FILTER (idx NOT LIKE '.%' AND idx <> 'shop-signup') AS captured_ops,
                  count(*) FILTER (idx LIKE '.%' OR idx = 'shop-signup') AS skipped_ops,
                  CAST(0 AS BIGINT) AS failed_ops
           FROM raw_ops WHERE result_type = 'SUCCESS'"""
    ),
    "op_mix": _with("SELECT idx, op_type, count(*) AS ops FROM captured GROUP BY ALL"),
    "batch_by_count": _with(_COUNTED, "SELECT idx, shard_id, seq_no, batch_no FROM counted"),
    "batch_by_age": _with(
        "SELECT idx, shard_id, seq_no, timestamp_ms // 86400000 AS age_window FROM captured"
    ),
    "pack_batches": _with(
        """
ordered AS (
  SELECT *, timestamp_ms // 86400000 AS age_window,
         100 + length(idx) + length(id) + coalesce(length(source), 0) + coalesce(length(routing), 0) AS size,
         row_number() OVER (PARTITION BY idx, shard_id, timestamp_ms // 86400000 ORDER BY seq_no) AS pos
  FROM captured),
packed AS (
  SELECT idx, shard_id, seq_no, age_window, pos, CAST(0 AS BIGINT) AS batch_no,
         CAST(1 AS BIGINT) AS n, CAST(size AS BIGINT) AS bytes
  FROM ordered WHERE pos = 1
  UNION ALL
  SELECT o.idx, o.shard_id, o.seq_no, o.age_window, o.pos,
         CASE WHEN p.n >= 10 OR p.bytes >= 1024 THEN p.batch_no + 1 ELSE p.batch_no END,
         CASE WHEN p.n >= 10 OR p.bytes >= 1024 THEN 1 ELSE p.n + 1 END,
         CASE WHEN p.n >= 10 OR p.bytes >= 1024 THEN o.size ELSE p.bytes + o.size END
  FROM packed p JOIN ordered o ON o.idx = p.idx AND o.shard_id = p.shard_id
   AND o.age_window = p.age_window AND o.pos = p.pos + 1)""",
        "SELECT idx, shard_id, seq_no, age_window, batch_no FROM packed",
    ),
    "bulk_sub_batches": _with(
        """SELECT batch_key, arrival, idx, shard_id, seq_no,
                  (row_number() OVER (PARTITION BY batch_key ORDER BY arrival) - 1) // 5 AS slice_no
           FROM deliveries"""
    ),
    "batch_ranges": _with(_COUNTED, "SELECT * FROM ranges"),
    "batch_manifest": _with(_COUNTED, "SELECT * FROM manifest"),
    "ship_metrics": _with(
        _COUNTED,
        """SELECT count(*) FILTER (from_seq_no % 4 <> 3) AS batches_shipped,
                  CAST(sum(event_count) FILTER (from_seq_no % 4 <> 3) AS BIGINT) AS events_shipped,
                  CAST(sum(payload_bytes) FILTER (from_seq_no % 4 <> 3) AS BIGINT) AS bytes_shipped,
                  count(*) FILTER (from_seq_no % 4 = 3) AS ship_failures
           FROM manifest""",
    ),
    "backlog": _with(
        """SELECT count(*) AS queue_size,
                  CAST(coalesce(sum(100 + length(idx) + length(id) + coalesce(length(source), 0)
                      + coalesce(length(routing), 0)), 0) AS BIGINT) AS queue_bytes
           FROM captured c WHERE NOT EXISTS (
             SELECT 1 FROM lagging s WHERE s.idx = c.idx AND s.shard_id = c.shard_id AND s.seq_no = c.seq_no)"""
    ),
    "latest_state": _with(_LATEST),
    "live_docs": _with(
        f"""SELECT idx, shard_id, id, version, source FROM ({_newest('captured')})
            WHERE op_type = 'INDEX'"""
    ),
    "apply_changes": _with(_LATEST),
    "bootstrap": _with(
        f"""{_LATEST} UNION ALL
            SELECT s.idx, s.shard_id, s.id, 0, -1, 0, 'INDEX', s.source, NULL, 0 FROM snapshot_docs s
            WHERE NOT EXISTS (SELECT 1 FROM captured c
                              WHERE c.idx = s.idx AND c.shard_id = s.shard_id AND c.id = s.id)"""
    ),
    "replay_verdicts": _with(_FAIL, "SELECT idx, shard_id, id, seq_no, arrival, verdict FROM verdicts"),
    "replay_verdicts_on_state": _with(
        """stored AS (
  SELECT idx, shard_id, id, max(seq_no) + 1 AS version FROM captured WHERE op_no % 3 = 0 GROUP BY ALL)""",
        _verdicts(stored="stored"),
        "SELECT idx, shard_id, id, seq_no, arrival, verdict FROM verdicts",
    ),
    "replay_summary": _with(_FAIL, _SUMMARY, "SELECT * FROM summary"),
    "arrival_order": _with(
        """SELECT batch_key, arrival, idx, id,
                  row_number() OVER (PARTITION BY batch_key ORDER BY arrival) - 1 AS place
           FROM deliveries ORDER BY arrival"""
    ),
    "redelivered": _with(
        """SELECT idx, shard_id, id, count(*) AS deliveries, max(seq_no) AS last_seq_no
           FROM deliveries GROUP BY ALL"""
    ),
    "render_bulk_actions": _with(
        """SELECT idx, shard_id, seq_no,
                  concat('{"', lower(op_type), '":{"_index":"', idx, '","_id":"', id, '","version":',
                         CAST(seq_no + 1 AS STRING), ',"version_type":"external"',
                         ',"routing":"' || routing || '"', '}}', chr(10) || source) AS bulk
           FROM captured"""
    ),
    "checkpoint_update": _with(_FAIL, _CHECKPOINT, "SELECT * FROM checkpoint"),
    "merge_checkpoints": _with(_FAIL, _CHECKPOINT, "SELECT * FROM checkpoint"),
    "load_checkpoints": _with(_FAIL, _CHECKPOINT, "SELECT * FROM checkpoint"),
    "pending_batches": _with(
        _FAIL, _SUMMARY, "SELECT batch_key AS s3_key FROM summary WHERE failed > 0"
    ),
    "consumer_metrics": _with(
        _FAIL,
        """numbered AS (
  SELECT arrival // (SELECT width FROM batch_width) AS number, count(*) FILTER (verdict = 'FAILED') AS failed, max(arrival) AS polled
  FROM verdicts GROUP BY 1)""",
        """SELECT count(*) FILTER (number >= 40 AND failed = 0) AS batches_processed,
                  count(*) FILTER (number < 20 OR (number >= 40 AND failed > 0)) AS batches_failed,
                  max(polled) AS last_poll_ms
           FROM numbered""",
    ),
    "read_change_log": _with(
        _COUNTED,
        f"""SELECT {_CHANGE}, file_key AS batch_key,
                   row_number() OVER (PARTITION BY idx, shard_id, batch_no ORDER BY seq_no) - 1 AS line_no
            FROM keyed""",
    ),
    "write_change_log": _with(_COUNTED, "SELECT line AS value FROM lined"),
    "split_bad_files": _with(
        _COUNTED,
        """SELECT file_key AS batch_key,
                  CASE WHEN count(*) FILTER (op_no % 500 = 1) = 0 THEN count(*) ELSE 0 END AS events,
                  count(*) FILTER (op_no % 500 = 1) AS bad_lines
           FROM keyed GROUP BY file_key""",
    ),
    "stream_change_log": _with(f"SELECT {_CHANGE} FROM captured"),
    "load_notifications": _with(
        _COUNTED,
        """SELECT s3_key,
                  CASE WHEN from_seq_no % 5 = 3 THEN 0 ELSE event_count END AS event_count,
                  CASE WHEN from_seq_no % 5 = 3 THEN 0 ELSE from_seq_no END AS from_seq_no,
                  to_seq_no,
                  CASE WHEN from_seq_no % 5 = 3 THEN 0 ELSE primary_term END AS primary_term,
                  idx, shard_id,
                  CASE WHEN from_seq_no % 5 = 3 THEN 0 ELSE payload_bytes END AS payload_bytes
           FROM manifest WHERE from_seq_no % 5 <> 4""",
    ),
    "resolve_batches": _with(
        _COUNTED,
        """SELECT s3_key, event_count, CASE WHEN shard_id <> 1 THEN event_count END AS file_events,
                  CASE WHEN shard_id <> 1 THEN 'FOUND' ELSE 'MISSING' END AS status
           FROM manifest""",
    ),
    "save_replica": _with(_LATEST),
    "reconcile_docs": _with(_COPIES, "SELECT * FROM paired"),
    "reconcile_by_digest": _with(_COPIES, "SELECT * FROM paired"),
    "reconcile_counts": _with(
        _COPIES,
        """counts AS (
  SELECT idx, count(*) FILTER (side = 'a') AS active, count(*) FILTER (side = 'p') AS passive
  FROM (SELECT idx, 'a' AS side FROM active UNION ALL SELECT idx, 'p' FROM passive) GROUP BY idx)""",
        """SELECT idx, active, passive, CASE WHEN active = passive THEN 'MATCH' ELSE 'MISMATCH' END AS status,
                  CAST(NULL AS BOOLEAN) AS in_sync FROM counts
           UNION ALL
           SELECT 'TOTAL', CAST(sum(active) AS BIGINT), CAST(sum(passive) AS BIGINT),
                  CASE WHEN sum(active) = sum(passive) THEN 'MATCH' ELSE 'MISMATCH' END,
                  bool_and(active = passive) AND sum(active) > 0 FROM counts""",
    ),
    "spot_check": _with(
        _COPIES,
        """SELECT * FROM paired
           ORDER BY md5(concat(idx, '/', CAST(shard_id AS STRING), '/', id)) LIMIT 10""",
    ),
    "replication_lag": _with(
        """SELECT idx, shard_id, max(seq_no) AS active_seq_no,
                  coalesce((SELECT max(l.seq_no) FROM lagging l
                            WHERE l.idx = c.idx AND l.shard_id = c.shard_id), -1) AS checkpoint_seq_no,
                  max(seq_no) - coalesce((SELECT max(l.seq_no) FROM lagging l
                            WHERE l.idx = c.idx AND l.shard_id = c.shard_id), -1) AS lag
           FROM captured c GROUP BY idx, shard_id"""
    ),
    "sequence_gaps": _with(
        """seen AS (SELECT DISTINCT idx, shard_id, seq_no FROM lagging),
below AS (
  SELECT *, coalesce(lag(seq_no) OVER (PARTITION BY idx, shard_id ORDER BY seq_no), -1) AS last FROM seen)""",
        """SELECT idx, shard_id, last + 1 AS gap_from, seq_no - 1 AS gap_to, seq_no - last - 1 AS missing
           FROM below WHERE seq_no - last > 1""",
    ),
    "replication_status": _with(
        _COUNTED,
        _FAIL,
        _SUMMARY,
        """unshipped AS (
  SELECT 100 + length(idx) + length(id) + coalesce(length(source), 0) + coalesce(length(routing), 0) AS size
  FROM captured c WHERE NOT EXISTS (
    SELECT 1 FROM lagging s WHERE s.idx = c.idx AND s.shard_id = c.shard_id AND s.seq_no = c.seq_no))""",
        """SELECT 'replication' AS section, 'role' AS metric, 'producer' AS value
UNION ALL SELECT 'replication', 'running', 'true'
UNION ALL SELECT 'producer', 'captured_ops', CAST(count(*) AS STRING) FROM captured
UNION ALL SELECT 'producer', 'skipped_ops', CAST(count(*) AS STRING) FROM change_log WHERE idx LIKE '.%'
UNION ALL SELECT 'producer', 'failed_ops', '0'
UNION ALL SELECT 'producer', 'queue_size', CAST(count(*) AS STRING) FROM unshipped
UNION ALL SELECT 'producer', 'queue_bytes', CAST(coalesce(sum(size), 0) AS STRING) FROM unshipped
UNION ALL SELECT 'producer', 'batches_shipped', CAST(count(*) AS STRING) FROM manifest
UNION ALL SELECT 'producer', 'events_shipped', CAST(sum(event_count) AS STRING) FROM manifest
UNION ALL SELECT 'producer', 'bytes_shipped', CAST(sum(payload_bytes) AS STRING) FROM manifest
UNION ALL SELECT 'producer', 'ship_failures', '0'
UNION ALL SELECT 'replication', 'role', 'consumer'
UNION ALL SELECT 'replication', 'running', 'true'
UNION ALL SELECT 'consumer', 'batches_processed', CAST(count(*) FILTER (failed = 0) AS STRING) FROM summary
UNION ALL SELECT 'consumer', 'batches_failed', CAST(count(*) FILTER (failed > 0) AS STRING) FROM summary
UNION ALL SELECT 'consumer', 'last_poll_ms', CAST(max(arrival) AS STRING) FROM verdicts""",
    ),
    "run_capture_stream": _with(_ROUTED, f"SELECT {_CHANGE} FROM routed_changes"),
    "drain_on_stop": _with(
        """SELECT idx, shard_id, count(*) AS events, max(seq_no) AS last_seq_no
           FROM captured GROUP BY idx, shard_id"""
    ),
    "run_replay_stream": _with(_LATEST),
    "run_notified_replay": _with(_ROUTED, f"SELECT {_REPLICA} FROM ({_newest('routed_changes')})"),
    "retry_pending": _with(
        """numbered AS (
  SELECT idx, shard_id, timestamp_ms // 2592000000 AS age, seq_no,
         (row_number() OVER (PARTITION BY idx, shard_id, timestamp_ms // 2592000000 ORDER BY seq_no) - 1) // 1000 AS batch
  FROM captured),
batches AS (
  SELECT count(*) AS events, count(*) FILTER (seq_no % 41 = 5) AS refused FROM numbered GROUP BY idx, shard_id, age, batch)""",
        """SELECT 'consumer' AS section, 'batches_processed' AS metric, CAST(count(*) AS STRING) AS value FROM batches
UNION ALL SELECT 'consumer', 'batches_failed', CAST(count(*) FILTER (refused > 0) AS STRING) FROM batches
UNION ALL SELECT 'consumer', 'events', CAST(sum(events) AS STRING) FROM batches
UNION ALL SELECT 'consumer', 'failed', '0'
UNION ALL SELECT 'consumer', 'pending', '0'""",
    ),
    "resolved_events": _with(
        _COUNTED,
        f"""SELECT concat('cdc/log/', file_key, '.ndjson') AS s3_key, {_CHANGE},
                   CAST(row_number() OVER (PARTITION BY idx, shard_id, batch_no ORDER BY seq_no) - 1 AS INT) AS line_no
            FROM keyed WHERE shard_id <> 1""",
    ),
    "stored_versions": _with(
        """SELECT idx, shard_id, id, max(seq_no) + 1 AS version FROM captured
           WHERE (idx, shard_id, id) IN (SELECT (idx, shard_id, id) FROM captured WHERE op_no % 300 = 7)
           GROUP BY idx, shard_id, id"""
    ),
    "safe_positions": _with(
        """seen AS (SELECT DISTINCT idx, shard_id, seq_no FROM lagging),
placed AS (SELECT *, row_number() OVER (PARTITION BY idx, shard_id ORDER BY seq_no) - 1 AS place FROM seen)""",
        """SELECT idx, shard_id, max(seq_no) AS last_seq_no, coalesce(max(seq_no) FILTER (seq_no = place), -1) AS safe_seq_no
           FROM placed GROUP BY idx, shard_id""",
    ),
    "gaps_between": _with(
        """seen AS (SELECT DISTINCT idx, shard_id, seq_no FROM lagging),
below AS (
  SELECT *, coalesce(lag(seq_no) OVER (PARTITION BY idx, shard_id ORDER BY seq_no), -1) AS last FROM seen)""",
        """SELECT idx, shard_id, last + 1 AS gap_from, seq_no - 1 AS gap_to, seq_no - last - 1 AS missing
           FROM below WHERE seq_no - last > 1""",
    ),
    "live_status": _with(
        """numbered AS (
  SELECT idx, shard_id, timestamp_ms // 2592000000 AS age,
         (row_number() OVER (PARTITION BY idx, shard_id, timestamp_ms // 2592000000 ORDER BY seq_no) - 1) // 1000 AS batch
  FROM captured),
batches AS (SELECT count(*) AS events FROM numbered GROUP BY idx, shard_id, age, batch)""",
        """SELECT 'replication' AS section, 'role' AS metric, 'producer' AS value
UNION ALL SELECT 'replication', 'running', 'false'
UNION ALL SELECT 'replication', 'failed', 'false'
UNION ALL SELECT 'replication', 'last_trigger_rows', CAST(count(*) AS STRING) FROM raw_ops
UNION ALL SELECT 'producer', 'captured_ops', CAST(count(*) AS STRING) FROM captured
UNION ALL SELECT 'producer', 'skipped_ops', CAST(count(*) AS STRING) FROM change_log WHERE idx LIKE '.%'
UNION ALL SELECT 'producer', 'failed_ops', '0'
UNION ALL SELECT 'producer', 'batches_shipped', CAST(count(*) AS STRING) FROM batches
UNION ALL SELECT 'producer', 'events_shipped', CAST(sum(events) AS STRING) FROM batches
UNION ALL SELECT 'producer', 'ship_failures', '0'
UNION ALL SELECT 'replication', 'role', 'consumer'
UNION ALL SELECT 'replication', 'running', 'false'
UNION ALL SELECT 'replication', 'failed', 'false'
UNION ALL SELECT 'replication', 'last_trigger_rows', CAST(count(*) AS STRING) FROM batches
UNION ALL SELECT 'consumer', 'batches_processed', CAST(count(*) AS STRING) FROM batches
UNION ALL SELECT 'consumer', 'batches_failed', '0'
UNION ALL SELECT 'consumer', 'batches_pending', '0'
UNION ALL SELECT 'consumer', 'events_pending', '0'""",
    ),
}
