"""SQL equivalents of the queries, for DuckDB on the same tables."""

from __future__ import annotations

from relayframe import __version__
from relayframe.operators.compaction import MERGE_LIMIT
from workload.fixtures import ALTERED, MANIFEST_CHUNK, RECORD_BYTES, TS_MS
from workload.queries import RESTORE_SINCE, RESTORE_UNTIL

LOG = f"""
log AS (
  SELECT 'events.' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
         event_id AS "offset", ts, (epoch_us(ts) // 1000) AS ts_ms,
         '{{"event_id":' || event_id || '}}' AS "key",
         '{{"event_id":' || event_id || ',"event_type":' || to_json(event_type) || ',"props":'
           || coalesce(to_json(props), 'null') || ',"ts":' || (epoch_us(ts) // 1000) || ',"user_id":' || user_id || '}}' AS "value",
         'version={__version__};relation=public.events' AS headers,
         event_id, user_id, event_type, props
  FROM events
)"""


def bucket(interval: str) -> str:
    return f"strftime(time_bucket(INTERVAL '{interval}', ts, TIMESTAMP '0001-01-01'), '%Y-%m-%d %H:%M:%S')"


MARKS = """
marks AS (
  SELECT topic, "partition", max("offset") // 2 AS mark FROM log WHERE "partition" <> 3 GROUP BY ALL
),
marked AS (
  SELECT log.*, coalesce("offset" <= mark, false) AS replayed
  FROM log LEFT JOIN marks USING (topic, "partition")
)"""

CHUNKS = f"""
manifest AS (
  SELECT topic, {bucket('7 days')} AS bucket, "partition", min("offset") AS min_offset,
         max("offset") AS max_offset, count(*) AS n_rows, count(*) * {RECORD_BYTES} AS size_bytes
  FROM log GROUP BY topic, bucket, "partition", "offset" // {MANIFEST_CHUNK}
)"""


def fold(source: str) -> str:
    """Chunks of ``source`` taken one after the other, with the group each ends up in."""
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY topic, bucket, "partition" ORDER BY min_offset, max_offset) AS rn
  FROM (SELECT topic, bucket, "partition", min_offset, max_offset, min(size_bytes) AS size_bytes, min(n_rows) AS n_rows
        FROM {source} GROUP BY ALL)
),
fold AS (
  SELECT topic, bucket, "partition", rn, min_offset AS low, max_offset AS seen, size_bytes AS size,
         n_rows AS n, false AS stale
  FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.topic, r.bucket, r."partition", r.rn,
         CASE WHEN r.max_offset <= f.seen OR f.size <= {MERGE_LIMIT} THEN f.low ELSE r.min_offset END,
         greatest(f.seen, r.max_offset),
         CASE WHEN r.max_offset <= f.seen THEN f.size WHEN f.size <= {MERGE_LIMIT} THEN f.size + r.size_bytes
              ELSE r.size_bytes END,
         CASE WHEN r.max_offset <= f.seen THEN f.n WHEN f.size <= {MERGE_LIMIT} THEN f.n + r.n_rows
              ELSE r.n_rows END,
         r.max_offset <= f.seen
  FROM fold f JOIN ranked r
    ON r.topic = f.topic AND r.bucket = f.bucket AND r."partition" = f."partition" AND r.rn = f.rn + 1
)"""


CHANGES = """
chg AS (
  SELECT o_orderkey * 10 AS lsn_start, o_orderkey * 10 + 8 AS lsn_end,
         CASE o_orderkey % 10 WHEN 7 THEN 'D' WHEN 8 THEN 'U' WHEN 9 THEN 'O' ELSE 'I' END AS op,
         CASE WHEN o_orderkey % 50 = 0 THEN 'public.pipe_health' ELSE 'public.orders_' || (o_orderkey % 3) END AS relation,
         '{"o_orderkey":' || o_orderkey || '}' AS "key",
         '{"o_custkey":' || o_custkey || ',"o_orderdate":' || epoch_ms(o_orderdate) || ',"o_orderkey":' || o_orderkey AS first_half,
         ',"o_orderstatus":' || to_json(o_orderstatus) || ',"o_totalprice":"' || CAST(o_totalprice AS DECIMAL(18,2)) || '"}' AS last_half,
         '{"o_custkey":null,"o_orderdate":null,"o_orderkey":' || o_orderkey
           || ',"o_orderpriority":null,"o_orderstatus":null,"o_totalprice":null}' AS deleted,
         to_json(o_orderpriority) AS priority
  FROM orders
),
decoded AS (
  SELECT lsn_start, lsn_end, op, relation, "key",
         CASE op WHEN 'D' THEN deleted
           WHEN 'U' THEN first_half || ',"o_orderpriority":null' || last_half
           ELSE first_half || ',"o_orderpriority":' || priority || last_half END AS "value",
         CASE op WHEN 'D' THEN deleted
           WHEN 'U' THEN first_half || last_half
           ELSE first_half || ',"o_orderpriority":' || priority || last_half END AS value_sent
  FROM chg WHERE op <> 'O'
)"""

RESTORABLE = f"""
archived AS (
  SELECT log.*, {bucket('12 hours')} AS bucket FROM log
),
restorable AS (
  SELECT * FROM archived
  WHERE bucket BETWEEN '{RESTORE_SINCE}' AND '{RESTORE_UNTIL}'
    AND topic IN ('events.click', 'events.error', 'events.view')
),
restore_marks AS (
  SELECT topic, "partition", bucket, (min("offset") + max("offset")) // 2 AS mark
  FROM restorable WHERE "partition" <> 3 GROUP BY ALL
),
restoring AS (
  SELECT r.*, coalesce("offset" <= mark, false) AS replayed
  FROM restorable r LEFT JOIN restore_marks USING (topic, "partition", bucket)
)"""


def message_headers(table: str, host: str = "", port: str = "", database: str = "") -> str:
    return f"version={__version__};ts_ms={TS_MS};host={host};port={port};database={database};table={table}"


def chunk_stats(interval: str) -> str:
    return f"""WITH {LOG}
    SELECT topic, {bucket(interval)} AS bucket, "partition", min("offset") AS min_offset,
           max("offset") AS max_offset, count(*) AS n_rows
    FROM log GROUP BY topic, bucket, "partition" """


def case_routes(value: str, routes: list[tuple[str, str]], default: str) -> str:
    branches = " ".join(f"WHEN regexp_matches({value}, '{pattern}') THEN '{to}'" for pattern, to in routes)
    return f"CASE {branches} ELSE {default} END"


_PARTITION_LOG = f"""WITH {LOG} SELECT topic, "partition", "offset", "key", "value", headers FROM log"""

ORACLE: dict[str, str] = {
    "log_shape": f"""WITH {LOG}
        SELECT topic, "partition", "offset", ts_ms, "key", "value", headers FROM log""",
    "snapshot_scan": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_ms(o_orderdate) AS o_orderdate,
               o_orderpriority, count(*) OVER () AS total
        FROM orders WHERE o_totalprice > 1000""",
    "snapshot_count": "SELECT count(*) AS n_rows FROM lineitem WHERE l_quantity > 10",
    "snapshot_envelope": f"""
        SELECT 'cdc.public.orders' AS topic, '{{"o_orderkey":' || o_orderkey || '}}' AS "key",
               '{{"o_custkey":' || o_custkey || ',"o_orderdate":' || epoch_ms(o_orderdate) || ',"o_orderkey":' || o_orderkey
               || ',"o_orderpriority":' || to_json(o_orderpriority) || ',"o_orderstatus":' || to_json(o_orderstatus)
               || ',"o_totalprice":"' || CAST(o_totalprice AS DECIMAL(18,2)) || '","total":' || count(*) OVER () || '}}' AS "value",
               '{message_headers("public.orders", "db", "5432", "shop")}' AS headers
        FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 1000""",
    "snapshot_multi_table": f"""
        SELECT 'public.customer' AS topic, '{{"c_custkey":' || c_custkey || '}}' AS "key",
               '{{"c_acctbal":"' || CAST(c_acctbal AS DECIMAL(18,2)) || '","c_custkey":' || c_custkey || ',"c_mktsegment":'
               || to_json(c_mktsegment) || ',"c_name":' || to_json(c_name) || ',"c_nationkey":' || c_nationkey || '}}' AS "value",
               '{message_headers("public.customer")}' AS headers
        FROM customer
        UNION ALL
        SELECT 'reference', '{{}}', '{{"r_name":' || to_json(r_name) || ',"r_regionkey":' || r_regionkey || '}}',
               '{message_headers("public.region")}'
        FROM region
        UNION ALL
        SELECT 'public.nation', '{{"n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}}',
               '{{"n_name":' || to_json(n_name) || ',"n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}}',
               '{message_headers("public.nation")}'
        FROM nation""",
    "canonical_types": """
        SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
               || '-' || substr(h, 21, 12) AS id,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, epoch_ms(o_orderdate) AS o_orderdate,
               strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS day,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
               || CASE WHEN o_orderkey % 1000 = 0 THEN ''
                  ELSE rtrim('.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), '0') END || 'Z' AS zoned
        FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders)""",
    "pk_lookup": """
        SELECT 'sales' AS table_schema, 't_' || c_custkey AS table_name, 'id' AS column_name FROM customer WHERE c_custkey % 7 <> 0
        UNION ALL
        SELECT 'audit', 't_' || c_custkey, unnest(['id', 'version']) FROM customer WHERE c_custkey % 7 <> 0""",
    "table_name_split": """
        SELECT schema_name || '.t_' || c_custkey AS full_name, schema_name, 't_' || c_custkey AS table_name
        FROM customer, (VALUES ('sales'), ('audit')) s(schema_name)""",
    "change_describe": f"""WITH {CHANGES}
        SELECT lsn_start, lsn_end, op, relation,
          CASE op WHEN 'D' THEN 'o_orderkey:t,o_custkey:n,o_orderstatus:n,o_totalprice:n,o_orderdate:n,o_orderpriority:n'
            WHEN 'U' THEN 'o_orderkey:t,o_custkey:t,o_orderstatus:t,o_totalprice:t,o_orderdate:t,o_orderpriority:u'
            WHEN 'I' THEN 'o_orderkey:t,o_custkey:t,o_orderstatus:t,o_totalprice:t,o_orderdate:t,o_orderpriority:t' END AS cells
        FROM chg""",
    "change_filter": f"""WITH {CHANGES}
        SELECT lsn_start, op, relation FROM chg
        WHERE relation IN ('public.orders_0', 'public.orders_2') AND op IN ('I', 'U')""",
    "change_decode": f"""WITH {CHANGES} SELECT lsn_start, "key", "value", value_sent FROM decoded""",
    "change_messages": f"""WITH {CHANGES}
        SELECT 'cdc.public.orders' AS topic, "key", "value",
               'version={__version__};lsn=' || format('{{:X}}/{{:X}}', lsn_start >> 32, lsn_start & 4294967295)
               || ';ts_ms={TS_MS};host=db;port=5432;database=shop;relation=' || relation || ';op=' || op AS headers
        FROM decoded WHERE relation <> 'public.pipe_health'""",
    "change_position": f"WITH {CHANGES} SELECT max(lsn_end) AS position FROM chg",
    "change_log_read": f"""WITH {CHANGES}
        SELECT lsn_start, lsn_end, op, relation FROM chg WHERE lsn_start >= 5000 AND op <> 'O'""",
    "route_topic": f"""
        WITH named AS (SELECT event_id, 'public.' || event_type || '_' || (user_id % 5) AS rel FROM events)
        SELECT event_id,
          {case_routes('rel', [(r'^public\.(click|view)_\d$', 'cdc.engagement'), (r'^public\.error_[0-2]$', 'errors'), (r'^public\.', 'public.rest')], 'rel')} AS topic,
          {case_routes('rel', [(r'^public\.(click|view)_\d$', 'cdc.engagement'), (r'^public\.error_[0-2]$', 'cdc.errors'), (r'^public\.', 'cdc.public.rest')], "'cdc.' || rel")} AS prefixed_topic
        FROM named""",
    "route_table": f"""WITH {LOG}
        SELECT "offset", {case_routes('topic', [(r'events\.(click|view)', 'engagement'), (r'events\..*', 'other')], 'topic')} AS target,
               {case_routes('topic', [(r'events\.(click|view)', 'engagement')], 'topic')} AS target_or_topic
        FROM log""",
    "json_decode": "SELECT event_id, user_id, event_type, (epoch_us(ts) // 1000) AS ts_ms FROM events",
    "json_zero_fill": f"""WITH {LOG}
        SELECT topic, event_id, user_id, event_type, ts_ms, CAST(0 AS INTEGER) AS missing_int, '' AS missing_text,
               CAST(NULL AS VARCHAR) AS missing_note
        FROM log""",
    "json_time_formats": f"""WITH {LOG}
        SELECT "offset", ts_ms AS rfc3339_ms, ts_ms // 1000 * 1000 AS seconds_ms, ts_ms AS milli_ms FROM log""",
    "json_bytes": """
        SELECT event_id,
               CASE event_id % 4 WHEN 0 THEN props
                 WHEN 1 THEN '{"z": ' || user_id || ', "a":1.50,  "m":1e3, "k": [' || event_id || ', 0.0]}'
                 WHEN 2 THEN user_id || '.00' END AS b
        FROM events""",
    "json_dates": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS rfc3339_day,
               strftime(o_orderdate, '%Y-%m-%d') AS seconds_day, strftime(o_orderdate, '%Y-%m-%d') AS milli_day
        FROM orders""",
    "json_quarantine": f"""WITH {LOG}
        SELECT topic, "offset", CASE WHEN "offset" % 10 <> 0 THEN user_id END AS user_id, "offset" % 10 = 0 AS malformed
        FROM log""",
    "hook_transform": """
        SELECT event_id, unnest(['first', upper(event_type)]) AS label FROM events WHERE event_type <> 'view'""",
    "replay_filter": f"""WITH {LOG}, {MARKS} SELECT topic, "partition", "offset" FROM marked WHERE NOT replayed""",
    "replay_resume": f"""WITH {LOG}, {MARKS}
        SELECT topic, "partition", min("offset") AS first_offset, count(*) AS n_rows
        FROM marked WHERE NOT replayed GROUP BY topic, "partition" """,
    "skipped_ranges": f"""WITH {LOG}, {MARKS}
        SELECT topic, "partition", min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS n_skipped
        FROM marked WHERE replayed GROUP BY topic, "partition" """,
    "offset_state": f"""WITH {LOG}, {MARKS},
        both_sides AS (
          SELECT topic, "partition", mark * ("partition" + 1) AS "offset" FROM marks
          UNION ALL
          SELECT topic, "partition", "offset" FROM log)
        SELECT topic, "partition", max("offset") AS "offset" FROM both_sides GROUP BY topic, "partition" """,
    "topics_distinct": f"WITH {LOG} SELECT DISTINCT topic FROM log",
    "batch_sizes": f"""WITH {LOG}
        SELECT topic, "offset" // 10000 AS batch, count(*) AS n_rows FROM log GROUP BY topic, batch""",
    "archive_chunks": chunk_stats("1 hour"),
    "archive_chunks_7h": chunk_stats("7 hours"),
    "archive_chunks_7d": chunk_stats("7 days"),
    "archive_chunks_subsecond": f"""WITH {LOG},
        chunks AS (SELECT DISTINCT topic, strftime(ts, '%Y-%m-%d %H:%M:%S') AS bucket, "partition" FROM log)
        SELECT topic, count(*) AS n_chunks, min(bucket) AS first_bucket, max(bucket) AS last_bucket
        FROM chunks GROUP BY topic""",
    "archive_rows": f"""WITH {LOG}
        SELECT topic, {bucket('1 hour')} AS bucket, "partition", "offset", "key", "value", headers FROM log""",
    "archive_prev_chunk": f"""WITH {LOG}, {CHUNKS}
        SELECT topic, bucket, "partition", min_offset, max_offset, n_rows,
               lag(min_offset) OVER w AS prev_min_offset, lag(max_offset) OVER w AS prev_max_offset
        FROM manifest WINDOW w AS (PARTITION BY topic, bucket, "partition" ORDER BY min_offset)""",
    "chunk_paths": f"""WITH {LOG},
        chunks AS (SELECT topic, {bucket('1 hour')} AS bucket, "partition", min("offset") AS min_offset,
                          max("offset") AS max_offset
                   FROM log GROUP BY topic, bucket, "partition")
        SELECT 'file:/archive/' || topic || '/' || replace(bucket, ' ', '%20') || '/' || "partition" || '/'
               || lpad(CAST(min_offset AS VARCHAR), 18, '0') || '-' || lpad(CAST(max_offset AS VARCHAR), 18, '0') || '.gz' AS path,
               topic, bucket, "partition", min_offset, max_offset
        FROM chunks""",
    "compaction_plan": f"""WITH RECURSIVE {LOG}, {CHUNKS}, {fold('manifest')}
        SELECT topic, bucket, "partition", low AS min_offset, max(seen) AS max_offset, max(size) AS size_bytes,
               max(n) AS n_rows, count(*) AS n_chunks
        FROM fold WHERE NOT stale GROUP BY topic, bucket, "partition", low""",
    "compaction_stale": f"""WITH RECURSIVE {LOG}, {CHUNKS},
        repeated AS (
          SELECT topic, bucket, "partition", min_offset, max_offset, size_bytes, n_rows FROM manifest
          UNION ALL
          SELECT topic, bucket, "partition", (min_offset + max_offset) // 2, max_offset, 500000, n_rows FROM manifest),
        {fold('repeated')}
        SELECT topic, bucket, "partition", count(*) FILTER (stale) AS n_stale, count(*) FILTER (NOT stale) AS n_kept,
               count(DISTINCT low) FILTER (NOT stale) AS n_groups
        FROM fold GROUP BY topic, bucket, "partition" """,
    "restore_range": f"""WITH {LOG}, {RESTORABLE}
        SELECT topic, "partition", "offset", "key", "value", headers FROM restoring WHERE NOT replayed""",
    "restore_counters": f"""WITH {LOG}, {RESTORABLE}
        SELECT topic, count(*) FILTER (NOT replayed) AS restored,
               count(*) FILTER (replayed) + count(*) AS skipped
        FROM restoring GROUP BY topic""",
    "restore_marks": f"""WITH {LOG}, {RESTORABLE}
        SELECT topic, "partition", bucket, max("offset") AS "offset" FROM restorable GROUP BY topic, "partition", bucket""",
    "archive_round_trip": _PARTITION_LOG,
    "archive_compatible": _PARTITION_LOG,
    "archive_manifest": f"""WITH {LOG}
        SELECT topic, {bucket('7 days')} AS bucket, "partition", min("offset") AS min_offset,
               max("offset") AS max_offset, count(*) AS n_rows, true AS has_size
        FROM log GROUP BY topic, bucket, "partition" """,
    "archive_compacted": f"""WITH {LOG}
        SELECT topic, {bucket('7 days')} AS bucket, "partition", count(*) AS n_rows, CAST(sum("offset") AS BIGINT) AS offset_sum
        FROM log GROUP BY topic, bucket, "partition" """,
    "table_sink_replay": f"""WITH {LOG}
        SELECT topic, "partition", "offset", event_id, user_id, event_type, ts_ms,
               CASE WHEN topic IN ('events.click', 'events.view') THEN 'engagement' ELSE 'other' END AS target
        FROM log""",
    "table_sink_retry": "SELECT event_id, user_id, event_type, (epoch_us(ts) // 1000) AS ts_ms FROM events",
    "stream_archive": f"""WITH {LOG}
        SELECT topic, {bucket('7 days')} AS bucket, "partition", "offset", "key", "value" FROM log""",
}
ORACLE["change_messages_known"] = ORACLE["change_messages"]


def _order_value(with_priority: str) -> str:
    """The JSON text of an order's change, keys in order."""
    return f"""'{{"big":' || CASE WHEN o_totalprice > 200000 THEN 'true' ELSE 'false' END
        || ',"day":"' || strftime(o_orderdate, '%Y-%m-%dT00:00:00Z')
        || '","id":"' || CAST(CAST(md5(CAST(o_orderkey AS VARCHAR)) AS UUID) AS VARCHAR)
        || '","o_orderkey":' || o_orderkey || ',"price":"' || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) || '"'
        || {with_priority} || ',"zoned":"' || strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') || '"}}'"""


_PRIORITY = """',"priority":' || to_json(o_orderpriority)"""
ORACLE["change_binary"] = f"""
    SELECT o_orderkey * 10 AS lsn_start, 'public.orders_' || (o_orderkey % 3) AS topic, {_order_value(_PRIORITY)} AS value
    FROM orders"""
ORACLE["change_wide"] = ORACLE["change_binary"]
ORACLE["change_relation_altered"] = f"""
    SELECT o_orderkey * 10 AS lsn_start, 'public.orders' AS topic,
           {_order_value(f"CASE WHEN o_orderkey * 10 BETWEEN {ALTERED[0]} AND {ALTERED[1] - 1} THEN '' ELSE {_PRIORITY} END")} AS value
    FROM orders"""
ORACLE["change_stream_altered"] = ORACLE["change_looked_up"] = ORACLE["change_relation_altered"]
ORACLE["table_sink_repeat_in_batch"] = ORACLE["table_sink_retry"]
ORACLE["table_sink_catalog"] = """
    SELECT event_id, user_id, event_type, (epoch_us(ts) // 1000) AS ts_ms, CAST(0 AS INTEGER) AS missing_int,
           '' AS missing_text, CAST(NULL AS VARCHAR) AS missing_note
    FROM events"""
ORACLE["archive_compatible_redelivery"] = _PARTITION_LOG
ORACLE["archive_base64_restore"] = f"""WITH {LOG}
    SELECT topic, "partition", "offset", ts_ms, "key", "value" FROM log"""
ORACLE["archive_compacted_timestamps"] = ORACLE["archive_base64_restore"]
ORACLE["restore_resumed"] = _PARTITION_LOG
ORACLE["changes_resumed"] = ORACLE["change_binary"]
ORACLE["archive_compact_job"] = _PARTITION_LOG
ORACLE["archive_committed"] = _PARTITION_LOG
ORACLE["archive_committed_range"] = f"""WITH {LOG}, chunks AS (
        SELECT topic, {bucket('12 hours')} AS bucket, "partition", "offset" FROM log)
        SELECT topic, bucket, "partition", min("offset") AS min_offset, max("offset") AS max_offset, count(*) AS n_rows
        FROM chunks WHERE bucket BETWEEN '{RESTORE_SINCE}' AND '{RESTORE_UNTIL}' GROUP BY topic, bucket, "partition" """
