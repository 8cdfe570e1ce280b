"""The same results in plain SQL over the supplied tables.

Written from the meaning of each operator, not from its implementation: verdicts on
broken payloads, for example, come from the remainders that broke them.
"""

from __future__ import annotations

_K = "CAST(NULLIF(regexp_extract(props, '-?[0-9]+'), '') AS BIGINT)"


def _flat(time: str = "ts", wiki: str = "event_type") -> str:
    return f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, {time} AS event_dt, {wiki} AS wiki,
           CASE WHEN event_id % 4 = 0 THEN 'log' ELSE 'edit' END AS "type",
           {_K} AS namespace, 'Page ' || {_K} AS title,
           CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) END AS "user",
           user_id % 5 = 0 AS bot, event_type || '.example.org' AS server_name,
           {_K} AS length_old, {_K} + 7 AS length_new,
           event_id * 2 AS revision_old, event_id * 2 + 1 AS revision_new, props AS raw_json
    FROM events"""


_BLANK = "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN NULL ELSE event_type END"


def _deliveries(wiki: str = "event_type") -> str:
    older = _flat("ts - INTERVAL 5 SECOND", "'stale'")
    return f"""raw_nrt AS ({_flat(wiki=wiki)}
    UNION ALL {_flat(wiki=wiki)} WHERE event_id % 10 = 0
    UNION ALL {older} WHERE event_id % 15 = 0)"""


# Copies of one delivery are identical, so any of them may stand for the event.
_LATEST = """latest AS (
    SELECT * FROM raw_nrt
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_dt DESC) = 1)"""

_HOURLY = """SELECT wiki, date_trunc('hour', event_dt) AS hour_ts, count(*) AS edit_count,
       count(*) FILTER (bot) AS bot_edit_count, count(DISTINCT "user") AS distinct_editors
FROM latest {where} GROUP BY ALL"""

_VIEWS = """views AS (
    SELECT make_date(year(l_shipdate), 1, 1) AS date, l_returnflag AS project,
           l_linestatus AS access, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS views
    FROM lineitem GROUP BY ALL)"""

_RANKED = f"""{_VIEWS}, raw_batch AS (
    SELECT date, project, access, CAST(l_partkey AS VARCHAR) AS article, views,
           row_number() OVER (PARTITION BY date, project, access
                              ORDER BY views DESC, l_partkey) AS rank,
           CAST(date + 1 AS TIMESTAMP) AS fetched_at
    FROM views)"""

_REPORTED = f"""{_VIEWS}, reported AS (
    SELECT date, project, access, CAST(l_partkey AS VARCHAR) AS article, views,
           l_partkey % 1000 + 1 AS rank
    FROM views WHERE (l_partkey // 1000 + year(date)) % 9 NOT IN (7, 8))"""

_PAYLOADS = f"""whole AS (
    SELECT *, {_K} AS k,
        '{{"meta":{{"id":"ev-' || event_id || '","dt":'
        || CASE WHEN event_id % 41 = 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
                ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"' END
        || ',"domain":"example.org"}},"id":' || event_id
        || CASE WHEN event_id % 23 = 0 THEN ',"type":5' ELSE ',"type":"edit"' END
        || ',"namespace":' || CASE WHEN event_id % 31 = 0 THEN '"' || {_K} || '"'
                                   ELSE CAST({_K} AS VARCHAR) END
        || ',"title":"Page ' || {_K} || '","user":"u' || user_id || '","bot":'
        || CASE WHEN event_id % 29 = 0 THEN 'null' WHEN event_id % 37 = 0 THEN '"yes"'
                WHEN user_id % 5 = 0 THEN 'true' ELSE 'false' END
        || CASE WHEN event_id % 17 = 0 THEN '' ELSE ',"wiki":"' || event_type || '"' END
        || ',"length":{{"old":' || {_K} || ',"new":' || ({_K} + 7) || '}}}}'
        || CASE WHEN event_id % 43 = 0 THEN ' trailing' ELSE '' END AS full_line
    FROM events),
payloads AS (
    SELECT *, CASE WHEN event_id % 19 = 0 THEN left(full_line, length(full_line) - 10)
                   ELSE full_line END AS raw_line,
        CASE WHEN event_id % 19 = 0 OR event_id % 43 = 0 THEN 'not a JSON document'
             ELSE concat_ws('; ',
                CASE WHEN event_id % 17 = 0 THEN 'wiki: missing' END,
                CASE WHEN event_id % 23 = 0 THEN 'type: not a string' END,
                CASE WHEN event_id % 29 = 0 THEN 'bot: not true or false' END)
        END AS error
    FROM whole),
flat AS (
    SELECT 'ev-' || event_id AS event_id,
           CASE WHEN event_id % 41 = 0 THEN date_trunc('second', ts) ELSE ts END AS event_dt,
           event_type AS wiki, 'edit' AS "type", k AS namespace, 'Page ' || k AS title,
           'u' || user_id AS "user", event_id % 37 = 0 OR user_id % 5 = 0 AS bot,
           CAST(NULL AS VARCHAR) AS server_name, k AS length_old, k + 7 AS length_new,
           CAST(NULL AS BIGINT) AS revision_old, CAST(NULL AS BIGINT) AS revision_new,
           raw_line AS raw_json, strftime(ts, '%Y-%m-%d') AS dt
    FROM payloads WHERE error = '')"""

_LISTING = """listing AS (
    SELECT 'buffer/dt=' || strftime(ts, '%Y-%m-%d') || '/part-' || (event_id % 7)
               || '.parquet' AS file_path,
           event_id % 7 AS part, max(ts) AS modified_at, count(*) AS row_count
    FROM events GROUP BY ALL),
manifest AS (
    SELECT file_path, modified_at + INTERVAL 1 HOUR AS loaded_at, row_count
    FROM listing WHERE part < 4)"""

_LAG = """seen AS (
    SELECT CAST(event_id % 4 AS INTEGER) AS part, event_id // 4 AS pos FROM events),
lag AS (
    SELECT part, max(pos) + 1 - CASE WHEN part = 3 THEN min(pos)
           ELSE CAST(floor(max(pos) * (part + 1) / 5) AS BIGINT) END AS lag
    FROM seen GROUP BY part)"""

_ARRIVALS = """arrivals AS (
    SELECT event_type AS source, ts AS event_dt,
           ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL 5430 SECOND
                     ELSE INTERVAL 30 SECOND END AS arrived_at
    FROM events)"""

ORACLES: dict[str, str] = {
    "stg_events_nrt": f"""WITH {_deliveries()}, {_LATEST}
SELECT event_id, event_dt, wiki, "type", namespace, title, "user", bot, server_name,
       length_new, revision_new
FROM latest""",
    "drifting_events": f"""WITH {_deliveries()}
SELECT event_id, min(event_dt) AS earliest, max(event_dt) AS latest
FROM raw_nrt GROUP BY event_id HAVING count(DISTINCT event_dt) > 1""",
    "edits_hourly": f"WITH {_deliveries()}, {_LATEST} {_HOURLY.format(where='')}",
    "edits_hourly_interval": f"""WITH {_deliveries()}, {_LATEST}
{_HOURLY.format(where="WHERE event_dt >= TIMESTAMP '2024-01-10' AND event_dt < TIMESTAMP '2024-01-11'")}""",
    "edits_hourly_backfill": f"""WITH {_deliveries()}, {_LATEST}
{_HOURLY.format(where="WHERE event_dt < date_trunc('hour', (SELECT max(ts) FROM events) + INTERVAL 1 HOUR)")}""",
    "stg_events_batch": f"""WITH {_RANKED}
SELECT date, project, access, article, views, rank, fetched_at FROM raw_batch""",
    "pageviews_top": f"""WITH {_RANKED}
SELECT date, project, access, article, views, rank FROM raw_batch WHERE rank <= 100""",
    "missing_intervals": """SELECT hour_ts FROM (
    SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                                  INTERVAL 1 HOUR)) AS hour_ts FROM events)
WHERE hour_ts NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE hour(ts) % 6 <> 0)""",
    "late_events": f"""WITH {_ARRIVALS}, profile AS (
    SELECT date_diff('hour', event_dt, arrived_at) AS hours_late, count(*) AS events
    FROM arrivals GROUP BY ALL)
SELECT hours_late, events, hours_late <= 0 AS counted_without_lookback,
       hours_late <= 1 AS counted
FROM profile""",
    "dirty_intervals": """WITH filled AS (SELECT DISTINCT date_trunc('hour', ts) AS hour_ts FROM events),
moved AS (SELECT ts FROM events WHERE event_id % 50 = 0)
SELECT hour_ts FROM filled WHERE hour_ts IN (
    SELECT date_trunc('hour', ts) FROM moved UNION ALL SELECT date_trunc('hour', ts + INTERVAL 2 HOUR) FROM moved)""",
    "expired_deliveries": """SELECT CAST(event_id AS VARCHAR) AS event_id,
       date_trunc('millisecond', ts - INTERVAL 5 SECOND) AS event_dt, event_type AS wiki,
       strftime(ts - INTERVAL 5 SECOND, '%Y-%m-%d') AS dt
FROM events WHERE event_id % 15 = 0 AND ts - INTERVAL 5 SECOND < TIMESTAMP '2024-01-15'""",
    "validate_events": f"""WITH {_PAYLOADS}
SELECT event_id AS event_no, error = '' AS valid, error FROM payloads""",
    "flatten_events": f"WITH {_PAYLOADS} SELECT * FROM flat",
    "flush_tallies": f"""WITH {_PAYLOADS}
SELECT count(*) FILTER (error = '') AS accepted, count(*) FILTER (error <> '') AS rejected
FROM payloads""",
    "dead_letter": f"""WITH {_PAYLOADS}
SELECT '2024-02-01T12:00:00+00:00' AS received_at, error, raw_line, '2024-02-01' AS dt
FROM payloads WHERE error <> ''""",
    "sse_decode": """WITH frames AS (
    SELECT event_id // 1000 AS connection, event_id % 1000 AS frame, event_id, props,
           CASE WHEN event_id % 4 = 0 THEN event_type END AS event,
           last_value(CASE WHEN event_id % 3 <> 1 AND event_id % 21 <> 0 THEN event_id END
                      IGNORE NULLS) OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS id
    FROM events)
SELECT connection, frame, CAST(id AS VARCHAR) AS id, event,
       props || CASE WHEN event_id % 6 = 0 THEN chr(10) || ' second of ' || event_id
                     ELSE '' END AS data
FROM frames WHERE event_id % 9 <> 0""",
    "topic_records": f"""WITH {_PAYLOADS}
SELECT CASE WHEN event_id % 3 <> 1 THEN CAST(event_id AS VARCHAR) END AS key,
       md5(raw_line) AS value_md5, CAST(strlen(raw_line) AS BIGINT) AS value_bytes,
       'recent-changes' AS topic
FROM payloads""",
    "pageviews_explode": f"WITH {_REPORTED} SELECT * FROM reported",
    "request_plan": """WITH targets AS (
    SELECT l_returnflag AS project, l_linestatus AS access,
           CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day
    FROM lineitem GROUP BY ALL),
days AS (
    SELECT project, access, CAST(unnest(generate_series(
               CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY))
               AS DATE) AS date
    FROM targets)
SELECT project, access, date, 'https://reports.example.org/v1/metrics/pageviews/top/'
       || project || '/' || access || '/' || strftime(date, '%Y/%m/%d') AS url
FROM days""",
    "raw_batch_rows": f"""WITH {_REPORTED}
SELECT *, TIMESTAMP '2024-02-01 06:00:00' AS fetched_at, strftime(date, '%Y%m') AS month
FROM reported""",
    "scan_since": f"""WITH flat AS ({_flat()})
SELECT event_id, event_dt, wiki, bot, strftime(event_dt, '%Y-%m-%d') AS dt
FROM flat WHERE event_dt >= TIMESTAMP '2024-01-15'""",
    "file_inventory": """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS row_count, true AS all_filled
FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY ALL""",
    "load_new_files": f"""WITH flat AS ({_flat()})
SELECT * REPLACE (date_trunc('millisecond', event_dt) AS event_dt),
       strftime(event_dt, '%Y-%m-%d') AS dt
FROM flat""",
    "manifest_rows": """SELECT strftime(ts, '%Y-%m-%d') AS dt,
       TIMESTAMP '2024-02-01 12:00:00' AS loaded_at, count(*) AS row_count
FROM events GROUP BY ALL""",
    "new_files": f"""WITH {_LISTING}
SELECT file_path FROM listing WHERE file_path NOT IN (SELECT file_path FROM manifest)""",
    "loaded_since": f"""WITH {_LISTING}
SELECT * FROM manifest WHERE loaded_at >= TIMESTAMP '2024-01-15'""",
    "load_batches": f"""WITH {_LISTING}
SELECT file_path, CAST((row_number() OVER (ORDER BY file_path) - 1) // 40 AS BIGINT) AS batch_no
FROM listing""",
    "observed_new_files": f"""WITH {_LISTING}, current AS (
    SELECT file_path FROM listing WHERE regexp_extract(file_path, 'dt=([^/]+)', 1) >= '2024-01-15')
SELECT file_path, file_path NOT IN (SELECT file_path FROM manifest) AS is_new FROM current""",
    "reported_files": f"""WITH {_LISTING}
SELECT file_path, CAST(CASE WHEN part < 4 THEN 0 ELSE 1 END AS INTEGER) AS look FROM listing""",
    "reported_changes": f"""WITH {_VIEWS}
SELECT max_fetched_at, row_count, look FROM (
    SELECT CAST(max(date) + 1 AS TIMESTAMP) AS max_fetched_at, count(*) AS row_count, 0 AS look
    FROM views WHERE year(date) < 1998
    UNION ALL
    SELECT CAST(max(date) + 1 AS TIMESTAMP), count(*), 2 FROM views)
WHERE row_count > 0""",
    "cleanup_candidates": f"""WITH {_LISTING}
SELECT l.file_path FROM listing l JOIN manifest m ON l.file_path = m.file_path
WHERE l.modified_at <= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
    "ttl_retained": f"""WITH {_deliveries()}
SELECT event_id, event_dt FROM raw_nrt
WHERE CAST(event_dt AS DATE) + INTERVAL 5 DAY > (SELECT max(ts) FROM events)""",
    "next_offsets": """SELECT 'recent-changes' AS topic, CAST(event_id % 4 AS INTEGER) AS partition,
       max(event_id // 4) + 1 AS next_offset
FROM events GROUP BY ALL""",
    "consumer_lag": f"""WITH {_LAG}
SELECT 'recent-changes' AS topic, part AS partition, CAST(lag AS BIGINT) AS lag FROM lag
UNION ALL SELECT 'recent-changes', NULL, CAST(sum(lag) AS BIGINT) FROM lag""",
    "bounded_replay": """SELECT event_id, ts AS event_dt FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 900 SECOND""",
    "resume_positions": """WITH stored AS (
    SELECT user_id, CAST(max(event_id) AS VARCHAR) AS last_event_id,
           CASE WHEN user_id % 7 <> 0 THEN CAST(floor((epoch_us((SELECT max(ts) FROM events))
                - epoch_us(max(ts))) / 1000000) AS BIGINT) END AS age_seconds
    FROM events GROUP BY user_id)
SELECT *, CASE WHEN age_seconds IS NULL OR age_seconds <= 21600 THEN last_event_id END AS resume_id,
       CASE WHEN age_seconds IS NULL OR age_seconds <= 21600 THEN 'stored' ELSE 'latest' END AS start_at
FROM stored""",
    "audit_not_null_wiki": f"""WITH {_deliveries(_BLANK)}, {_LATEST}
{_HOURLY.format(where="WHERE wiki IS NULL OR wiki = ''")}""",
    "audit_check": f"""WITH {_deliveries(_BLANK)}, {_LATEST}, bad AS (
    {_HOURLY.format(where="WHERE wiki IS NULL OR wiki = ''")})
SELECT 'not_null_wiki' AS "check", count(*) = 0 AS passed, count(*) AS value,
       CAST(0 AS BIGINT) AS threshold
FROM bad""",
    "backlog_check": f"""WITH {_LISTING}, waiting AS (
    SELECT count(*) AS n FROM listing WHERE file_path NOT IN (SELECT file_path FROM manifest))
SELECT 'backlog_files' AS "check", n <= 200 AS passed, n AS value,
       CAST(200 AS BIGINT) AS threshold
FROM waiting""",
    "lag_check": f"""WITH {_LAG}, total AS (SELECT CAST(sum(lag) AS BIGINT) AS n FROM lag)
SELECT 'consumer_lag' AS "check", n <= 5000 AS passed, n AS value,
       CAST(5000 AS BIGINT) AS threshold
FROM total""",
    "raw_batch_freshness": f"""WITH {_VIEWS}
SELECT CAST(max(date) + 1 AS TIMESTAMP) AS max_fetched_at, count(*) AS row_count,
       CASE WHEN count(*) = 0 THEN 'empty'
            WHEN CAST(max(date) + 1 AS TIMESTAMP) = TIMESTAMP '2024-02-01 06:00:00'
            THEN 'unchanged' ELSE 'changed' END AS status
FROM views""",
    "source_freshness": f"""WITH {_ARRIVALS}
SELECT source, max(arrived_at) AS last_arrival,
       (epoch_us((SELECT max(ts) FROM events) + INTERVAL 2 HOUR) - epoch_us(max(arrived_at)))
           / 1000000 AS age_seconds
FROM arrivals GROUP BY source""",
    "grain_violations": f"""WITH {_deliveries()}
SELECT event_id, count(*) AS copies FROM raw_nrt GROUP BY event_id HAVING count(*) > 1""",
    "batch_grain_violations": f"""WITH {_VIEWS}
SELECT date, project, access, CAST(l_partkey AS VARCHAR) AS article, CAST(2 AS BIGINT) AS copies
FROM views WHERE l_partkey % 50 = 0""",
    "touched_grain_violations": f"""WITH {_VIEWS}
SELECT date, project, access, CAST(l_partkey AS VARCHAR) AS article, CAST(2 AS BIGINT) AS copies
FROM views WHERE l_partkey % 50 = 0""",
    "touched_audit": f"""WITH {_deliveries(_BLANK)}, {_LATEST}
{_HOURLY.format(where="WHERE wiki IS NULL OR wiki = ''")}""",
    "landed_events": f"WITH {_PAYLOADS} SELECT * FROM flat",
    "landed_offsets": """SELECT 'recent-changes' AS topic, CAST(event_id % 4 AS INTEGER) AS partition,
       max(event_id // 4) + 1 AS next_offset
FROM events GROUP BY ALL""",
    "stream_edits_hourly": f"WITH {_deliveries()}, {_LATEST} {_HOURLY.format(where='')}",
    "report_errors": f"""WITH {_VIEWS}
SELECT DISTINCT date, project, access, 'missing items' AS error
FROM views WHERE (l_partkey // 1000 + year(date)) % 9 = 8""",
    "target_days": """SELECT DISTINCT CAST(l_shipdate AS DATE) AS today, CAST(l_shipdate AS DATE) - 1 AS target,
       strftime(CAST(l_shipdate AS DATE), '%Y%m%d') AS today_label,
       strftime(CAST(l_shipdate AS DATE) - 1, '%Y%m') AS target_month
FROM lineitem""",
    "raw_file_order": "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS out_of_order FROM events",
}
