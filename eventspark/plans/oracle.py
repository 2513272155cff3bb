"""DuckDB spellings of the registered queries (the correctness oracle).

The tables are pre-registered as views by the checker.  The CTEs below restate the views of
``eventspark.sources.views`` in DuckDB SQL; every computed column carries the same alias as on the Spark side.
"""

from __future__ import annotations

# DuckDB versions of the typed views (same definitions as eventspark.sources.views).
V_BEHAVIORS = """behaviors AS (
  SELECT user_id, CAST(props->>'$.k' AS BIGINT) AS item_id, event_type AS category_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, ts, event_id
  FROM events)"""
V_READINGS = """readings AS (
  SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, ts, value AS temperature, event_id FROM events)"""
V_LOGINS = """logins AS (
  SELECT user_id, '10.0.0.' || CAST(CAST(props->>'$.k' AS BIGINT) AS VARCHAR) AS ip_address,
         CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, ts, event_id
  FROM events)"""
V_ORDER_EVENTS = """order_events AS (
  SELECT 'order_' || CAST(user_id AS VARCHAR) AS order_id,
         CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS order_type, ts, event_id
  FROM events WHERE event_type IN ('signup', 'purchase'))"""
V_PAY_EVENTS = """pay_events AS (
  SELECT 'order_' || CAST(user_id AS VARCHAR) AS order_id,
         CASE WHEN CAST(props->>'$.k' AS BIGINT) % 2 = 0 THEN 'weixin' ELSE 'alipay' END AS channel, ts, event_id
  FROM events WHERE event_type = 'purchase')"""
V_SMOKE = """smoke_levels AS (
  SELECT ts, CASE WHEN value > 20 THEN 'HIGH' ELSE 'LOW' END AS level, event_id
  FROM events WHERE event_type = 'error')"""
V_SWITCHES = """switches AS (
  SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, ts, event_id FROM events WHERE event_type = 'signup')"""
V_ARRIVALS = """arrivals AS (
  SELECT event_type AS key, ts, ts + to_seconds(CAST((event_id * 7919) % 7200 AS BIGINT)) AS arrival, event_id
  FROM events)"""


def with_views(*defs: str) -> str:
    return "WITH " + ",\n".join(defs) + "\n"


# Sliding windows in DuckDB: a row at ts belongs to the windows ending at bucket(ts)+slide, ..., bucket(ts)+size.
def sliding_ends(ts: str, size: str, slide: str) -> str:
    return (f"unnest(generate_series(time_bucket(INTERVAL '{slide}', {ts}) + INTERVAL '{slide}', "
            f"time_bucket(INTERVAL '{slide}', {ts}) + INTERVAL '{size}', INTERVAL '{slide}'))")


ORACLE: dict[str, str] = {}

ORACLE["hot_items_topn"] = with_views(V_BEHAVIORS) + f"""
, counts AS (
  SELECT item_id, window_end, count(*) AS cnt
  FROM (SELECT item_id, {sliding_ends('ts', '1 hour', '5 minutes')} AS window_end FROM behaviors WHERE behavior = 'pv')
  GROUP BY item_id, window_end)
SELECT window_end, item_id, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id ASC) AS rank FROM counts)
WHERE rank <= 3
"""

# --- sources and row transforms ---

ORACLE["readings_scan"] = with_views(V_READINGS) + "SELECT id, ts, temperature, event_id FROM readings"

ORACLE["parse_keyed_lines"] = """
SELECT event_id, event_type AS key, make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts FROM events
"""

ORACLE["map_id"] = with_views(V_READINGS) + "SELECT id FROM readings"

ORACLE["filter_positive"] = with_views(V_READINGS) + "SELECT id, ts, temperature FROM readings WHERE temperature > 32.0"

ORACLE["filter_pv"] = with_views(V_BEHAVIORS) + """
SELECT user_id, item_id, category_id, behavior, ts FROM behaviors WHERE behavior = 'pv'"""

ORACLE["replicate_by_value"] = """
SELECT event_id, event_type, unnest(range(CASE WHEN event_type = 'view' THEN 1 WHEN event_type = 'click' THEN 2
                                              ELSE 0 END)) AS copy_no
FROM events"""

ORACLE["side_output_split"] = with_views(V_READINGS) + """
SELECT id, ts, temperature, event_id, 'main' AS tag FROM readings
UNION ALL
SELECT id, ts, temperature, event_id, 'side' AS tag FROM readings WHERE temperature < 32.0"""

ORACLE["union_all"] = """
SELECT user_id AS key, ts, event_id FROM events WHERE event_type = 'click'
UNION ALL
SELECT user_id AS key, ts, event_id FROM events WHERE event_type = 'view'"""

ORACLE["co_flat_map"] = """
SELECT user_id AS k, CAST(event_id AS VARCHAR) AS v, 'left' AS side, unnest(range(2)) AS copy_no
FROM events WHERE event_type = 'click'
UNION ALL
SELECT user_id AS k, CAST(event_id AS VARCHAR) AS v, 'right' AS side, CAST(0 AS BIGINT) AS copy_no
FROM events WHERE event_type = 'view'"""

ORACLE["partition_scoped_map"] = "SELECT event_id, user_id, user_id + 1 AS user_id_plus_1 FROM events"

# --- text ---
WS = "[ \\t\\n\\x0B\\f\\r]"
TOKENS = f"""tokens AS (
  SELECT doc_id, CAST(unnest(range(len(arr))) AS INTEGER) AS pos, unnest(arr) AS word
  FROM (SELECT doc_id,
               CASE WHEN text = '' THEN ['']
                    WHEN regexp_replace(text, '{WS}+$', '') = '' THEN CAST([] AS VARCHAR[])
                    ELSE regexp_split_to_array(regexp_replace(text, '{WS}+$', ''), '{WS}') END AS arr
        FROM documents))"""

ORACLE["word_count"] = with_views(TOKENS) + "SELECT word, count(*) AS cnt FROM tokens GROUP BY word"

ORACLE["running_word_count"] = with_views(TOKENS) + """
SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos ROWS UNBOUNDED PRECEDING) AS running_cnt
FROM tokens"""

# --- keyed running aggregates ---

ORACLE["running_max"] = with_views(V_READINGS) + """
SELECT id, ts, event_id, temperature,
       max(temperature) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running_max
FROM readings"""


# --- window aggregates ---
def tumble(ts: str, size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', {ts})"


ORACLE["min_per_window"] = with_views(V_READINGS) + f"""
SELECT id, {tumble('ts', '1 day')} AS window_start, {tumble('ts', '1 day')} + INTERVAL '1 day' AS window_end,
       min(temperature) AS min_temp
FROM readings GROUP BY ALL"""

ORACLE["avg_per_window"] = with_views(V_READINGS) + f"""
SELECT id, {tumble('ts', '1 day')} AS window_start, {tumble('ts', '1 day')} + INTERVAL '1 day' AS window_end,
       round(avg(temperature), 6) AS avg_temp
FROM readings GROUP BY ALL"""

ORACLE["minmax_per_window"] = with_views(V_READINGS) + f"""
SELECT id, {tumble('ts', '1 day')} AS window_start, {tumble('ts', '1 day')} + INTERVAL '1 day' AS window_end,
       min(temperature) AS min_temp, max(temperature) AS max_temp
FROM readings GROUP BY ALL"""

ORACLE["count_per_window"] = with_views(V_ARRIVALS) + f"""
SELECT key, {tumble('ts', '1 hour')} AS window_start, {tumble('ts', '1 hour')} + INTERVAL '1 hour' AS window_end,
       count(*) AS cnt
FROM arrivals GROUP BY ALL"""

ORACLE["sliding_item_counts"] = with_views(V_BEHAVIORS) + f"""
SELECT item_id, window_end - INTERVAL '1 hour' AS window_start, window_end, count(*) AS cnt
FROM (SELECT item_id, {sliding_ends('ts', '1 hour', '5 minutes')} AS window_end FROM behaviors WHERE behavior = 'pv')
GROUP BY item_id, window_end"""

ORACLE["pv_per_hour"] = with_views(V_BEHAVIORS) + f"""
SELECT {tumble('ts', '1 hour')} AS window_start, {tumble('ts', '1 hour')} + INTERVAL '1 hour' AS window_end,
       count(*) AS pv
FROM behaviors WHERE behavior = 'pv' GROUP BY ALL"""

UV_EXACT = f"""
SELECT {tumble('ts', '1 hour')} AS window_start, {tumble('ts', '1 hour')} + INTERVAL '1 hour' AS window_end,
       count(DISTINCT user_id) AS uv
FROM behaviors WHERE behavior = 'pv' GROUP BY ALL"""
ORACLE["uv_exact"] = with_views(V_BEHAVIORS) + UV_EXACT
# The Bloom estimate, rounded, equals the exact count as long as fewer than ~4 bit collisions happen in a window
# (each lost bit moves the estimate by about 1/k); with m = 9.6 M bits and hourly windows that holds here.
ORACLE["uv_bloom"] = with_views(V_BEHAVIORS) + UV_EXACT

ORACLE["uv_hll"] = with_views(V_BEHAVIORS, "uv AS (" + UV_EXACT + ")") + """
SELECT window_start, window_end, uv, uv AS uv_estimate FROM uv"""

ORACLE["uv_hll_sliding"] = with_views(V_BEHAVIORS) + f"""
SELECT window_end - INTERVAL '6 hours' AS window_start, window_end, count(DISTINCT user_id) AS uv
FROM (SELECT user_id, {sliding_ends('ts', '6 hours', '1 hour')} AS window_end
      FROM behaviors WHERE behavior = 'pv')
GROUP BY window_end"""

ORACLE["uv_report"] = with_views(V_BEHAVIORS, "uv AS (" + UV_EXACT + ")") + """
SELECT window_end, uv, 'window end: ' || strftime(window_end, '%Y-%m-%d %I:%M:%S') || ' uv count: ' || CAST(uv AS VARCHAR)
       AS report
FROM uv"""

# --- top-n family ---
TOP3 = f"""top3 AS (
  SELECT window_end, item_id, cnt, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id ASC) AS rank
    FROM (SELECT item_id, window_end, count(*) AS cnt
          FROM (SELECT item_id, {sliding_ends('ts', '1 hour', '5 minutes')} AS window_end
                FROM behaviors WHERE behavior = 'pv' {{cutoff}})
          GROUP BY item_id, window_end))
  WHERE rank <= 3)"""

ORACLE["hot_items_report"] = with_views(V_BEHAVIORS, TOP3.format(cutoff="")) + """
SELECT window_end,
       '=============================================================' || chr(10) || 'time: ' ||
       strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.' ||
       CASE WHEN rtrim(strftime(window_end, '%f'), '0') = '' THEN '0' ELSE rtrim(strftime(window_end, '%f'), '0') END
       || chr(10) ||
       string_agg('No.' || CAST(rank AS VARCHAR) || ' :  itemID = ' || CAST(item_id AS VARCHAR) || ' count = ' ||
                  CAST(cnt AS VARCHAR) || chr(10), '' ORDER BY rank) ||
       '=============================================================' || chr(10) || chr(10) AS report
FROM top3 GROUP BY window_end"""

ORACLE["hot_items_sql"] = with_views(V_BEHAVIORS) + f"""
SELECT item_id, item_count, window_end, CAST(row_num AS INTEGER) AS row_num FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY item_count DESC, item_id ASC) AS row_num
  FROM (SELECT item_id, count(item_id) AS item_count, window_end
        FROM (SELECT item_id, {sliding_ends('ts', '1 hour', '5 minutes')} AS window_end
              FROM behaviors WHERE behavior = 'pv')
        GROUP BY item_id, window_end))
WHERE row_num <= 3"""

ORACLE["topn_changelog"] = with_views(
    V_BEHAVIORS, TOP3.format(cutoff="AND ts < TIMESTAMP '2024-01-15 12:00:00'").replace("top3 AS", "prev AS", 1),
    TOP3.format(cutoff="").replace("top3 AS", "curr AS", 1)) + """
SELECT false AS is_add, * FROM (SELECT * FROM prev EXCEPT ALL SELECT * FROM curr)
UNION ALL
SELECT true AS is_add, * FROM (SELECT * FROM curr EXCEPT ALL SELECT * FROM prev)"""

# --- CSV and Kafka layouts ---
ORACLE["csv_behavior_scan"] = with_views(V_BEHAVIORS) + """
SELECT event_id, user_id, item_id, category_id, behavior, date_trunc('second', ts) AS ts FROM behaviors"""
KAFKA_LINE = "event_type || ' ' || CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)"
ORACLE["kafka_decode"] = f"""
SELECT event_type AS key, {KAFKA_LINE} AS value, 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition,
       event_id AS "offset", ts AS "timestamp" FROM events"""
ORACLE["kafka_encode"] = f"""
SELECT hex(encode(event_type)) AS key, hex(encode({KAFKA_LINE})) AS value FROM events"""

# --- user functions ---
BY_HOUR = "time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end"
ORACLE["window_apply"] = f"""
SELECT event_type, {BY_HOUR}, min(value) AS min_temp, max(value) AS max_temp FROM events GROUP BY 1, 2"""
ORACLE["udaf_avg"] = f"""
SELECT event_type, {BY_HOUR}, round(avg(value), 6) AS avg_temp FROM events GROUP BY 1, 2"""

# --- UDF / SQL ---
HASH31 = """
SELECT id, event_id, CAST(CASE WHEN hm >= 2147483648 THEN hm - 4294967296 ELSE hm END AS INTEGER) AS hash_code
FROM (SELECT id, event_id, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) * 31) % 4294967296 AS hm0,
             (((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) * 31) % 4294967296 + 4294967296)
             % 4294967296 AS hm
      FROM (SELECT id, event_id,
                   list_reduce(list_transform(string_split(id, ''), lambda c: CAST(ord(c) AS BIGINT)),
                               lambda acc, u: (acc * 31 + u) % 4294967296, CAST(0 AS BIGINT)) AS h
            FROM readings))"""
ORACLE["hash_code"] = with_views(V_READINGS) + HASH31
ORACLE["hash_code_sql"] = with_views(V_READINGS) + HASH31

# --- joins ---
ORACLE["window_join"] = f"""
WITH l AS (SELECT user_id, ts, event_id, {tumble('ts', '1 day')} AS ws FROM events WHERE event_type = 'click'),
     r AS (SELECT user_id, ts, event_id, {tumble('ts', '1 day')} AS ws FROM events WHERE event_type = 'view')
SELECT l.user_id, l.ws AS window_start, l.ws + INTERVAL '1 day' AS window_end, l.ts AS left_ts,
       l.event_id AS left_event_id, r.ts AS right_ts, r.event_id AS right_event_id
FROM l JOIN r ON l.user_id = r.user_id AND l.ws = r.ws"""

ORACLE["interval_join"] = """
WITH l AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'click'),
     r AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'view')
SELECT l.user_id, l.ts AS left_ts, l.event_id AS left_event_id, r.ts AS right_ts, r.event_id AS right_event_id
FROM l JOIN r ON l.user_id = r.user_id AND r.ts >= l.ts - INTERVAL '1 day' AND r.ts <= l.ts"""

ORACLE["reconcile"] = with_views(V_ORDER_EVENTS, V_PAY_EVENTS) + """
, both_ AS (
  SELECT order_id AS k, ts, event_id, 0 AS side FROM order_events WHERE order_type = 'create'
  UNION ALL SELECT order_id, ts, event_id, 1 FROM pay_events)
, lk AS (
  SELECT *, row_number() OVER w AS rn,
         CASE WHEN lag(side) OVER w IS NOT NULL AND lag(side) OVER w <> side
                   AND ts - lag(ts) OVER w <= INTERVAL '1 day' THEN 1 ELSE 0 END AS link
  FROM both_ WINDOW w AS (PARTITION BY k ORDER BY ts, event_id))
, ch AS (SELECT *, sum(1 - link) OVER (PARTITION BY k ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS chain FROM lk)
, pos AS (SELECT *, row_number() OVER (PARTITION BY k, chain ORDER BY ts, event_id) AS p FROM ch)
SELECT o.k AS order_id,
       CASE WHEN e.k IS NOT NULL THEN 'matched' WHEN o.side = 0 THEN 'unmatched_order' ELSE 'unmatched_pay' END AS tag,
       CASE WHEN o.side = 0 THEN o.ts ELSE e.ts END AS order_ts,
       CASE WHEN o.side = 0 THEN o.event_id ELSE e.event_id END AS order_event_id,
       CASE WHEN o.side = 1 THEN o.ts ELSE e.ts END AS pay_ts,
       CASE WHEN o.side = 1 THEN o.event_id ELSE e.event_id END AS pay_event_id
FROM (SELECT * FROM pos WHERE p % 2 = 1) o
LEFT JOIN (SELECT * FROM pos WHERE p % 2 = 0) e ON o.k = e.k AND o.chain = e.chain AND e.p = o.p + 1"""

# --- control ---
ORACLE["smoke_alerts"] = with_views(V_READINGS, V_SMOKE) + """
, merged AS (
  SELECT NULL AS id, ts, NULL::DOUBLE AS temperature, event_id, level, 0 AS rk FROM smoke_levels
  UNION ALL SELECT id, ts, temperature, event_id, NULL, 1 FROM readings)
SELECT id, ts, temperature, event_id FROM (
  SELECT *, last_value(level IGNORE NULLS) OVER (ORDER BY ts, rk, event_id ROWS UNBOUNDED PRECEDING) AS lvl
  FROM merged)
WHERE rk = 1 AND coalesce(lvl, 'LOW') = 'HIGH' AND temperature > -100.0"""

ORACLE["sensor_switch"] = with_views(V_READINGS, V_SWITCHES) + """
, merged AS (
  SELECT id, ts, NULL::DOUBLE AS temperature, event_id, true AS op, 0 AS rk FROM switches
  UNION ALL SELECT id, ts + INTERVAL '6 hours', NULL, event_id, false, 2 FROM switches
  UNION ALL SELECT id, ts, temperature, event_id, NULL, 1 FROM readings)
SELECT id, ts, temperature, event_id FROM (
  SELECT *, last_value(op IGNORE NULLS) OVER (PARTITION BY id ORDER BY ts, rk, event_id ROWS UNBOUNDED PRECEDING) AS g
  FROM merged)
WHERE rk = 1 AND coalesce(g, false)"""

# --- patterns ---
ORACLE["login_fail_3"] = with_views(V_LOGINS) + """
SELECT user_id, ip1, ip2, ip3, first_ts, last_ts, first_event_id FROM (
  SELECT user_id, event_type AS t1, lead(event_type, 1) OVER w AS t2, lead(event_type, 2) OVER w AS t3,
         ip_address AS ip1, lead(ip_address, 1) OVER w AS ip2, lead(ip_address, 2) OVER w AS ip3,
         ts AS first_ts, lead(ts, 2) OVER w AS last_ts, event_id AS first_event_id
  FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE t1 = 'fail' AND t2 = 'fail' AND t3 = 'fail' AND last_ts - first_ts < INTERVAL '1 day'"""

ORACLE["order_timeout_pattern"] = with_views(V_ORDER_EVENTS) + """
SELECT order_id, create_ts, create_event_id,
       CASE WHEN payed THEN 'payed' ELSE 'timeout' END AS result,
       CASE WHEN payed THEN nts END AS pay_ts, CASE WHEN payed THEN nid END AS pay_event_id,
       CASE WHEN NOT payed THEN create_ts + INTERVAL '1 day' END AS timeout_ts
FROM (
  SELECT *, coalesce(ntype = 'pay' AND nts - create_ts < INTERVAL '1 day', false) AS payed,
         (nts IS NULL OR nts - create_ts >= INTERVAL '1 day') AS timed_out
  FROM (SELECT order_id, order_type, ts AS create_ts, event_id AS create_event_id,
               lead(order_type) OVER w AS ntype, lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid
        FROM order_events WINDOW w AS (PARTITION BY order_id ORDER BY ts, event_id)))
WHERE order_type = 'create' AND (payed OR timed_out)"""

# --- replay ---
MAX_BEFORE = "max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

ORACLE["watermark_trace"] = with_views(V_ARRIVALS) + f"""
SELECT key, ts, arrival, event_id, {MAX_BEFORE} - INTERVAL '1 hour' - INTERVAL '1 millisecond' AS watermark
FROM arrivals"""

ORACLE["union_watermark_trace"] = with_views(V_ARRIVALS) + """
, u AS (SELECT *, 'a' AS source FROM arrivals WHERE key = 'click'
        UNION ALL SELECT *, 'b' AS source FROM arrivals WHERE key = 'view')
SELECT key, ts, arrival, event_id, source,
       CASE WHEN ma IS NOT NULL AND mb IS NOT NULL THEN least(ma, mb) - INTERVAL '1 millisecond' END AS watermark
FROM (SELECT *,
        max(CASE WHEN source = 'a' THEN ts END) OVER (ORDER BY arrival, event_id
                                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ma,
        max(CASE WHEN source = 'b' THEN ts END) OVER (ORDER BY arrival, event_id
                                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mb
      FROM u)"""

ORACLE["late_row_split"] = with_views(V_ARRIVALS) + f"""
SELECT key, ts, arrival, event_id,
       CASE WHEN ts < {MAX_BEFORE} - INTERVAL '1 hour' - INTERVAL '1 millisecond' THEN 'late' ELSE 'main' END AS tag
FROM arrivals"""


def classified(size: str, bound: str, lateness: str) -> str:
    return f"""c AS (
  SELECT *, CASE WHEN mb IS NULL OR mb - INTERVAL '{bound}' < we THEN 'on_time'
                 WHEN mb - INTERVAL '{bound}' < we + INTERVAL '{lateness}' THEN 'update' ELSE 'dropped' END AS cls
  FROM (SELECT *, {tumble('ts', size)} AS ws, {tumble('ts', size)} + INTERVAL '{size}' AS we, {MAX_BEFORE} AS mb
        FROM arrivals))"""


ORACLE["late_window_split"] = with_views(V_ARRIVALS, classified("1 hour", "1 hour", "0 seconds")) + """
SELECT 'main' AS tag, key, ws AS window_start, we AS window_end, count(*) AS cnt, NULL::TIMESTAMP AS ts,
       NULL::BIGINT AS event_id
FROM c WHERE cls = 'on_time' GROUP BY key, ws, we
UNION ALL
SELECT 'late', key, ws, we, NULL, ts, event_id FROM c WHERE cls <> 'on_time'"""

ORACLE["allowed_lateness"] = with_views(V_ARRIVALS, classified("1 hour", "10 minutes", "30 minutes")) + """
, n0 AS (SELECT key, ws, we, count(*) AS n0 FROM c WHERE cls = 'on_time' GROUP BY ALL)
, up AS (SELECT c.key, c.ws, c.we, coalesce(n0.n0, 0) AS n0,
                row_number() OVER (PARTITION BY c.key, c.ws ORDER BY arrival, event_id) AS u
         FROM c LEFT JOIN n0 ON c.key IS NOT DISTINCT FROM n0.key AND c.ws = n0.ws WHERE cls = 'update')
SELECT key, ws AS window_start, we AS window_end, CAST(1 AS BIGINT) AS firing, 'first' AS kind, n0 AS cnt FROM n0
UNION ALL
SELECT key, ws, we, CAST((CASE WHEN n0 > 0 THEN 1 ELSE 0 END) + u AS BIGINT) AS firing,
       CASE WHEN (CASE WHEN n0 > 0 THEN 1 ELSE 0 END) + u = 1 THEN 'first' ELSE 'update' END, n0 + u
FROM up"""

# --- timers / keyed state (recursive CTEs fold each key's rows one by one) ---
ORACLE["event_timers"] = with_views(V_ARRIVALS) + """
SELECT DISTINCT key, ts + INTERVAL '10 seconds' AS timer_ts FROM arrivals"""

NUM_READINGS = """num AS (
  SELECT id, ts, temperature, row_number() OVER (PARTITION BY id ORDER BY ts, event_id) AS rn FROM readings{where})
, lastrn AS (SELECT id, max(rn) AS m FROM num GROUP BY id)"""

ORACLE["periodic_counts"] = "WITH RECURSIVE " + V_READINGS + ", " + NUM_READINGS.format(where="") + """
, r AS (
  SELECT id, rn, ts + INTERVAL '6 hours' AS timer, NULL::TIMESTAMP AS fired, NULL::BIGINT AS fired_cnt
  FROM num WHERE rn = 1
  UNION ALL
  SELECT n.id, n.rn,
         CASE WHEN n.ts > r.timer THEN n.ts + INTERVAL '6 hours' ELSE r.timer END,
         CASE WHEN n.ts > r.timer THEN r.timer END,
         CASE WHEN n.ts > r.timer THEN r.rn END
  FROM r JOIN num n ON n.id = r.id AND n.rn = r.rn + 1)
SELECT id, fired AS fire_ts, fired_cnt AS cnt FROM r WHERE fired IS NOT NULL
UNION ALL
SELECT r.id, r.timer, r.rn FROM r JOIN lastrn l ON r.id = l.id AND r.rn = l.m"""

ORACLE["temp_rise_alerts"] = "WITH RECURSIVE " + V_READINGS + ", " + NUM_READINGS.format(
    where=" WHERE temperature IS NOT NULL") + """
, r AS (
  SELECT id, rn, temperature AS prev, NULL::TIMESTAMP AS timer, NULL::TIMESTAMP AS fired FROM num WHERE rn = 1
  UNION ALL
  SELECT id, rn, temperature,
         CASE WHEN temperature < prev THEN NULL
              WHEN temperature > prev AND t1 IS NULL THEN ts + INTERVAL '6 hours'
              ELSE t1 END,
         fired
  FROM (SELECT n.id, n.rn, n.ts, n.temperature, r.prev,
               CASE WHEN r.timer IS NOT NULL AND r.timer < n.ts THEN NULL ELSE r.timer END AS t1,
               CASE WHEN r.timer IS NOT NULL AND r.timer < n.ts THEN r.timer END AS fired
        FROM r JOIN num n ON n.id = r.id AND n.rn = r.rn + 1))
SELECT id, fired AS alert_ts FROM r WHERE fired IS NOT NULL
UNION ALL
SELECT r.id, r.timer FROM r JOIN lastrn l ON r.id = l.id AND r.rn = l.m WHERE r.timer IS NOT NULL"""

ORACLE["order_timeout_state"] = "WITH RECURSIVE " + V_ORDER_EVENTS + """
, num AS (SELECT order_id, ts, order_type AS typ,
                 row_number() OVER (PARTITION BY order_id ORDER BY ts, event_id) AS rn FROM order_events)
, lastrn AS (SELECT order_id, max(rn) AS m FROM num GROUP BY order_id)
, r AS (
  SELECT order_id, rn, CASE WHEN typ = 'create' THEN ts END AS open, false AS paid, typ = 'create' AS seen,
         NULL::TIMESTAMP AS x_ts, NULL::TIMESTAMP AS x_create,
         CASE WHEN typ = 'pay' THEN 'orphan_pay' END AS p_res, CASE WHEN typ = 'pay' THEN ts END AS p_ts,
         NULL::TIMESTAMP AS p_create
  FROM num WHERE rn = 1
  UNION ALL
  SELECT order_id, rn,
         CASE WHEN typ = 'create' AND open1 IS NULL THEN ts ELSE open1 END,
         CASE WHEN typ = 'create' AND open1 IS NULL THEN false WHEN typ = 'pay' AND open1 IS NOT NULL THEN true
              ELSE paid1 END,
         r_seen OR typ = 'create',
         CASE WHEN e AND NOT r_paid THEN r_open + INTERVAL '1 day' END,
         CASE WHEN e AND NOT r_paid THEN r_open END,
         CASE WHEN typ = 'pay' THEN (CASE WHEN open1 IS NOT NULL THEN 'payed' WHEN r_seen THEN 'late_pay'
                                          ELSE 'orphan_pay' END) END,
         CASE WHEN typ = 'pay' THEN ts END,
         CASE WHEN typ = 'pay' AND open1 IS NOT NULL THEN open1 END
  FROM (SELECT n.order_id, n.rn, n.ts, n.typ, r.open AS r_open, r.paid AS r_paid, r.seen AS r_seen, e,
               CASE WHEN e THEN NULL ELSE r.open END AS open1, CASE WHEN e THEN false ELSE r.paid END AS paid1
        FROM r JOIN num n ON n.order_id = r.order_id AND n.rn = r.rn + 1,
             LATERAL (SELECT coalesce(r.open IS NOT NULL AND n.ts > r.open + INTERVAL '1 day', false) AS e)))
SELECT order_id, 'not_payed' AS result, x_ts AS event_ts, x_create AS create_ts FROM r WHERE x_ts IS NOT NULL
UNION ALL
SELECT order_id, p_res, p_ts, p_create FROM r WHERE p_res IS NOT NULL
UNION ALL
SELECT r.order_id, 'not_payed', r.open + INTERVAL '1 day', r.open
FROM r JOIN lastrn l ON r.order_id = l.order_id AND r.rn = l.m WHERE r.open IS NOT NULL AND NOT r.paid"""

# --- sinks ---
LATEST = """latest AS (
  SELECT id, arg_max(ts, (ts, event_id)) AS ts, arg_max(temperature, (ts, event_id)) AS temperature,
         arg_max(event_id, (ts, event_id)) AS event_id
  FROM readings GROUP BY id)"""
ORACLE["upsert_latest"] = with_views(V_READINGS, LATEST) + "SELECT id, ts, temperature, event_id FROM latest"
ORACLE["redis_hset_rows"] = with_views(V_READINGS, LATEST) + """
SELECT 'sensor' AS hash, id AS field, CAST(temperature AS VARCHAR) AS value FROM latest"""
ORACLE["es_bulk_rows"] = with_views(V_READINGS) + """
SELECT 'sensor' AS index,
       '{"data":"(' || id || ', ' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || ', ' || CAST(temperature AS VARCHAR) || ')"}'
       AS source, event_id
FROM readings"""
