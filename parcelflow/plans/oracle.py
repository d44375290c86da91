"""DuckDB twins of the registered queries (tables are pre-registered views named after the
parquet files).

The job twins compute the rules another way than the Spark jobs do: cleaned feeds are stated directly instead of
being deduplicated, bags are opened through a directory of all items, the load warning is one
conditional aggregation over tagged events, splicing uses maxima per department pair, and
choices of one row are ``max_by`` / ``min_by``."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

EV = "event_id, ts, user_id, event_type, value, props"

ORACLE_SQL["clean_latest"] = f"""
SELECT {EV} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events) t WHERE rn = 1
"""

ORACLE_SQL["clean_latest_ties"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
                l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) t WHERE rn = 1
"""

ORACLE_SQL["clean_earliest"] = f"""
SELECT {EV} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts ASC NULLS LAST, event_id ASC NULLS LAST) AS rn
  FROM events) t WHERE rn = 1
"""

ORACLE_SQL["clean_time_slice"] = f"""
SELECT {EV} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00') t WHERE rn = 1
"""

ORACLE_SQL["upsert_base"] = f"""
WITH h AS (SELECT {EV}, ts AS inflow_time FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
     n AS (SELECT event_id, ts, user_id, event_type, value + 1.0 AS value, props,
                  ts + INTERVAL 30 DAY AS inflow_time
           FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'),
     u AS (SELECT * FROM h UNION ALL SELECT * FROM n)
SELECT {EV}, inflow_time FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY inflow_time DESC NULLS LAST) AS rn FROM u) t
WHERE rn = 1
"""

ORACLE_SQL["sentinel_filter"] = r"""
WITH r AS (
  SELECT event_id, user_id,
         CASE event_id % 7 WHEN 0 THEN 'NULL' WHEN 1 THEN '' WHEN 2 THEN ' ' WHEN 3 THEN 'null'
                           WHEN 4 THEN '\N' ELSE props END AS props,
         CASE WHEN event_id % 5 = 0 THEN 'NULL' ELSE event_type END AS event_type
  FROM events)
SELECT event_id, user_id, props,
       CASE WHEN event_type IS NULL OR trim(event_type) IN ('', 'NULL', 'null', '\N') THEN NULL
            ELSE event_type END AS event_type
FROM r
WHERE NOT (props IS NULL OR trim(props) IN ('', 'NULL', 'null', '\N'))
"""

ORACLE_SQL["standardize_ts"] = """
SELECT event_id, CAST(event_id % 11 AS INTEGER) AS layout_no,
  CASE WHEN event_id % 13 = 0 THEN NULL
  ELSE CASE event_id % 11
    WHEN 0 THEN date_trunc('second', ts)  WHEN 1 THEN date_trunc('second', ts)
    WHEN 2 THEN date_trunc('minute', ts)  WHEN 3 THEN date_trunc('second', ts)
    WHEN 4 THEN date_trunc('minute', ts)  WHEN 5 THEN date_trunc('day', ts)
    WHEN 6 THEN date_trunc('second', ts)  WHEN 7 THEN date_trunc('day', ts)
    WHEN 8 THEN date_trunc('month', ts)
    WHEN 9 THEN TIMESTAMP '1970-01-01 00:00:00' + (date_trunc('second', ts) - date_trunc('day', ts))
    ELSE TIMESTAMP '1970-01-01 00:00:00' + (date_trunc('minute', ts) - date_trunc('day', ts))
  END END AS parsed
FROM events
"""

ORACLE_SQL["format_ts"] = """
SELECT event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS fmt_time,
  strftime(ts, '%Y-%m-%d') AS fmt_date,
  strftime(ts, '%Y-%m') AS fmt_month,
  strftime(ts, '%Y-%m-%d 00:00:00') AS fmt_datetime,
  strftime(ts, '%Y%m%d%H%M%S') AS fmt_timeaskey,
  strftime(ts, '%Y%m%d%H%M') AS fmt_minsaskey,
  strftime(ts, '%Y%m%d%H') AS fmt_hoursaskey,
  strftime(ts, '%Y%m%d') AS fmt_dateaskey,
  strftime(ts, '%Y%m') AS fmt_monthaskey,
  strftime(ts, '%H:%M:%S') AS fmt_hhmmss,
  strftime(ts, '%Y-%m-%d %H:%M') AS fmt_yymmddhhmm,
  strftime(ts, '%Y-%m-%d %H') AS fmt_yymmdd_hh,
  strftime(ts, '%Y-%m-%d %H:00:00') AS fmt_yy_mm_dd_hh_00_00,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS fmt_yyyy_mm_dd_hh_mm_ss
FROM events
"""

SECOND, MINUTE, DAY = (f"date_trunc('{u}', ts)" for u in ("second", "minute", "day"))
CLOCK = "TIMESTAMP '1970-01-01 00:00:00' + ({t} - date_trunc('day', ts))"
# What each kind of text stands for: the eleven layouts, ISO, digits after the seconds, letters, blank, plain.
STANDS_FOR = [SECOND, SECOND, MINUTE, SECOND, MINUTE, DAY, SECOND, DAY, "date_trunc('month', ts)",
              CLOCK.format(t=SECOND), CLOCK.format(t=MINUTE), SECOND, SECOND, "NULL", "NULL", SECOND]


def text_time(kinds) -> str:
    return "CASE event_id % 16 " + " ".join(f"WHEN {k} THEN {STANDS_FOR[k]}" for k in kinds) + " END"


ORACLE_SQL["parse_five_layouts"] = f"""
SELECT event_id, CAST(event_id % 16 AS INTEGER) AS kind, {text_time([0, 1, 5, 6, 7, 12, 15])} AS parsed FROM events
"""

ORACLE_SQL["iso_to_ts"] = f"""
SELECT event_id, CAST(event_id % 16 AS INTEGER) AS kind, {text_time(range(16))} AS parsed,
       {text_time([k for k in range(16) if k != 11])} AS without_iso
FROM events
"""

ORACLE_SQL["format_text"] = f"""
WITH p AS (SELECT event_id, {text_time([k for k in range(16) if k != 11])} AS t FROM events)
SELECT event_id, CASE WHEN event_id % 16 = 1 THEN strftime(t, '%Y-%m-%d%H:%M:%S') ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS as_time,
       strftime(t, '%Y%m%d') AS as_key, strftime(t, '%d.%m.%Y %H') AS as_pattern, CAST(NULL AS VARCHAR) AS no_pattern
FROM p
"""

ORACLE_SQL["minutes_between"] = """
SELECT event_id,
  (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 60000000.0 AS minutes,
  (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000.0 AS millis
FROM events
"""

ORACLE_SQL["add_time"] = """
SELECT event_id,
  ts + to_minutes(CAST(trunc((value / 10.0) * 1440.0) AS BIGINT)) AS plus_frac_days,
  ts + to_days(CAST(event_id % 40 AS INTEGER)) AS plus_days,
  ts + to_minutes(CAST(trunc(value * 60.0) AS BIGINT)) AS plus_frac_hours,
  ts + to_minutes(CAST(event_id % 100 AS BIGINT)) AS plus_minutes,
  ts + to_seconds(CAST(event_id % 1000 AS BIGINT)) AS plus_seconds
FROM events
"""

BOXES = """(SELECT l_orderkey AS task_number, l_orderkey * 10 + l_linenumber AS waybill_number,
                   l_quantity, l_returnflag FROM lineitem)"""

ORACLE_SQL["unpack_containers"] = f"""
SELECT o.o_orderkey, o.o_custkey, COALESCE(b.waybill_number, o.o_orderkey) AS item, b.l_quantity
FROM orders o LEFT JOIN {BOXES} b ON o.o_orderkey = b.task_number AND b.l_returnflag = 'N'
"""

ORACLE_SQL["unpack_only_if"] = f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, COALESCE(b.waybill_number, o.o_orderkey) AS item
FROM orders o LEFT JOIN {BOXES} b
  ON o.o_orderkey = b.task_number AND b.l_returnflag = 'N' AND o.o_orderstatus = 'O'
"""

ORACLE_SQL["without_one_key"] = """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
"""

EVDAYS = """v AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'),
     c AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click')"""

ORACLE_SQL["without_two_keys"] = f"""
WITH {EVDAYS}
SELECT * FROM v WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = v.user_id AND c.day = v.day)
"""

ORACLE_SQL["within_two_keys"] = f"""
WITH {EVDAYS}
SELECT * FROM v WHERE EXISTS (SELECT 1 FROM c WHERE c.user_id = v.user_id AND c.day = v.day)
"""

ORACLE_SQL["restrict_to_centers"] = """
SELECT s.* FROM supplier s
WHERE s.s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 1)
"""

ORACLE_SQL["keep_in_any"] = """
SELECT c.* FROM customer c
LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O') a ON c.c_custkey = a.o_custkey
LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') b ON c.c_custkey = b.o_custkey
WHERE a.o_custkey IS NOT NULL OR b.o_custkey IS NOT NULL
"""


# ---------------------------------------------------------------- lines, timetable, routes

def code(expr: str) -> str:
    return f"('N' || lpad(CAST({expr} AS VARCHAR), 2, '0'))"


LINES_RAW = f"""raw_lines AS (
  SELECT {code('s_nationkey')} AS src, {code('(s_nationkey + 1 + s_suppkey % 3) % 25')} AS dst,
         CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 17 = 0 THEN NULL
              ELSE CAST(((s_suppkey * 7) % 24) * 3600 + (s_suppkey % 2) * 1800 AS INTEGER) END AS leave_secs,
         CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE CAST(60 + 30 * (s_suppkey % 5) AS BIGINT) END AS run_minutes,
         CAST(s_suppkey % 4 AS BIGINT) AS unload_time,
         CASE s_suppkey % 3 WHEN 0 THEN 'trunk'
                            WHEN 1 THEN (CASE WHEN s_suppkey % 7 = 0 THEN 'airplane' ELSE 'car' END)
                            ELSE 'partner' END AS type
  FROM supplier)"""

MERGED = LINES_RAW + """,
merged AS (
  SELECT src, dst, leave_secs, max(coalesce(run_minutes, 0)) AS run_minutes,
         max(coalesce(unload_time, 0)) AS unload_time, max(type) AS type
  FROM raw_lines WHERE leave_secs IS NOT NULL AND type <> 'airplane'
  GROUP BY src, dst, leave_secs)"""

HMS = "printf('%02d:%02d:%02d', {s} // 3600, ({s} // 60) % 60, {s} % 60)"

ORACLE_SQL["merge_lines"] = f"""
WITH {MERGED}
SELECT src AS leave_department_code, dst AS arrive_department_code, {HMS.format(s='leave_secs')} AS leave_time,
       leave_secs, run_minutes, unload_time, type FROM merged
"""

SPLICED = MERGED + """,
pair_top AS (SELECT src AS a, dst AS z, max(run_minutes) AS run, max(unload_time) AS unload FROM merged GROUP BY ALL),
partner_top AS (SELECT src AS a, dst AS z, max(run_minutes) AS run, max(unload_time) AS unload
                FROM merged WHERE type = 'partner' GROUP BY ALL),
through AS (
  SELECT m.src, t.z AS dst, m.leave_secs, m.run_minutes + t.run AS run_minutes, m.unload_time + t.unload AS unload_time
  FROM merged m JOIN partner_top t ON t.a = m.dst
  UNION ALL
  SELECT m.src, t.z, m.leave_secs, m.run_minutes + t.run, m.unload_time + t.unload
  FROM merged m JOIN pair_top t ON t.a = m.dst WHERE m.type = 'partner'
  UNION ALL
  SELECT src, dst, leave_secs, run_minutes, unload_time FROM merged),
spliced AS (
  SELECT src, dst, leave_secs, max(run_minutes) AS run_minutes, max(unload_time) AS unload_time
  FROM through GROUP BY src, dst, leave_secs)"""

ORACLE_SQL["splice_lines"] = f"""
WITH {SPLICED}
SELECT src AS leave_department_code, dst AS arrive_department_code, {HMS.format(s='leave_secs')} AS leave_time,
       leave_secs, run_minutes, unload_time FROM spliced
"""

ORACLE_SQL["timetable"] = f"""
WITH {MERGED}
SELECT src AS leave_department_code, dst AS arrive_department_code, CAST(count(*) AS INTEGER) AS departures,
       string_agg({HMS.format(s='leave_secs')} || '/' || run_minutes || '/' || unload_time, ','
                  ORDER BY leave_secs, run_minutes, unload_time) AS schedule
FROM merged GROUP BY src, dst
"""

ROUTES = f"""oc AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_orderdate, c.c_nationkey,
         CAST(o.o_orderkey % 5 + 2 AS INTEGER) AS size, CAST(o.o_orderkey % 3 + 1 AS INTEGER) AS step
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
routes AS (
  SELECT o_orderkey, c_nationkey,
         list_transform(range(size), lambda i: CASE WHEN o_orderkey % 7 = 0 AND i = size - 1 THEN {code('c_nationkey')}
                                                ELSE {code('(c_nationkey + i * step) % 25')} END) AS codes,
         size, o_orderstatus,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + to_minutes(CAST((o_orderkey * 7) % 60 AS BIGINT)) AS t0
  FROM oc),
w AS (
  SELECT o_orderkey, c_nationkey, t0,
         array_to_string(list_transform(range(size), lambda i: codes[i + 1] || ':' || CAST(i AS VARCHAR)), '-') AS route,
         CASE WHEN o_orderkey % 11 = 0 THEN 'N99' ELSE codes[CAST(o_orderkey % size AS INTEGER) + 1] END AS cur,
         CASE o_orderstatus WHEN 'O' THEN 'load_noarrive' WHEN 'F' THEN 'load_arriveed' ELSE 'stock' END AS status,
         {code('(c_nationkey + 24) % 25')} AS leave_org
  FROM routes),
parsed AS (
  SELECT *, list_transform(string_split(route, '-'), lambda x: split_part(x, ':', 1)) AS orgs FROM w),
pos AS (
  SELECT *, CASE WHEN list_position(list_reverse(orgs), cur) > 0
                 THEN len(orgs) - list_position(list_reverse(orgs), cur) ELSE -1 END AS idx
  FROM parsed),
rem AS (
  SELECT o_orderkey, t0, status, leave_org, orgs[idx + 1:] AS remaining
  FROM pos WHERE idx >= 0 AND idx < len(orgs) - 1),
legs AS (
  SELECT o_orderkey, t0, CAST(k AS INTEGER) AS leg_idx, remaining[k + 1] AS src, remaining[k + 2] AS dst,
         CAST(k + CASE WHEN status = 'load_noarrive' THEN 2 ELSE 1 END AS INTEGER) AS path_no,
         CASE WHEN k = 0 THEN (CASE WHEN status = 'load_noarrive' THEN leave_org END)
              ELSE remaining[k] END AS pre_org
  FROM rem, unnest(range(len(remaining) - 1)) AS r(k))"""

ORACLE_SQL["route_remaining"] = f"""
WITH {ROUTES}
SELECT o_orderkey, leg_idx, src, dst, path_no, pre_org FROM legs
"""

ORACLE_SQL["nearest_departure"] = f"""
WITH {MERGED}, {ROUTES},
q AS (SELECT o_orderkey, t0, {code('c_nationkey')} AS src, {code('(c_nationkey + 1) % 25')} AS dst FROM w),
cand AS (
  SELECT q.*, m.leave_secs, m.run_minutes, m.unload_time,
         row_number() OVER (PARTITION BY q.o_orderkey ORDER BY
             abs(epoch_us(q.t0) - epoch_us(date_trunc('day', q.t0) + to_seconds(m.leave_secs))) ASC NULLS LAST,
             m.leave_secs, m.run_minutes, m.unload_time) AS rn
  FROM q LEFT JOIN merged m ON q.src = m.src AND q.dst = m.dst)
SELECT o_orderkey, t0, src, dst,
       CASE WHEN leave_secs IS NULL THEN NULL ELSE {HMS.format(s='leave_secs')} END AS line_leave_time,
       run_minutes, unload_time
FROM cand WHERE rn = 1
"""

NEXT_CAND = """
    SELECT st, run_minutes, unload_time FROM (
      SELECT date_trunc('day', {t}) + to_seconds(m.leave_secs) AS st, m.run_minutes, m.unload_time
      FROM merged m WHERE m.src = {src} AND m.dst = {dst} AND date_trunc('day', {t}) + to_seconds(m.leave_secs) >= {t}
      UNION ALL
      SELECT date_trunc('day', {t}) + INTERVAL 1 DAY + to_seconds(m.leave_secs), m.run_minutes, m.unload_time
      FROM merged m WHERE m.src = {src} AND m.dst = {dst}) c
    ORDER BY st, run_minutes, unload_time LIMIT 1"""

ORACLE_SQL["next_departure"] = f"""
WITH {MERGED}, {ROUTES},
q AS (SELECT o_orderkey, t0, {code('c_nationkey')} AS src, {code('(c_nationkey + 1 + o_orderkey % 3) % 25')} AS dst
      FROM w)
SELECT q.o_orderkey, q.t0, q.src, q.dst, nx.st AS start_time, nx.st + to_minutes(nx.run_minutes) AS end_time,
       nx.st + to_minutes(nx.run_minutes) + to_minutes(nx.unload_time * 60) AS next_ready
FROM q LEFT JOIN LATERAL ({NEXT_CAND.format(t='q.t0', src='q.src', dst='q.dst')}) nx ON TRUE
"""

ORACLE_SQL["schedule_walk"] = f"""
WITH RECURSIVE {MERGED}, {ROUTES},
walk AS (
  SELECT l.o_orderkey, l.leg_idx, l.src, l.dst, l.path_no, l.pre_org, nx.st AS start_time,
         nx.st + to_minutes(nx.run_minutes) AS end_time,
         nx.st + to_minutes(nx.run_minutes) + to_minutes(nx.unload_time * 60) AS ready
  FROM legs l, LATERAL ({NEXT_CAND.format(t='l.t0', src='l.src', dst='l.dst')}) nx
  WHERE l.leg_idx = 0 AND l.t0 IS NOT NULL
  UNION ALL
  SELECT l.o_orderkey, l.leg_idx, l.src, l.dst, l.path_no, l.pre_org, nx.st,
         nx.st + to_minutes(nx.run_minutes), nx.st + to_minutes(nx.run_minutes) + to_minutes(nx.unload_time * 60)
  FROM walk p JOIN legs l ON l.o_orderkey = p.o_orderkey AND l.leg_idx = p.leg_idx + 1,
       LATERAL ({NEXT_CAND.format(t='p.ready', src='l.src', dst='l.dst')}) nx)
SELECT o_orderkey, leg_idx, src, dst, path_no, pre_org, start_time, end_time FROM walk
"""


# ---------------------------------------------------------------- derived logistics feeds and jobs

ITEM = "CASE WHEN l_linenumber % 4 = 1 THEN 'B' || CAST(l_orderkey // 8 AS VARCHAR) ELSE 'W' || CAST(l_orderkey AS VARCHAR) END"
LINE_DEPT = code("(l_suppkey + l_linenumber) % 25")
LINE_NO = "l_orderkey * 10 + l_linenumber"
NONE = "CAST(NULL AS VARCHAR)"
NO_TIME = "CAST(NULL AS TIMESTAMP)"
SHIPPED = "l_shipdate + to_hours({h})"
FROM_CUSTOMERS = "orders JOIN customer ON o_custkey = c_custkey"
WB = "'W' || CAST(o_orderkey AS VARCHAR)"
TEXT_KEY = "CAST(o_orderkey AS VARCHAR)"

# Per cleaned feed: (record number, created, source, the fields in order).  Of the versions of a
# record the one with the plain inflow time is the latest, so a cleaned feed is stated directly.
CLEANED = {
    "volume_box": ("o_orderkey", "o_orderdate", "orders", {
        "id": TEXT_KEY, "waybill_number": WB, "task_number": "'B' || CAST(o_orderkey // 8 AS VARCHAR)",
        "leave_department_code": NONE, "waybill_type": NONE, "waybill_weight": "o_totalprice / 100",
        "waybill_volume": "o_totalprice / 1000", "create_time": None, "alter_time": NONE, "handle_time": NO_TIME,
        "valid_status": "CASE WHEN o_orderkey % 13 = 0 THEN '0' ELSE '1' END", "inflow_time": "o_orderdate"}),
    "volume_load": ("o_orderkey", "o_orderdate", FROM_CUSTOMERS, {
        "id": TEXT_KEY, "assignment_number": "'A' || CAST(o_orderkey AS VARCHAR)", "car_number": NONE, "status": NONE,
        "leave_department_code": code("c_nationkey"),
        "arrive_department_code": code("(c_nationkey + o_orderkey % 3 + 1) % 25"), "begin_time": NO_TIME,
        "end_time": "o_orderdate + to_hours(6)", "leave_department_time": NO_TIME, "arrive_department_time": NO_TIME,
        "immediately": NONE, "transport_type": NONE, "create_time": None,
        "is_active": "CASE WHEN o_orderkey % 29 = 0 THEN '0' ELSE '1' END", "device_type": NONE,
        "inflow_time": "o_orderdate"}),
    "volume_load_detail": (LINE_NO, SHIPPED.format(h="l_linenumber + 2"), "lineitem WHERE l_linestatus = 'O'", {
        "id": f"CAST({LINE_NO} AS VARCHAR)", "waybill_number": ITEM,
        "assignment_number": "'A' || CAST(l_orderkey AS VARCHAR)", "shipment_type": NONE,
        "leave_department_code": f"CASE WHEN l_partkey % 3 <> 0 THEN {LINE_DEPT} "
                                 f"ELSE {code('(l_suppkey + l_linenumber + 1) % 25')} END",
        "arrive_department_code": NONE, "create_time": None,
        "device_type": "CASE WHEN l_partkey % 7 = 0 THEN 'PC' ELSE 'PDA' END",
        "is_active": "CASE WHEN l_partkey % 11 = 0 THEN '0' ELSE '1' END", "operate_department_code": NONE,
        "inflow_time": SHIPPED.format(h="l_linenumber + 2")}),
    "volume_path": ("no", "t0", "path_records", {
        "id": "CAST(no AS VARCHAR)", "waybill_number": WB, "leave_department_code": NONE, "arrive_department_code": NONE,
        "waybill_route_codes": "stops", "create_time": None, "inflow_time": "t0"}),
    "volume_sign": ("o_orderkey", "o_orderdate", "orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0", {
        "id": TEXT_KEY, "waybill_number": WB, "operation_department_code": NONE,
        "sign_time": "o_orderdate + INTERVAL 5 DAY", "create_time": None, "is_active": NONE,
        "inflow_time": "o_orderdate"}),
    "volume_stock": (LINE_NO, SHIPPED.format(h="l_linenumber * 3"), "lineitem", {
        "id": f"CAST({LINE_NO} AS VARCHAR)", "waybill_number": "'W' || CAST(l_orderkey AS VARCHAR)",
        "department_code": LINE_DEPT, "final_station": NONE, "stock_time": SHIPPED.format(h="l_linenumber * 3"),
        "create_time": None, "waybill_type": "CASE WHEN l_orderkey % 10 = 0 THEN 'BAG' ELSE 'WAYBILL' END",
        "waybill_weight": NONE, "waybill_volume": NONE, "next_department_code": NONE,
        "inflow_time": SHIPPED.format(h="l_linenumber * 3")}),
    "volume_traffic": ("o_orderkey", "o_orderdate", "orders", {
        "id": TEXT_KEY, "assignment_number": "'A' || CAST(o_orderkey AS VARCHAR)",
        "transport_task_id": "'T' || CAST(o_orderkey AS VARCHAR)", "create_time": None, "is_active": "'Y'",
        "inflow_time": "o_orderdate"}),
    "volume_traffic_detail": ("o_orderkey", "o_orderdate", "orders", {
        "transport_task_id": "'T' || CAST(o_orderkey AS VARCHAR)", "car_number": "'C' || CAST(o_orderkey % 97 AS VARCHAR)",
        "leave_department_code": NONE, "arrival_status": NONE, "arrive_department_code": NONE,
        "transport_task_status": "CASE WHEN o_orderkey % 17 = 0 THEN 'CANCLE' ELSE 'NORMAL' END",
        "plan_leave_department_time": NO_TIME,
        "actual_leave_department_time": "CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate + to_hours(o_orderkey % 24) END",
        "plan_arrive_department_time": "CASE WHEN o_orderkey % 31 > 0 THEN "
                                       "o_orderdate + to_hours(o_orderkey % 24 + (o_orderkey % 3 + 1) * 4) END",
        "actual_arrive_department_time": "CASE WHEN o_orderkey % 4 > 1 THEN o_orderdate + to_hours(o_orderkey % 24 + 5) END",
        "create_time": None, "is_active": "'Y'", "inflow_time": "o_orderdate"}),
    "volume_unload_detail": (LINE_NO, SHIPPED.format(h="l_linenumber"), "lineitem", {
        "id": f"CAST({LINE_NO} AS VARCHAR)", "waybill_number": ITEM,
        "assignment_number": "'A' || CAST(l_orderkey AS VARCHAR)", "pre_bill_number": NONE, "shipment_type": NONE,
        "create_time": None, "scan_status": NONE,
        "device_type": "CASE l_linenumber % 3 WHEN 0 THEN 'PC' WHEN 1 THEN 'PDA' ELSE 'GUN' END", "is_active": "'1'",
        "now_department_code": LINE_DEPT, "inflow_time": "l_shipdate + to_minutes(l_partkey % 1000)"}),
    "volume_waybill": ("no", "o_orderdate", "waybill_records", {
        "id": "CAST(no AS VARCHAR)", "waybill_number": WB, "goods_qty": "CAST(o_orderkey % 5 + 1 + extra AS DOUBLE)",
        "goods_volume": "CASE WHEN o_orderkey % 19 > 0 THEN o_totalprice / 1000 END",
        "goods_weight": "CASE WHEN o_orderkey % 23 > 0 THEN o_totalprice / 100 END",
        "billing_department_code": code("c_nationkey"), "receive_department_code": code("c_nationkey"),
        "customer_pickup_department_code": code("(c_nationkey + 3) % 25"), "bill_time": "o_orderdate",
        "waybill_is_active": NONE, "create_time": None,
        "is_active": "CASE WHEN o_orderkey % 50 = 0 THEN 'N' ELSE 'Y' END", "inflow_time": "o_orderdate"}),
}
RECORDS = f"""
waybill_records AS (
  SELECT o.*, c_nationkey, r.extra, o_orderkey + 100000000 * r.extra AS no
  FROM {FROM_CUSTOMERS.replace('orders', 'orders o', 1)}, (VALUES (0), (1)) r(extra)
  WHERE r.extra = 0 OR o_orderkey % 37 = 0),
path_records AS (
  SELECT w.o_orderkey, w.t0, w.o_orderkey + 100000000 * r.kind AS no,
         CASE WHEN r.kind = 2 THEN array_to_string(string_split(route, '-')[2:], '-') ELSE route END AS stops
  FROM w, (VALUES (0), (1), (2)) r(kind)
  WHERE r.kind = 0 OR (r.kind = 1 AND o_orderkey % 41 = 0) OR (r.kind = 2 AND o_orderkey % 43 = 0))"""


def cleaned(name: str, where: str = "TRUE") -> str:
    """The latest version of every record among those that fulfil ``where``."""
    number, created, source, fields = CLEANED[name]
    # Creation times spelled as NULL or as no date become NULL.
    create = f"CASE WHEN ({number}) % 97 NOT IN (5, 6) THEN {created} END"
    rows = "SELECT " + ", ".join(f"{e or create} AS {f}" for f, e in fields.items()) + f" FROM {source}"
    rows = f"SELECT * FROM ({rows}) WHERE {where}"
    if "lineitem" not in source:
        return rows
    # Line numbers repeat within an order: the largest inflow, then the largest fields from left to right.
    age = ", ".join(f"coalesce(r.{f}, {'TIMESTAMP ' + repr('0001-01-01 00:00:00') if f.endswith('_time') else repr('')})"
                    for f in fields if f not in ("id", "inflow_time"))
    return f"SELECT unnest(x) FROM (SELECT max_by(r, (r.inflow_time, {age})) AS x FROM ({rows}) r GROUP BY r.id)"


FEEDS = RECORDS + "".join(f",\n{name}_c AS ({cleaned(name)})" for name in CLEANED) + f""",
dept AS (
  SELECT {code('s_nationkey')} AS code, 'P' || CAST(any_value(n_regionkey) AS VARCHAR) AS prov,
         max_by(n_regionkey <= 2 AND s_suppkey % 5 <> 0, s_suppkey) AS center
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 9 <> 0 GROUP BY s_nationkey),
bag AS (SELECT task_number AS item, waybill_number AS waybill, waybill_weight AS kg, waybill_volume AS m3
        FROM volume_box_c WHERE valid_status = '1'),
directory AS (  -- every item with what it holds: a valid bag its waybills, anything else itself
  SELECT item, waybill, kg, m3 FROM bag
  UNION ALL
  SELECT DISTINCT {ITEM} AS item, {ITEM}, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM lineitem
  WHERE {ITEM} NOT IN (SELECT item FROM bag)),
sorted_items AS (SELECT {ITEM} AS item, {LINE_DEPT} AS org, l_shipdate + to_hours(l_linenumber) + to_minutes(30) AS moment
                 FROM lineitem WHERE l_returnflag = 'R'),
pallet_items AS (SELECT {ITEM} AS item, {LINE_DEPT} AS org, l_shipdate + to_hours(l_linenumber + 1) AS moment
                 FROM lineitem WHERE l_returnflag = 'A')"""

REFRESH = "'2001-09-01 00:00:00'"
WITH_FEEDS = f"WITH {ROUTES}, {FEEDS}"
SLICE_START = "TIMESTAMP '1998-12-06 00:00:00'"

for _name in CLEANED:
    # Records without a creation time are in no slice, but for stock, where they are in every one.
    _undated = "create_time IS NULL OR " if _name == "volume_stock" else ""
    ORACLE_SQL["clean_" + _name] = f"{WITH_FEEDS}\nSELECT * FROM {_name}_c WHERE {_undated}create_time >= {SLICE_START}"

ORACLE_SQL["clean_slice_inside_day"] = cleaned(
    "volume_unload_detail", "create_time >= TIMESTAMP '1995-06-10 03:00:00' AND create_time < TIMESTAMP '1996-03-16 03:00:00'")

ORACLE_SQL["slice_rejects"] = f"""
SELECT CAST(coalesce(sum(n) FILTER (no % 97 = 5), 0) AS BIGINT) AS missing,
       CAST(coalesce(sum(n) FILTER (no % 97 = 6), 0) AS BIGINT) AS no_time,
       CAST(0 AS BIGINT) AS other_layout
FROM (SELECT {LINE_NO} AS no, CASE WHEN ({LINE_NO}) % 10 = 3 THEN 3 ELSE 1 END AS n FROM lineitem)
"""

ORACLE_SQL["time_rejects"] = f"""
{WITH_FEEDS}
SELECT count(*) FILTER (({LINE_NO}) % 97 = 6) * 1 + count(*) FILTER (({LINE_NO}) % 97 = 6 AND ({LINE_NO}) % 10 = 3) * 2
         AS create_time_rejects, CAST(0 AS BIGINT) AS inflow_time_rejects
FROM lineitem
"""

ORACLE_SQL["pipeline_clean"] = WITH_FEEDS + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, {'transport_task_id' if n == 'volume_traffic_detail' else 'id'} AS record_id, "
    f"create_time, inflow_time FROM {n}_c" for n in CLEANED)

ORACLE_SQL["pipeline_unscan"] = f"""
{WITH_FEEDS},
arrivals AS (
  SELECT d.waybill, u.now_department_code AS org, u.inflow_time, u.device_type, u.assignment_number
  FROM volume_unload_detail_c u JOIN directory d ON d.item = u.waybill_number
  WHERE u.now_department_code IN (SELECT code FROM dept WHERE center)),
unseen AS (SELECT waybill, org FROM arrivals EXCEPT SELECT item, org FROM sorted_items)
SELECT a.org AS now_department_code, a.waybill AS waybill_number, a.inflow_time AS create_time, a.device_type,
       a.assignment_number, p.waybill_route_codes, {REFRESH} AS refresh_time
FROM arrivals a SEMI JOIN unseen n ON n.waybill = a.waybill AND n.org = a.org
LEFT JOIN volume_path_c p ON p.waybill_number = a.waybill
"""

ORACLE_SQL["pipeline_warning"] = f"""
{WITH_FEEDS},
scanned AS (
  SELECT 'unload' AS kind, waybill_number AS item, now_department_code AS org, create_time AS moment, TRUE AS opens
  FROM volume_unload_detail_c
  UNION ALL
  SELECT 'load', waybill_number, leave_department_code, NULL, device_type <> 'PC' AND is_active = '1'
  FROM volume_load_detail_c
  UNION ALL SELECT 'tray', item, org, moment, TRUE FROM pallet_items
  UNION ALL SELECT 'sort', item, org, moment, TRUE FROM sorted_items),
happened AS (
  SELECT s.kind, d.waybill, s.org, s.moment FROM scanned s JOIN directory d ON d.item = s.item WHERE s.opens
  UNION ALL SELECT kind, item, org, moment FROM scanned WHERE NOT opens
  UNION ALL SELECT 'stock', waybill_number, department_code, NULL FROM volume_stock_c),
seen AS (
  SELECT waybill, org, max(moment) FILTER (kind = 'unload') AS unloaded, max(moment) FILTER (kind = 'tray') AS trayed,
         min(moment) FILTER (kind = 'sort') AS sorted, list(DISTINCT kind) AS kinds
  FROM happened WHERE org IN (SELECT code FROM dept WHERE center) GROUP BY waybill, org)
SELECT waybill AS waybill_no, org AS unload_org_code, unloaded AS unload_time, trayed AS tray_time,
       CASE WHEN list_contains(kinds, 'sort') THEN org END AS sort_org_code, sorted AS sort_time,
       CASE WHEN sorted IS NOT NULL THEN '可装车' WHEN trayed IS NOT NULL THEN '可分拣' ELSE '在站台' END AS expect_place,
       {REFRESH} AS refresh_time
FROM seen
WHERE list_contains(kinds, 'unload') AND list_contains(kinds, 'stock') AND NOT list_contains(kinds, 'load')
  AND waybill NOT IN (SELECT waybill_number FROM volume_sign_c)
"""

ORACLE_SQL["expected_place"] = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
base AS (SELECT DISTINCT user_id, day FROM ev),
tray AS (SELECT user_id, day, max(ts) AS tray_time FROM ev WHERE event_type = 'view' GROUP BY user_id, day),
srt AS (SELECT user_id, day, min(ts) AS sort_time FROM ev WHERE event_type = 'click' GROUP BY user_id, day)
SELECT b.user_id, b.day, t.tray_time, s.sort_time,
       CASE WHEN s.sort_time IS NOT NULL THEN '可装车' WHEN t.tray_time IS NOT NULL THEN '可分拣' ELSE '在站台' END
         AS expect_place
FROM base b LEFT JOIN tray t ON b.user_id = t.user_id AND b.day = t.day
LEFT JOIN srt s ON b.user_id = s.user_id AND b.day = s.day
"""


# ---------------------------------------------------------------- forecast job

E_TS = "TIMESTAMP '2001-09-01 13:45:00'"
E_TXT = "'2001-09-01 13:45:00'"
LONG_AGO = "TIMESTAMP '0001-01-01 00:00:00'"

FC_STAGES = f"""
same_province AS (SELECT 'P' || CAST(r_regionkey AS VARCHAR) AS prov FROM region),
due AS (  -- active waybill records nobody has signed for
  SELECT v.*, home.prov AS home_prov, goal.prov AS goal_prov
  FROM volume_waybill_c v
  LEFT JOIN dept home ON home.code = v.billing_department_code
  LEFT JOIN dept goal ON goal.code = v.customer_pickup_department_code
  WHERE v.is_active = 'Y' AND v.waybill_number NOT IN (SELECT waybill_number FROM volume_sign_c)),
last_stock AS (
  SELECT waybill_number AS waybill, max_by(department_code, age) AS org, max_by(stock_time, age) AS stocked
  FROM (SELECT *, (coalesce(create_time, {LONG_AGO}), id) AS age FROM volume_stock_c WHERE waybill_type = 'WAYBILL')
  GROUP BY waybill_number),
trip AS (
  SELECT l.assignment_number AS assignment, l.leave_department_code AS org_from, l.arrive_department_code AS org_to,
         l.end_time, d.car_number AS car, d.actual_leave_department_time AS left_at,
         d.actual_arrive_department_time AS came_at, d.plan_arrive_department_time AS plan_at
  FROM volume_load_c l, volume_traffic_c x, volume_traffic_detail_c d
  WHERE l.is_active = '1' AND x.assignment_number = l.assignment_number AND d.transport_task_id = x.transport_task_id
    AND d.transport_task_status <> 'CANCLE'),
loading AS (
  SELECT g.waybill, t.car, g.kg, g.m3, t.org_from, t.org_to, t.left_at, t.came_at, t.plan_at,
         coalesce(i.create_time, t.end_time) AS loaded
  FROM volume_load_detail_c i JOIN directory g ON g.item = i.waybill_number
  JOIN trip t ON t.assignment = i.assignment_number WHERE i.is_active = '1'),
last_loading AS (
  SELECT waybill, max_by(loading, (coalesce(loaded, {LONG_AGO}), coalesce(car, ''), coalesce(kg, -1), coalesce(m3, -1),
                                   org_from, org_to, coalesce(left_at, {LONG_AGO}), coalesce(came_at, {LONG_AGO}),
                                   coalesce(plan_at, {LONG_AGO}))) AS x
  FROM loading GROUP BY waybill),
goods AS (  -- one record per waybill: the latest active one
  SELECT waybill_number AS waybill, max_by({{'kg': goods_weight, 'm3': goods_volume}}, (inflow_time, id)) AS g
  FROM volume_waybill_c WHERE is_active = 'Y' GROUP BY waybill_number),
loaded AS (
  SELECT waybill, x.car AS car, coalesce(x.kg, g.kg, 0.0) AS kg, coalesce(x.m3, g.m3, 0.0) AS m3, x.org_from AS org_from,
         x.org_to AS org_to, x.left_at AS left_at, x.came_at AS came_at, x.plan_at AS plan_at, x.loaded AS loaded_at
  FROM last_loading JOIN goods USING (waybill)),
timed AS (
  SELECT b.waybill, min_by({{'run': s.run_minutes, 'unload': s.unload_time}},
           (coalesce(abs(epoch_us(b.left_at) - epoch_us(date_trunc('day', b.left_at) + to_seconds(s.leave_secs))), 0),
            s.leave_secs, s.run_minutes, s.unload_time)) AS best
  FROM loaded b JOIN spliced s ON s.src = b.org_from AND s.dst = b.org_to GROUP BY b.waybill),
placed AS (
  SELECT d.id AS rec, d.waybill_number AS waybill, d.bill_time AS billed, coalesce(d.goods_weight, 0.0) AS bill_kg,
         coalesce(d.goods_volume, 0.0) AS bill_m3, coalesce(d.goods_qty, 0.0) AS bill_qty,
         d.customer_pickup_department_code AS pickup,
         CASE WHEN d.home_prov = d.goal_prov AND d.home_prov IN (SELECT prov FROM same_province) THEN 'Y' ELSE 'N' END AS same,
         b.* EXCLUDE (waybill), s.org AS stock_org, b.waybill IS NOT NULL AS on_load,
         CASE WHEN s.stocked > coalesce(b.came_at, b.left_at, b.loaded_at) THEN 'stock'
              WHEN b.waybill IS NULL THEN NULL WHEN b.came_at IS NOT NULL THEN 'load_arriveed'
              WHEN b.left_at IS NOT NULL THEN 'load_noarrive' ELSE 'load_nodepart' END AS state,
         to_hours(coalesce(t.best.unload, 0)) AS unloading
  FROM due d LEFT JOIN last_stock s ON s.waybill = d.waybill_number LEFT JOIN loaded b ON b.waybill = d.waybill_number
  LEFT JOIN timed t ON t.waybill = d.waybill_number
  WHERE s.waybill IS NOT NULL OR b.waybill IS NOT NULL),
located AS (
  SELECT *, CASE state WHEN 'load_noarrive' THEN greatest(plan_at, {E_TS}) + unloading
                       WHEN 'load_arriveed' THEN greatest(came_at + unloading, {E_TS})
                       WHEN 'stock' THEN {E_TS} WHEN 'load_nodepart' THEN {E_TS} END AS ready,
         CASE state WHEN 'stock' THEN stock_org WHEN 'load_nodepart' THEN org_from
                    WHEN 'load_noarrive' THEN org_to WHEN 'load_arriveed' THEN org_to END AS here
  FROM placed)"""

FC_WITH = f"WITH RECURSIVE {SPLICED}, {ROUTES}, {FEEDS}, {FC_STAGES}"

ORACLE_SQL["forecast_unsigned"] = f"""{FC_WITH}
SELECT id AS waybill_id, waybill_number, bill_time, coalesce(goods_weight, 0.0) AS goods_weight,
       coalesce(goods_volume, 0.0) AS goods_volume, coalesce(goods_weight, 0.0) AS bill_weight,
       coalesce(goods_volume, 0.0) AS bill_volume, coalesce(goods_qty, 0.0) AS bill_qty, receive_department_code,
       billing_department_code, home_prov AS bill_prov_code, goal_prov AS pickup_prov_code,
       CASE WHEN home_prov = goal_prov THEN 'Y' ELSE 'N' END AS next_day_arrive, customer_pickup_department_code
FROM due"""
ORACLE_SQL["forecast_stock"] = f"""{FC_WITH}
SELECT waybill AS waybill_number, org AS receive_org_code, stocked AS in_stock_time FROM last_stock"""
LOADED_OUT = """waybill AS waybill_number, car AS car_number, kg AS goods_weight, m3 AS goods_volume,
       org_from AS leave_department_code, org_to AS arrive_department_code, left_at AS depart_time,
       came_at AS arrive_time, plan_at AS plan_arrive_time, loaded_at AS create_time"""
ORACLE_SQL["load_chain"] = f"{FC_WITH}\nSELECT {LOADED_OUT} FROM loaded"
ORACLE_SQL["forecast_nearest"] = f"""{FC_WITH}
SELECT {LOADED_OUT}, best.run AS run_minutes, best.unload AS unload_time FROM loaded LEFT JOIN timed USING (waybill)"""
ORACLE_SQL["waybill_status"] = f"""{FC_WITH}
SELECT waybill AS waybill_number, billed AS old_bill_time, ready AS bill_time, state AS waybill_status,
       here AS current_org, same AS next_day_arrive FROM located"""

LINE_KIND = "CASE WHEN f.center AND t.center THEN '干线' ELSE '支线' END"
YES_NO = "CASE {c} WHEN TRUE THEN 'Y' WHEN FALSE THEN 'N' END"
STAMPS = f"{E_TXT} AS refresh_time, {E_TS} AS create_time"

RUNNING = f"""
running AS (
  SELECT p.waybill AS waybill_number, p.billed AS old_bill_time, p.car AS car_number, p.left_at AS bill_time,
         p.kg AS goods_weight, p.m3 AS goods_volume, CAST(1 AS DOUBLE) AS goods_qty, p.bill_kg AS bill_weight,
         p.bill_m3 AS bill_volume, p.bill_qty, p.org_from AS leave_department_code, p.org_to AS arrive_department_code,
         p.pickup AS customer_pickup_department_code, {NO_TIME} AS start_time, p.plan_at AS end_time,
         {LINE_KIND} AS line_type, 'way' AS waybill_type, 'way' AS waybill_status, p.same AS next_day_arrive,
         p.org_from AS pre_org_code, CAST(1 AS INTEGER) AS path_no, {YES_NO.format(c='f.center')} AS depart_org_transfer,
         {YES_NO.format(c='t.center')} AS arrive_org_transfer, {STAMPS}
  FROM located p JOIN dept t ON t.code = p.org_to AND t.center LEFT JOIN dept f ON f.code = p.org_from
  WHERE p.state = 'load_noarrive' AND p.plan_at IS NOT NULL)"""

ORACLE_SQL["forecast_in_transit"] = f"{FC_WITH}, {RUNNING}\nSELECT * FROM running"

SPLICED_CAND = NEXT_CAND.replace("FROM merged m", "FROM spliced m")

AHEAD = f"""
journeys AS (  -- a record of a waybill with a record of its route, from the last visit of where it is
  SELECT l.rec, r.id AS route_rec, l.ready, l.state, l.org_from, string_split(
           regexp_replace(r.waybill_route_codes, ':[^-]*', '', 'g'), '-') AS stops, l.here
  FROM located l JOIN volume_path_c r ON r.waybill_number = l.waybill
  WHERE l.here IS NOT NULL AND l.ready IS NOT NULL),
ahead AS (
  SELECT rec, route_rec, ready, state, org_from,
         stops[list_max(list_filter(range(1, len(stops) + 1), lambda i: stops[i] = here)):] AS stops
  FROM journeys WHERE list_contains(stops, here)),
hops AS (
  SELECT rec, route_rec, ready, CAST(k AS INTEGER) AS k, stops[k] AS src, stops[k + 1] AS dst,
         CAST(k + (state = 'load_noarrive')::INTEGER AS INTEGER) AS path_no,
         CASE WHEN k > 1 THEN stops[k - 1] WHEN state = 'load_noarrive' THEN org_from END AS came_from
  FROM ahead, unnest(range(1, len(stops))) AS u(k)),
ride AS (
  SELECT h.*, n.st AS start_time, n.st + to_minutes(n.run_minutes) AS end_time,
         n.st + to_minutes(n.run_minutes) + to_hours(n.unload_time) AS free_at
  FROM hops h, LATERAL ({SPLICED_CAND.format(t='h.ready', src='h.src', dst='h.dst')}) n WHERE h.k = 1
  UNION ALL
  SELECT h.*, n.st, n.st + to_minutes(n.run_minutes), n.st + to_minutes(n.run_minutes) + to_hours(n.unload_time)
  FROM ride b JOIN hops h ON h.rec = b.rec AND h.route_rec = b.route_rec AND h.k = b.k + 1,
       LATERAL ({SPLICED_CAND.format(t='b.free_at', src='h.src', dst='h.dst')}) n),
planned AS (
  SELECT p.waybill AS waybill_number, p.billed AS old_bill_time, p.car AS car_number, p.ready AS bill_time,
         p.bill_kg AS goods_weight, p.bill_m3 AS goods_volume, CAST(1 AS DOUBLE) AS goods_qty, p.bill_kg AS bill_weight,
         p.bill_m3 AS bill_volume, p.bill_qty, r.src AS leave_department_code, r.dst AS arrive_department_code,
         p.pickup AS customer_pickup_department_code, r.start_time, r.end_time, {LINE_KIND} AS line_type,
         p.state AS waybill_type, 'other' AS waybill_status, p.same AS next_day_arrive, r.came_from AS pre_org_code,
         r.path_no, {YES_NO.format(c='f.center')} AS depart_org_transfer,
         {YES_NO.format(c='t.center')} AS arrive_org_transfer, {STAMPS}
  FROM ride r JOIN located p ON p.rec = r.rec LEFT JOIN dept f ON f.code = r.src LEFT JOIN dept t ON t.code = r.dst
  WHERE f.center OR t.center)"""

ORACLE_SQL["pipeline_forecast"] = f"{FC_WITH}, {RUNNING}, {AHEAD}\nSELECT * FROM running UNION ALL SELECT * FROM planned"

ORACLE_SQL["line_info"] = f"""
WITH {SPLICED}
SELECT src AS leave_department_code, dst AS arrive_department_code, {HMS.format(s='leave_secs')} AS leave_time,
       run_minutes, unload_time FROM spliced
"""


# ---------------------------------------------------------------- sources and sinks

ORACLE_SQL["csv_round_trip"] = "SELECT * FROM customer"
ORACLE_SQL["first_load"] = "SELECT * FROM customer"
ORACLE_SQL["table_reload"] = "SELECT * REPLACE (c_acctbal + 1.0 AS c_acctbal) FROM customer"
ORACLE_SQL["guarded_drop"] = "SELECT count(*) AS kept_rows, FALSE AS foreign_dropped, TRUE AS own_dropped FROM orders"
ORACLE_SQL["upsert_table_idle"] = f"{WITH_FEEDS} SELECT * FROM volume_sign_c"
ORACLE_SQL["upsert_table"] = f"""{WITH_FEEDS}
SELECT * FROM volume_sign_c WHERE CAST(id AS BIGINT) % 2 = 1
UNION ALL
SELECT * REPLACE ('N01' AS operation_department_code, TIMESTAMP '2030-01-01 00:00:00' AS inflow_time)
FROM volume_sign_c WHERE CAST(id AS BIGINT) % 2 = 0"""

ORACLE_SQL["upsert_job"] = ORACLE_SQL["upsert_table"]
ORACLE_SQL["path_reload"] = ORACLE_SQL["table_reload"]


def _rejected(name: str) -> str:
    """Dates that are none, three times where a record comes in three versions."""
    number, _, source, _ = CLEANED[name]
    return (f"SELECT '{name}' AS table_name, 'create_time' AS column_name, "
            f"CAST(sum(CASE WHEN ({number}) % 10 = 3 THEN 3 ELSE 1 END) FILTER (({number}) % 97 = 6) AS BIGINT) AS rejects, "
            f"(SELECT count(*) FROM {name}_c) AS cleaned_rows FROM {source}")


ORACLE_SQL["job_clean_rejects"] = f"{WITH_FEEDS}\nSELECT * FROM (" + " UNION ALL ".join(map(_rejected, (
    "volume_stock", "volume_traffic", "volume_traffic_detail", "volume_unload_detail", "volume_waybill"))) + ") WHERE rejects > 0"
ORACLE_SQL["job_clean_bucketed"] = f"""{WITH_FEEDS}
SELECT id, waybill_number, bill_time, goods_qty FROM volume_waybill_c
WHERE waybill_number NOT IN (SELECT waybill_number FROM volume_sign_c)"""
ORACLE_SQL["job_forecast"] = f"SELECT *, refresh_time AS batch_no FROM ({ORACLE_SQL['pipeline_forecast']})"
ORACLE_SQL["job_warning"] = ORACLE_SQL["pipeline_warning"]
ORACLE_SQL["job_unscan"] = ORACLE_SQL["pipeline_unscan"]

BY_DAY = "event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') AS batch_no"
ORACLE_SQL["catalog_retention"] = f"SELECT {BY_DAY} FROM events WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-10'"
ORACLE_SQL["append_to_batch"] = f"""SELECT {BY_DAY} FROM events UNION ALL
SELECT {BY_DAY.replace('event_id', '-event_id AS event_id', 1)} FROM events WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15'"""
ORACLE_SQL["string_table"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CAST(user_id AS VARCHAR) AS user_id,
       event_type, CAST(value AS VARCHAR) AS value, props, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') AS batch_no
FROM events
"""

ORACLE_SQL["partition_overwrite"] = """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-15' THEN value + 1 ELSE value END AS value, props,
       strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d') AS batch_no
FROM events
"""

ORACLE_SQL["expire_batches"] = """
SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS day,
       strftime(ts, '%Y-%m-%d') AS batch_no
FROM events WHERE strftime(ts, '%Y-%m-%d') >= '2024-01-10'
"""

ORACLE_SQL["stream_clean_latest"] = ORACLE_SQL["clean_latest"]


# ---------------------------------------------------------------- role-playing org joins and province pairs

NATION_ORG = """norg AS (SELECT n_nationkey AS code, 'P' || CAST(n_regionkey AS VARCHAR) AS prov_code,
                        CASE WHEN n_regionkey <= 1 THEN 'Y' ELSE 'N' END AS center FROM nation)"""

ORACLE_SQL["org_roles"] = f"""
WITH {NATION_ORG}
SELECT l.l_orderkey, l.l_linenumber, a.center AS o1_center, b.center AS o2_center,
       CASE WHEN a.center = 'Y' AND b.center = 'Y' THEN '干线' ELSE '支线' END AS line_type
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN norg a ON s.s_nationkey = a.code LEFT JOIN norg b ON c.c_nationkey = b.code
"""

ORACLE_SQL["next_day_flag"] = f"""
WITH {NATION_ORG},
same_day AS (
  SELECT 'P' || CAST(r_regionkey AS VARCHAR) AS leave_province_code, 'P' || CAST(r_regionkey AS VARCHAR) AS arrive_province_code,
         'Y' AS equal_province FROM region
  UNION ALL
  SELECT 'P' || CAST(r_regionkey AS VARCHAR), 'P' || CAST((r_regionkey + 1) % 5 AS VARCHAR), 'N' FROM region)
SELECT o.o_orderkey, a.prov_code AS bill_prov_code, b.prov_code AS pickup_prov_code,
       CASE WHEN nx.equal_province = 'Y' THEN 'Y' ELSE 'N' END AS next_day_arrive
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN norg a ON c.c_nationkey = a.code
LEFT JOIN norg b ON CAST(o.o_orderkey % 25 AS INTEGER) = b.code
LEFT JOIN same_day nx ON a.prov_code = nx.leave_province_code AND b.prov_code = nx.arrive_province_code
"""
