"""DuckDB oracle SQL for every registered query (same column names as Spark).

The driver pre-registers the driver tables as views; derived inputs are
written as CTEs with the same definitions as ``sluice.plans.views``.
"""

from __future__ import annotations

from sluice.functions.exprs import PREDEFINED_PIPELINE_TYPES

# --- derived inputs (FIXTURES.md §2), DuckDB dialect -------------------------
HUMANIZE = ("array_to_string(list_transform(string_split(replace({c}, '_', ' '), ' '), "
            "lambda w: upper(w[1]) || lower(w[2:])), ' ')")

RUN_HISTORY = f"""run_history AS (
 SELECT *, {HUMANIZE.format(c='action')} AS pipeline_type FROM (
 SELECT event_id AS id,
  CASE event_type WHEN 'view' THEN 'full_refresh' WHEN 'click' THEN 'incremental'
    WHEN 'signup' THEN 'scheduled_incremental' WHEN 'purchase' THEN 'force_refresh' ELSE 'nightly_custom' END AS action,
  ts AS start_time,
  CASE WHEN event_id % 7 <= 4 THEN ts + INTERVAL '1' HOUR END AS end_time,
  CASE WHEN event_id % 7 <= 4 THEN CAST(value AS DECIMAL(10,2)) END AS duration_seconds,
  CASE WHEN event_id % 7 <= 2 THEN value < 60 WHEN event_id % 7 = 3 THEN FALSE END AS success,
  CASE WHEN event_id % 7 <= 2 THEN 'completed' WHEN event_id % 7 = 3 THEN 'failed'
    WHEN event_id % 7 = 4 THEN 'interrupted' WHEN event_id % 7 = 5 THEN 'pending' ELSE 'done' END AS status,
  CASE WHEN event_id % 7 <> 5 THEN props END AS result,
  ts AS created_at, user_id AS run_id
 FROM events))"""

TASK_STATE = """task_state AS (
 SELECT o_custkey AS run_id, o_orderkey AS task_id,
  CASE WHEN o_orderkey % 11 = 0 THEN 'ScheduledIncrementalPipeline' WHEN o_orderkey % 11 = 1 THEN 'FullRefreshPipeline'
    ELSE concat('Task', CAST(o_orderkey % 50 AS VARCHAR)) END AS name,
  CASE o_orderkey % 23 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'PENDING' WHEN 3 THEN 'DISABLED' ELSE 'DONE' END AS status,
  CASE WHEN o_orderkey % 23 <> 2 THEN o_orderdate END AS start_time,
  CASE WHEN o_orderkey % 13 = 0 THEN 'False' ELSE 'True' END AS incremental
 FROM orders)"""

LOG_LINES = """log_lines AS (
 SELECT event_id AS line_no, CASE event_id % 6 WHEN 0 THEN 'This progress looks :)'
  WHEN 1 THEN concat('Task ', event_type, ' failed: earlier step completed successfully')
  WHEN 2 THEN concat('Pipeline FAILED at ', event_type) WHEN 3 THEN concat('  Starting task: ', event_type, ' ')
  WHEN 4 THEN 'Connecting to database' ELSE concat('row ', event_type) END AS line FROM events)"""

JOB_OUTCOME = """job_outcome AS (
 SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 0 END AS returncode,
  CASE o_orderkey % 4 WHEN 0 THEN 'Pipeline Completed Successfully' WHEN 1 THEN 'This progress looks :)'
    WHEN 2 THEN 'rows written' ELSE 'step failed' END AS stdout,
  CASE o_orderkey % 3 WHEN 0 THEN 'ERROR: lock wait' WHEN 1 THEN 'Error notice' ELSE '' END AS stderr FROM orders)"""

ORDERS_DELTA = """orders_delta AS (
 SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority, 1 AS seq
   FROM orders WHERE o_orderkey % 10 = 0
 UNION ALL SELECT o_orderkey, o_custkey, 'V', o_totalprice + 2, o_orderdate, o_orderpriority, 2 FROM orders WHERE o_orderkey % 20 = 0
 UNION ALL SELECT -o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority, 1 FROM orders WHERE o_orderkey % 50 = 1),
latest_delta AS (
 SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn FROM orders_delta) WHERE rn = 1)"""

JSON_BODIES = """json_bodies AS (
 SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN substring(props, 1, length(props)-1) ELSE props END AS body FROM events)"""

JOB_EDGES = """job_edges AS (
 SELECT p_partkey AS job, CASE WHEN p_partkey % 7 = 0 THEN -1 ELSE CAST(floor(p_partkey / 2.0) AS BIGINT) END AS dep
 FROM part WHERE p_partkey > 0)"""

ENC_PER_PATIENT = """enc AS (
 SELECT o_custkey, count(*) AS encounters, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_dec, count(DISTINCT o_orderstatus) AS statuses
 FROM orders GROUP BY o_custkey)"""

FLAT_ENC = """flat_enc AS (
 SELECT c_custkey, c_name, c_mktsegment, n_name, r_name, o_orderkey, o_orderdate, o_orderstatus, o_totalprice
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 JOIN orders ON o_custkey = c_custkey)"""

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def predefined_values_sql() -> str:
    rows = ", ".join(f"({i}, '{a}', '{p}')" for i, (a, p) in enumerate(PREDEFINED_PIPELINE_TYPES))
    return f"(VALUES {rows}) AS pre(ord, action, pipeline_type)"


ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# --- flatten / summary -------------------------------------------------------
oracle("patient_summary", """
SELECT c_custkey, c_name, count(o_orderkey) AS encounters, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(o_orderkey), 0) AS avg_total,
 count(DISTINCT o_orderstatus) AS statuses
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""")

oracle("flattened_patient_encounters", f"WITH {FLAT_ENC} SELECT * FROM flat_enc")

oracle("flattened_observations", f"""WITH {FLAT_ENC}
SELECT f.*, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_shipdate, p_name, p_type
FROM flat_enc f LEFT JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey""")

oracle("observation_summary", """
SELECT p_type, l_returnflag, count(*) AS observations,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty,
 CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_qty,
 count(DISTINCT l_orderkey) AS encounters
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, l_returnflag""")

oracle("location_summary", """
SELECT n_nationkey, n_name, r_name, count(DISTINCT c_custkey) AS patients, count(o_orderkey) AS encounters,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, max(o_orderdate) AS last_seen
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_nationkey, n_name, r_name""")

oracle("core_patients", """SELECT c_custkey AS patient_id, c_name AS name, c_nationkey AS location_id,
 c_mktsegment AS segment FROM customer""")
oracle("core_encounters", """SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_orderdate AS encounter_date,
 o_orderstatus AS status, o_totalprice AS total FROM orders""")
oracle("core_observations", """SELECT l_orderkey AS encounter_id, l_linenumber AS line_no, l_partkey AS concept_id,
 l_quantity AS value, l_returnflag AS flag, l_shipdate AS observed_at FROM lineitem""")
oracle("core_locations", """SELECT n_nationkey AS location_id, n_name AS location_name, r_name AS region_name
 FROM nation JOIN region ON n_regionkey = r_regionkey""")

# --- 2.1 sources / 2.3 sinks / 2.4 jobs -------------------------------------
ORDERS_ALL = f"SELECT {ORDERS_COLS} FROM orders"
for _k in ("extract_full", "empty_source_keeps_target", "full_refresh_overwrite", "append_load",
           "job_extract_load_full", "job_extract_load_incremental", "job_incremental_reruns",
           "job_timestamp_watermark", "job_retry_append", "job_empty_first_upsert", "job_bounded_batches"):
    oracle(_k, ORDERS_ALL)

oracle("extract_incremental", ORDERS_ALL + " WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'")
oracle("extract_parameterized", """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
 WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00' AND o_orderstatus <> 'P'""")
oracle("load_json_records", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
oracle("load_json_arrays", """SELECT 'array' AS kind, c_custkey AS k, c_name AS v FROM customer
 UNION ALL SELECT 'scalar', CAST(NULL AS BIGINT), p_name FROM part""")
oracle("load_json_scalars", """SELECT CASE p_partkey % 3 WHEN 0 THEN concat('[', p_name, ']') WHEN 1 THEN concat('{', p_name)
 ELSE p_name END AS v FROM part""")
# Values with more than half of a batch are batches of their own; the others fill windows of half a batch.
oracle("extract_batches", """WITH h AS (SELECT o_orderdate AS v, count(*) AS n FROM orders
  WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00' GROUP BY o_orderdate),
 c AS (SELECT v, n, n * 2 > 1000 AS heavy,
   coalesce(sum(CASE WHEN n * 2 > 1000 THEN 1 ELSE 0 END) OVER w, 0) AS heavies,
   coalesce(sum(CASE WHEN n * 2 > 1000 THEN 0 ELSE n END) OVER w, 0) AS before
  FROM h WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT row_number() OVER (ORDER BY min(v)) - 1 AS batch, min(v) AS low, max(v) AS high, CAST(sum(n) AS BIGINT) AS rows
FROM c GROUP BY heavies, heavy, CASE WHEN heavy THEN -1 ELSE floor(before * 2 / 1000.0) END""")
oracle("config_merge_last_wins", """SELECT concat('Task', CAST(p_partkey AS VARCHAR)) AS task,
 CASE WHEN p_partkey % 250 >= 240 THEN 'summary' ELSE 'extract_load' END AS type,
 CASE WHEN p_partkey % 250 >= 240 THEN concat('Task', CAST(p_partkey - 1 AS VARCHAR)) ELSE '' END AS deps
 FROM part""")
oracle("upsert_orders", f"""WITH {ORDERS_DELTA}
SELECT * FROM latest_delta
UNION ALL SELECT {ORDERS_COLS} FROM orders o WHERE NOT EXISTS (SELECT 1 FROM latest_delta d WHERE d.o_orderkey = o.o_orderkey)""")
# The tables as they are after the changes; the derived tables' own SQL follows.
CHANGED = ORDERS_DELTA + """,
changed_orders AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN o_custkey - 1 ELSE o_custkey END AS o_custkey, o_orderstatus,
  o_totalprice, o_orderdate FROM latest_delta
 UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders o
 WHERE NOT EXISTS (SELECT 1 FROM latest_delta d WHERE d.o_orderkey = o.o_orderkey)),
changed_customer AS (SELECT c_custkey, c_name, c_mktsegment,
  CASE WHEN c_mktsegment = 'BUILDING' THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS c_nationkey FROM customer)"""


def over_changed(sql: str) -> str:
    return sql.replace("FROM customer", "FROM changed_customer customer").replace("JOIN customer", "JOIN changed_customer customer") \
        .replace("FROM orders", "FROM changed_orders orders").replace("JOIN orders", "JOIN changed_orders orders")


oracle("maintained_flattened", f"WITH {CHANGED}, {over_changed(FLAT_ENC)} SELECT * FROM flat_enc")
for _name in ("patient_summary", "location_summary"):
    oracle(f"maintained_{_name}", f"WITH {CHANGED} {over_changed(ORACLE[_name])}")
oracle("dedupe_last_wins", f"""WITH {ORDERS_DELTA.split('),' + chr(10) + 'latest_delta')[0]})
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, seq FROM (
 SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS rn FROM orders_delta) WHERE rn = 1""")
oracle("upsert_partial_columns", f"""WITH {ORDERS_DELTA}
SELECT t.o_orderkey, t.o_custkey,
 CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
 CASE WHEN d.o_orderkey IS NOT NULL THEN d.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
 t.o_orderdate, t.o_orderpriority
FROM orders t LEFT JOIN latest_delta d ON t.o_orderkey = d.o_orderkey
UNION ALL
SELECT d.o_orderkey, d.o_custkey, d.o_orderstatus, d.o_totalprice, d.o_orderdate, '0-UNKNOWN'
FROM latest_delta d WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderkey = d.o_orderkey)""")
oracle("bucketed_full_refresh", ORDERS_ALL + " WHERE o_orderstatus = 'F'")
oracle("load_upsert_duplicates", f"WITH {ORDERS_DELTA} SELECT {ORDERS_COLS} FROM latest_delta")
oracle("job_parameterized", ORACLE["extract_parameterized"])
oracle("job_partial_upsert", ORACLE["upsert_partial_columns"])
oracle("job_failure_status", """SELECT t.table_name, 'completed' AS status, n AS record_count
 FROM (SELECT count(*) AS n FROM orders), (VALUES ('orders_t'), ('after_orders_t')) t(table_name)
 UNION ALL SELECT 'Broken', 'failed', CAST(0 AS BIGINT)""")
oracle("insert_with_defaults", """SELECT concat('t', CAST(o_orderkey AS VARCHAR)) AS table_name,
 CAST(o_custkey AS BIGINT) AS record_count, 'pending' AS status, CAST(NULL AS VARCHAR) AS error_message FROM orders""")
oracle("truncate_table", "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM orders")
oracle("ddl_metadata_tables", f"WITH {RUN_HISTORY} SELECT id, action, pipeline_type, start_time, 'completed' AS status FROM run_history")
oracle("write_clustered_layout", ORACLE["patient_summary"])
oracle("clustered_second_column", ORDERS_ALL + " WHERE o_totalprice >= 100000 AND o_totalprice < 110000")
oracle("upsert_collated", """WITH people AS (SELECT concat('É ', upper(c_name), c_custkey) AS name, c_acctbal AS acctbal FROM customer),
 d AS (SELECT concat('e ', lower(c_name), c_custkey) AS name, c_acctbal + 1 AS acctbal, 1 AS seq FROM customer WHERE c_custkey % 5 = 0
  UNION ALL SELECT concat('E ', c_name, c_custkey), c_acctbal + 2, 2 FROM customer WHERE c_custkey % 10 = 0
  UNION ALL SELECT concat('N ', c_name, c_custkey), c_acctbal + 1, 1 FROM customer WHERE c_custkey % 7 = 1
  UNION ALL SELECT concat('ñ ', lower(c_name), c_custkey), c_acctbal + 2, 2 FROM customer WHERE c_custkey % 14 = 1),
 latest AS (SELECT lower(strip_accents(name)) AS k, arg_min(name, seq) AS name, arg_max(acctbal, seq) AS acctbal FROM d GROUP BY 1)
SELECT p.name, CASE WHEN l.k IS NULL THEN p.acctbal ELSE l.acctbal END AS acctbal
 FROM people p LEFT JOIN latest l ON l.k = lower(strip_accents(p.name))
UNION ALL SELECT name, acctbal FROM latest l WHERE NOT EXISTS (SELECT 1 FROM people p WHERE l.k = lower(strip_accents(p.name)))""")
oracle("positional_bind", """SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, o_orderdate AS encounter_date,
 CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders""")
oracle("sql_script_transform", """SELECT c_mktsegment, o_orderstatus, count(*) AS encounters,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
 count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00') AS recent
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus""")
oracle("table_function_transform", """SELECT c_custkey, c_name, o_orderkey, o_orderdate, o_totalprice
FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'""")
oracle("summary_multi_statement", """WITH e AS (SELECT o_custkey, count(*) AS encounters,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY o_custkey),
 p AS (SELECT c_custkey, c_mktsegment, coalesce(encounters, 0) AS encounters, spend
  FROM customer LEFT JOIN e ON o_custkey = c_custkey)
SELECT c_mktsegment, count(*) AS patients, CAST(sum(encounters) AS BIGINT) AS encounters,
 CAST(sum(spend) AS DOUBLE) AS spend FROM p GROUP BY c_mktsegment""")

# --- 2.10 metadata ----------------------------------------------------------
oracle("load_record_counts", " UNION ALL ".join(
    f"SELECT '{n}_t' AS table_name, CAST(count(*) AS INTEGER) AS record_count, 'completed' AS status FROM {n}"
    for n in ("customer", "orders", "lineitem", "part", "supplier")))
oracle("load_metadata_upsert", """WITH c AS (
  SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 counts AS (SELECT concat('load_', lower(n_name)) AS table_name, count(*) AS record_count FROM c GROUP BY n_name
  UNION ALL SELECT concat('load_region_', lower(r_name)), count(*) FROM c GROUP BY r_name),
 stale AS (SELECT concat('load_', lower(n_name)) AS table_name FROM nation)
SELECT coalesce(s.table_name, k.table_name) AS table_name,
 CASE WHEN s.table_name IS NOT NULL THEN TIMESTAMP '2000-01-01 00:00:00' END AS last_update_timestamp,
 CAST(coalesce(k.record_count, 0) AS INTEGER) AS record_count,
 CASE WHEN k.table_name IS NOT NULL THEN 'completed' ELSE 'running' END AS status,
 CASE WHEN s.table_name IS NOT NULL THEN 'stale' END AS error_message,
 CASE WHEN k.table_name IS NOT NULL THEN TIMESTAMP '2001-08-02 00:00:00' ELSE TIMESTAMP '2000-01-01 00:00:00' END AS updated_at
FROM stale s FULL OUTER JOIN counts k ON s.table_name = k.table_name""")
oracle("task_status_upsert", f"""WITH {TASK_STATE}
SELECT name AS table_name, CAST(count(*) AS INTEGER) AS record_count,
 lower(arg_max(status, {{'s': coalesce(start_time, TIMESTAMP '1970-01-01'), 't': task_id}})) AS status,
 CASE WHEN arg_max(status, {{'s': coalesce(start_time, TIMESTAMP '1970-01-01'), 't': task_id}}) = 'FAILED'
  THEN 'task failed' END AS error_message,
 TIMESTAMP '2001-08-02 00:00:00' AS last_update_timestamp
FROM task_state GROUP BY name""")
oracle("watermark_advance", """WITH seeds(source_table, target_table, incremental_field, wm) AS (VALUES
  ('orders', 'encounters', 'o_orderdate', TIMESTAMP '2000-01-01'),
  ('lineitem', 'observations', 'l_shipdate', TIMESTAMP '2001-01-01'),
  ('events', 'run_events', 'ts', TIMESTAMP '2024-01-15'),
  ('orders', 'encounters_archive', 'o_orderdate', TIMESTAMP '2030-01-01')),
 mx AS (
  SELECT 'encounters' AS target_table, max(o_orderdate) AS m FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'
  UNION ALL SELECT 'observations', max(l_shipdate) FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-01-01'
  UNION ALL SELECT 'run_events', max(ts) FROM events WHERE ts > TIMESTAMP '2024-01-15'
  UNION ALL SELECT 'encounters_archive', max(o_orderdate) FROM orders WHERE o_orderdate > TIMESTAMP '2030-01-01')
SELECT s.source_table, s.target_table, s.incremental_field, CAST(m AS VARCHAR) AS last_processed_value,
 coalesce(m, wm) AS last_processed_timestamp, 1000 AS batch_size, true AS is_active
FROM seeds s JOIN mx USING (target_table)""")

# --- history ------------------------------------------------------------------
HCOLS = "id, action, pipeline_type, start_time, end_time, duration_seconds, success, status, result, created_at"


def iso(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN strftime({c}, '%f') <> '000000' THEN '.' || strftime({c}, '%f') ELSE '' END END")


def rh(sql: str) -> str:
    return f"WITH {RUN_HISTORY} {sql}"


oracle("history_filtered", rh(f"SELECT {HCOLS} FROM run_history WHERE action = 'incremental' AND success = false"))
oracle("history_date_range", rh("""SELECT id, action, start_time FROM run_history
 WHERE CAST(start_time AS DATE) >= DATE '2024-01-10' AND CAST(start_time AS DATE) <= DATE '2024-01-20'"""))
oracle("history_count", rh("""SELECT count(*) AS total FROM run_history WHERE action = 'full_refresh'
 AND CAST(start_time AS DATE) >= DATE '2024-01-05' AND CAST(start_time AS DATE) <= DATE '2024-01-25'"""))
oracle("history_status_filter", rh("""SELECT 'success' AS status_filter, count(*) FILTER (WHERE success = true) AS runs FROM run_history
 UNION ALL SELECT 'failed', count(*) FILTER (WHERE success = false) FROM run_history
 UNION ALL SELECT 'pending', count(*) FILTER (WHERE status = 'pending') FROM run_history
 UNION ALL SELECT 'running', count(*) FILTER (WHERE status = 'running') FROM run_history
 UNION ALL SELECT 'interrupted', count(*) FILTER (WHERE status = 'interrupted') FROM run_history
 UNION ALL SELECT 'completed', count(*) FILTER (WHERE status = 'completed') FROM run_history
 UNION ALL SELECT 'all', count(*) FROM run_history"""))
oracle("history_last_pending", rh("""SELECT id, action, pipeline_type, start_time, status, result FROM run_history
 WHERE status IN ('pending', 'running') ORDER BY created_at DESC, id DESC LIMIT 1"""))
oracle("history_page", rh(f"""SELECT id, action, pipeline_type, {iso('start_time')} AS start_time,
 {iso('end_time')} AS end_time, duration_seconds, success, status, result, {iso('created_at')} AS timestamp
 FROM run_history WHERE status = 'completed' ORDER BY created_at DESC, id DESC LIMIT 25 OFFSET 50"""))
oracle("history_page_count", rh("""SELECT count(*) AS total, 25 AS per_page, CAST(ceil(count(*) / 25) AS BIGINT) AS pages
 FROM run_history WHERE status = 'completed'"""))
HSTATS = f"""SELECT total_runs,
 (CASE WHEN total_runs = 0 THEN 0 ELSE (2000 * ok + total_runs) // (2 * total_runs) END) / 10.0 AS success_rate,
 (CASE WHEN n_dur = 0 THEN 0 ELSE (2 * cents + 10 * n_dur) // (20 * n_dur) END) / 10.0 AS avg_duration,
 {iso('last')} AS last_run
FROM (SELECT count(*) AS total_runs, count(*) FILTER (WHERE success) AS ok,
  CAST(sum(CAST(duration_seconds * 100 AS BIGINT)) AS BIGINT) AS cents, count(duration_seconds) AS n_dur,
  max(created_at) AS last FROM run_history {{where}})"""
oracle("history_stats", rh(HSTATS.format(where="")))
oracle("history_stats_empty", rh(HSTATS.format(where="WHERE action = 'no_such_action'")))
oracle("history_types", rh(f"""SELECT action, pipeline_type FROM {predefined_values_sql()}
 UNION ALL SELECT DISTINCT action, pipeline_type FROM run_history
 WHERE action NOT IN (SELECT action FROM {predefined_values_sql()})"""))
oracle("history_iso", rh(f"""SELECT id, {iso('start_time')} AS start_iso, {iso('end_time')} AS end_iso,
 {iso('created_at')} AS created_iso FROM run_history"""))
oracle("history_display", rh("""SELECT id,
 CASE WHEN coalesce(success, false) THEN 'success' WHEN status = 'failed' THEN 'failed' WHEN status = 'done' THEN 'done'
  WHEN status = 'interrupted' THEN 'interrupted' ELSE 'pending' END AS row_class,
 CASE WHEN coalesce(success, false) THEN 'Success' WHEN status IN ('failed', 'unknown') THEN 'Failed'
  WHEN status = 'done' THEN 'Done' WHEN status = 'interrupted' THEN 'Interrupted' WHEN status = 'pending' THEN 'Pending'
  ELSE 'Unknown' END AS status_label,
 coalesce(strftime(start_time, '%Y-%m-%d %H:%M:%S'), 'N/A') AS start_display,
 CASE WHEN coalesce(duration_seconds, 0) <> 0 THEN CAST(CAST(round(duration_seconds, 1) AS DECIMAL(11,1)) AS VARCHAR)
  ELSE 'N/A' END || 's' AS duration_display,
 CASE WHEN result IS NOT NULL AND length(result) > 0
  THEN left(result, 100) || CASE WHEN length(result) > 100 THEN '...' ELSE '' END ELSE 'No details' END AS result_preview
FROM run_history"""))
oracle("history_append", rh("""SELECT id, action, pipeline_type, start_time,
 CASE WHEN end_epoch IS NOT NULL THEN make_timestamp(CAST(round(end_epoch * 1000000) AS BIGINT)) END AS end_time,
 CAST(CASE WHEN end_epoch IS NOT NULL THEN round(end_epoch - start_epoch, 2) END AS DECIMAL(10,2)) AS duration_seconds,
 CASE WHEN status = 'completed' THEN ok END AS success, status,
 left(nullif(res, ''), 1000) AS result,
 coalesce(CASE WHEN end_epoch IS NOT NULL THEN make_timestamp(CAST(round(end_epoch * 1000000) AS BIGINT)) END, start_time) AS created_at
FROM (SELECT h.id, h.action, h.pipeline_type, h.start_time, h.status,
  epoch_us(e.ts) / 1000000 AS start_epoch,
  CASE WHEN e.event_id % 7 <= 4 THEN epoch_us(e.ts) / 1000000 + e.value END AS end_epoch,
  e.value < 60 AS ok,
  CASE WHEN e.event_id % 9 = 0 THEN '' ELSE repeat(e.props, CAST(e.event_id % 200 AS INTEGER)) END AS res
 FROM events e JOIN run_history h ON e.event_id = h.id)"""))
oracle("history_update", rh("""SELECT h.id, coalesce(u.status, h.status) AS status,
 CASE WHEN u.term THEN coalesce(make_timestamp(CAST(round(u.end_epoch * 1000000) AS BIGINT)), TIMESTAMP '2024-02-01 00:00:00')
  ELSE h.end_time END AS end_time,
 CASE WHEN u.term THEN CAST(round(u.end_epoch - epoch_us(h.start_time) / 1000000, 2) AS DECIMAL(10,2))
  ELSE h.duration_seconds END AS duration_seconds,
 CASE WHEN u.term THEN u.success ELSE h.success END AS success,
 CASE WHEN u.id IS NOT NULL THEN left(nullif(u.result, ''), 1000) ELSE h.result END AS result
FROM run_history h LEFT JOIN (
 SELECT id, 'completed' AS status, epoch_us(start_time) / 1000000 + 90.5 AS end_epoch, true AS success,
  'Tasks: 3 completed, 0 failed, 0 pending, 0 disabled.' AS result, true AS term FROM run_history WHERE status = 'pending' AND id % 2 = 0
 UNION ALL SELECT id, 'done', NULL, NULL, 'still done', false FROM run_history WHERE status = 'pending' AND id % 2 = 1
 UNION ALL SELECT id, 'failed', NULL, false, '', true FROM run_history WHERE status = 'interrupted' AND id % 3 = 0
) u ON h.id = u.id"""))

# --- progress -----------------------------------------------------------------
ROLLUP = f"""{TASK_STATE},
roll AS (
 SELECT run_id, count(*) AS total_tasks, count(*) FILTER (WHERE status = 'DONE') AS completed_tasks,
  count(*) FILTER (WHERE status = 'RUNNING') AS running_tasks, count(*) FILTER (WHERE status = 'FAILED') AS failed_tasks,
  count(*) FILTER (WHERE status = 'PENDING') AS pending_tasks, count(*) FILTER (WHERE status = 'DISABLED') AS disabled_tasks,
  arg_max(name, {{'s': coalesce(start_time, TIMESTAMP '1970-01-01'), 't': -task_id}}) FILTER (WHERE status = 'RUNNING') AS current_task,
  min(start_time) AS pipeline_start_time,
  bool_or(contains(name, 'Incremental')) AS hi, bool_or(contains(name, 'FullRefresh')) AS hf,
  bool_or(incremental = 'False') AS hp
 FROM task_state GROUP BY run_id),
r AS (
 SELECT run_id, total_tasks, completed_tasks, running_tasks, failed_tasks, pending_tasks, disabled_tasks,
  current_task, pipeline_start_time,
  CASE WHEN total_tasks > 0 THEN least(95, (completed_tasks * 100) // total_tasks) ELSE 0 END AS progress,
  running_tasks > 0 AS running,
  CASE WHEN hi THEN 'incremental' WHEN hf THEN 'full_refresh' WHEN hp THEN 'full_refresh' ELSE 'unknown' END AS pipeline_type,
  coalesce(CAST((epoch_us(TIMESTAMP '2001-08-02 00:00:00') - epoch_us(pipeline_start_time)) // 1000000 AS BIGINT), 0) AS elapsed_time,
  CASE WHEN running_tasks > 0 THEN NULL
   WHEN failed_tasks = 0 AND completed_tasks > 0 AND pending_tasks = 0 AND disabled_tasks = 0 THEN 'completed'
   WHEN pending_tasks > 0 THEN 'pending' WHEN failed_tasks > 0 THEN 'failed' ELSE 'done' END AS final_status,
  CASE WHEN running_tasks = 0 THEN (failed_tasks = 0 AND completed_tasks > 0 AND pending_tasks = 0 AND disabled_tasks = 0) END AS success,
  CASE WHEN running_tasks > 0 THEN 'running_pipeline' WHEN pending_tasks > 0 THEN 'pending' ELSE 'ready' END AS state
 FROM roll),
msg AS (
 SELECT run_id,
  CASE WHEN running THEN 'Running ' || coalesce(current_task, 'pipeline') || '... (' || completed_tasks || '/' || total_tasks
    || ' tasks completed, ' || elapsed_time || 's elapsed)' || CASE WHEN failed_tasks > 0 THEN ', ' || failed_tasks || ' failed' ELSE '' END
   WHEN completed_tasks = total_tasks AND total_tasks > 0 THEN 'Pipeline completed '
    || CASE WHEN failed_tasks = 0 THEN 'successfully' ELSE 'with ' || failed_tasks || ' failures' END
    || '! (' || completed_tasks || '/' || total_tasks || ' tasks completed)'
   WHEN pending_tasks > 0 THEN 'Pipeline pending... (' || completed_tasks || '/' || total_tasks || ' tasks completed, '
    || pending_tasks || ' pending)'
   ELSE 'Luigi daemon is running. Ready to start pipelines.' END AS message,
  CASE WHEN NOT running THEN 'Tasks: ' || completed_tasks || ' completed, ' || failed_tasks || ' failed, '
   || pending_tasks || ' pending, ' || disabled_tasks || ' disabled.' END AS result_msg
 FROM r)"""
oracle("progress_rollup", f"WITH {ROLLUP} SELECT * EXCLUDE (current_task) FROM r")
oracle("progress_current_task", f"WITH {ROLLUP} SELECT run_id, current_task FROM r")
oracle("progress_message", f"WITH {ROLLUP} SELECT * FROM msg")
oracle("progress_heartbeat", f"""WITH {ROLLUP} SELECT run_id, least(90, 10 + elapsed_time // 10) AS progress,
 'Pipeline running... (' || elapsed_time || 's elapsed)' AS message FROM r""")
oracle("reconcile_runs", f"""WITH {RUN_HISTORY}, {ROLLUP},
h AS (SELECT run_id AS h_run_id, arg_max(id, {{'c': created_at, 'i': id}}) AS hid, arg_max(action, {{'c': created_at, 'i': id}}) AS haction
 FROM run_history WHERE status IN ('pending', 'running') GROUP BY run_id)
SELECT h.hid AS id, r.run_id, r.final_status AS status, r.success, m.result_msg AS result
FROM r JOIN msg m USING (run_id) JOIN h ON r.run_id = h.h_run_id AND (h.haction = r.pipeline_type OR r.pipeline_type = 'unknown')
WHERE NOT r.running""")
oracle("classify_log_lines", f"""WITH {LOG_LINES}, c AS (SELECT line_no, line,
 CASE WHEN contains(line, 'This progress looks :)') OR contains(lower(line), 'completed successfully') THEN 'completed'
  WHEN contains(lower(line), 'failed') AND (contains(lower(line), 'pipeline') OR contains(lower(line), 'task')) THEN 'failed'
  WHEN contains(lower(line), 'starting') OR contains(lower(line), 'initializing') OR contains(lower(line), 'connecting to database')
  THEN 'starting' END AS outcome FROM log_lines)
SELECT line_no, outcome, CASE WHEN outcome IN ('completed', 'failed') THEN 100 WHEN outcome = 'starting' THEN 5 END AS progress,
 CASE WHEN outcome IS NOT NULL THEN outcome = 'starting' END AS running,
 CASE WHEN outcome = 'starting' THEN regexp_replace(line, '^\\s+|\\s+$', '', 'g') END AS message FROM c""")
oracle("classify_outcomes", f"""WITH {JOB_OUTCOME}, c AS (SELECT run_id, returncode = 0 AND NOT (
  (contains(stdout, 'ERROR') OR contains(stderr, 'ERROR') OR contains(stdout, 'FAILED') OR contains(stderr, 'FAILED')
   OR contains(stdout, 'Exception') OR contains(stderr, 'Exception') OR contains(stdout, 'Traceback') OR contains(stderr, 'Traceback')
   OR contains(stdout, 'error') OR contains(stderr, 'error') OR contains(stdout, 'failed') OR contains(stderr, 'failed'))
  AND NOT (contains(lower(stdout), 'completed successfully') OR contains(lower(stdout), 'pipeline completed')
   OR contains(lower(stdout), 'successfully') OR contains(lower(stdout), 'This progress looks :)'))) AS success FROM job_outcome)
SELECT run_id, success, CASE WHEN success THEN 'success' ELSE 'failure' END AS outcome FROM c""")

# --- lineage / quality --------------------------------------------------------
oracle("dependency_edges", f"WITH {JOB_EDGES} SELECT job, dep FROM job_edges WHERE dep IN (SELECT p_partkey FROM part)")
oracle("pending_jobs", """SELECT p_partkey AS job FROM part p WHERE NOT EXISTS (
 SELECT 1 FROM lineitem l WHERE l.l_shipdate < TIMESTAMP '1996-01-01' AND l.l_partkey = p.p_partkey)""")
oracle("dependency_levels", f"""WITH RECURSIVE {JOB_EDGES},
 e AS (SELECT job, dep FROM job_edges WHERE dep IN (SELECT p_partkey FROM part)),
 lv(job, level) AS (
  SELECT p_partkey, 0 FROM part WHERE p_partkey NOT IN (SELECT job FROM e)
  UNION ALL SELECT e.job, lv.level + 1 FROM e JOIN lv ON e.dep = lv.job)
SELECT job, max(level) AS level FROM lv GROUP BY job""")
oracle("dependency_closure", f"""WITH RECURSIVE {JOB_EDGES},
 e AS (SELECT job, dep FROM job_edges WHERE dep IN (SELECT p_partkey FROM part)),
 r(job, ancestor) AS (SELECT job, dep FROM e UNION SELECT r.job, e.dep FROM r JOIN e ON e.job = r.ancestor)
SELECT job, ancestor FROM r""")
oracle("dependency_cycles", f"""WITH RECURSIVE {JOB_EDGES},
 f AS (SELECT job, dep FROM job_edges WHERE dep IN (SELECT p_partkey FROM part)),
 e AS (SELECT job, dep FROM f UNION SELECT dep, job FROM f WHERE job % 50 = 3),
 r(job, ancestor) AS (SELECT job, dep FROM e UNION SELECT r.job, e.dep FROM r JOIN e ON e.job = r.ancestor)
SELECT a.job, min(a.ancestor) AS cycle FROM r a JOIN r b ON a.job = b.ancestor AND a.ancestor = b.job GROUP BY a.job""")
oracle("json_quarantine", f"WITH {JSON_BODIES} SELECT id, json_valid(body) AS valid FROM json_bodies")
oracle("collated_group_count", """WITH s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment)
 ELSE replace(c_mktsegment, 'E', 'É') END AS seg FROM customer)
SELECT min(lower(seg)) AS label, count(*) AS n FROM s GROUP BY lower(strip_accents(seg))""")
oracle("path_tree", """WITH p AS (SELECT CASE WHEN regexp_extract(url, '^(.*)/[^/]*$', 1) = '' THEN 'root'
 ELSE regexp_extract(url, '^(.*)/[^/]*$', 1) END AS folder, url AS path FROM pages)
SELECT folder, path, count(*) OVER (PARTITION BY folder) AS folder_files FROM p""")

# --- streaming ----------------------------------------------------------------
oracle("stream_incremental_load", ORDERS_ALL)
oracle("stream_upsert", ORACLE["upsert_orders"])
oracle("stream_classify_lines", ORACLE["classify_log_lines"])
oracle("stream_status_counts", f"WITH {TASK_STATE} SELECT status, count(*) AS tasks FROM task_state GROUP BY status")
