"""DuckDB SQL that states, independently of the Spark code, what each
registered query must return. The derived test views (payroll, audit, dict,
poll_log) come first; each later common table expression builds on them.
DuckDB drops the expressions a query does not use."""

from __future__ import annotations

from quincena.plans.catalog import DEFAULT_STEM, REPORT_BASE_URL, TREND_DAYS
from quincena.sources.testviews import DUCKDB_VIEWS

# Tenure in months between a = start and b = end with Spark's months_between
# rules (whole months on equal day-of-month or two month-ends, else a
# 31-day fraction including the time of day, rounded to 8 digits).
_MONTHS = """(CASE WHEN day(a)=day(b) OR (day(a)=day(last_day(a)) AND day(b)=day(last_day(b)))
  THEN CAST((year(b)-year(a))*12+month(b)-month(a) AS DOUBLE)
  ELSE round((year(b)-year(a))*12+month(b)-month(a)
       + ((day(b)-day(a))*86400 + (epoch(b)-epoch(date_trunc('day',b)))
          - (epoch(a)-epoch(date_trunc('day',a))))/(31*86400.0), 8) END)"""

_KEYS = "cedula, nombre, apellido, institucion, cargo, estado"

DERIVED = f"""
bronze AS (
 SELECT * EXCLUDE (a, b),
  concat_ws('-', nombre, apellido, institucion, cargo, replace(cedula, '-', '')) AS composite_key,
  {_MONTHS} / 12 AS antiguedad
 FROM (SELECT *, CAST(fecha_de_inicio AS TIMESTAMP) AS a, fecha_actualizacion AS b FROM payroll)),
ddict AS (SELECT spanish, min(english) AS english FROM dict WHERE spanish IS NOT NULL GROUP BY spanish),
dim_inst AS (
 SELECT g.*, d.english AS institution_name_english FROM (
  SELECT institution_name_spanish, max(source_update) AS last_source_update, max(checked_at) AS last_checked_at
  FROM audit WHERE run_status = 'OK' GROUP BY institution_name_spanish) g
 LEFT JOIN ddict d ON g.institution_name_spanish = d.spanish),
dim_stat AS (
 SELECT g.*, d.english AS status_name_english FROM (
  SELECT status_name_spanish, max(source_update) AS last_source_update, max(checked_at) AS last_checked_at
  FROM audit WHERE run_status = 'OK' GROUP BY status_name_spanish) g
 LEFT JOIN ddict d ON g.status_name_spanish = d.spanish),
dim_pos AS (
 SELECT g.*, d.english AS position_name_english FROM (
  SELECT cargo AS position_name_spanish, min(fecha_actualizacion) AS last_seen_at
  FROM bronze WHERE cargo IS NOT NULL GROUP BY cargo) g
 LEFT JOIN ddict d ON g.position_name_spanish = d.spanish),
snapshot AS (
 SELECT b.composite_key, b.nombre AS first_name, b.apellido AS last_name, b.cedula AS id_number,
  b.salario AS salary, b.gasto AS allowance, b.estado AS status_sp, s.status_name_english AS status_en,
  b.institucion AS institution_sp, i.institution_name_english AS institution_en,
  b.cargo AS position_sp, p.position_name_english AS position_en, b.fecha_de_inicio AS start_date,
  b.fecha_actualizacion AS query_date, b.fecha_consulta AS snapshot_date,
  b.antiguedad AS years_of_service, b.archivo AS file
 FROM bronze b
 JOIN dim_inst i ON b.institucion = i.institution_name_spanish AND b.fecha_consulta = i.last_source_update
 JOIN dim_stat s ON b.estado = s.status_name_spanish AND b.fecha_consulta = s.last_source_update
 LEFT JOIN dim_pos p ON b.cargo = p.position_name_spanish),
scd2_ev AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEYS}, fecha_consulta
                               ORDER BY fecha_actualizacion DESC NULLS LAST, row_id DESC NULLS LAST) AS rn
  FROM bronze) WHERE rn = 1),
scd2_chg AS (
 SELECT *, CASE WHEN row_number() OVER w = 1
   OR salario IS DISTINCT FROM lag(salario) OVER w
   OR gasto IS DISTINCT FROM lag(gasto) OVER w
   OR fecha_de_inicio IS DISTINCT FROM lag(fecha_de_inicio) OVER w THEN 1 ELSE 0 END AS chg
 FROM scd2_ev WINDOW w AS (PARTITION BY {_KEYS} ORDER BY fecha_consulta)),
scd2_run AS (
 SELECT *, sum(chg) OVER (PARTITION BY {_KEYS} ORDER BY fecha_consulta
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
 FROM scd2_chg),
scd2_ver AS (
 SELECT * EXCLUDE (chg, run, rl) FROM (
  SELECT *, min(fecha_consulta) OVER (PARTITION BY {_KEYS}, run) AS __START_AT,
   row_number() OVER (PARTITION BY {_KEYS}, run ORDER BY fecha_consulta DESC) AS rl
  FROM scd2_run) WHERE rl = 1),
scd2 AS (
 SELECT *, lead(__START_AT) OVER (PARTITION BY {_KEYS} ORDER BY __START_AT) AS __END_AT FROM scd2_ver),
last_run AS (
 SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY institution_name_spanish, status_name_spanish
                               ORDER BY checked_at DESC) AS rn FROM poll_log) WHERE rn = 1),
v_last_run AS (
 SELECT *, CAST(run_status = 'OK' AS INTEGER) AS "OK", CAST(run_status = 'FAIL' AS INTEGER) AS "ERROR",
  concat(institution_name_spanish, ' - ', status_name_spanish) AS report FROM last_run),
api_log AS (SELECT *, concat(institution_name_spanish, ' - ', status_name_spanish) AS report FROM poll_log),
daily AS (SELECT CAST(date_trunc('day', start_at) AS TIMESTAMP) AS day, avg(time) AS avg_time FROM poll_log GROUP BY 1)
"""


def with_views(body: str) -> str:
    return "WITH " + DUCKDB_VIEWS.strip() + ",\n" + DERIVED.strip() + "\n" + body.strip()


def after_poll(body: str) -> str:
    """The views as they are after a poll run at the newest version: its rows
    are those of the sound reports, its polls are OK where one landed."""
    before = DUCKDB_VIEWS.strip().replace("payroll AS (", "payroll_all AS (", 1).replace("audit AS (", "audit_all AS (", 1)
    before = before.replace("FROM payroll", "FROM payroll_all")
    return "WITH " + before + """,
newest AS (SELECT max(fecha_consulta) AS v FROM payroll_all),
payroll AS (SELECT p.* FROM payroll_all p, newest WHERE fecha_consulta < v OR day(fecha_actualizacion) % 7 >= 5),
audit AS (
 SELECT a.* FROM audit_all a, newest WHERE source_update < v
 UNION ALL
 SELECT institucion, estado, CASE WHEN bool_or(day(fecha_actualizacion) % 7 >= 5) THEN 'OK' ELSE 'FAIL' END,
  v, TIMESTAMP '2024-01-01 00:00:00' FROM payroll_all, newest WHERE fecha_consulta = v GROUP BY institucion, estado, v),
""" + DERIVED.strip() + "\n" + body.strip()


_GOLD_POSITION_SQL = """
SELECT institution_sp, institution_en, status_sp, status_en, position_sp, position_en,
 sum(salary) AS total_salary, avg(salary) AS avg_salary, sum(allowance) AS total_allowance,
 avg(allowance) AS avg_allowance, sum(salary + allowance) AS total_compensation,
 count(*) AS employee_count, count(DISTINCT id_number) AS unique_employee_count,
 min(start_date) AS first_start_date, max(start_date) AS last_start_date,
 avg(years_of_service) AS avg_years_of_service, min(years_of_service) AS min_years_of_service,
 max(years_of_service) AS max_years_of_service
FROM snapshot GROUP BY ALL
"""

_GOLD_EMPLOYEE_SQL = """
SELECT id_number,
 CASE WHEN count(DISTINCT first_name) + count(DISTINCT last_name) > 2 THEN 1 ELSE 0 END AS multiple_names,
 sum(salary) AS total_salary, sum(allowance) AS total_allowance,
 sum(salary) + sum(allowance) AS total_compensation,
 count(DISTINCT position_sp) AS distinct_position_count,
 min(start_date) AS first_start_date, max(start_date) AS last_start_date,
 max(years_of_service) AS total_years_of_service
FROM snapshot GROUP BY id_number
"""

_PENDING_SQL = """
SELECT i.institution_name_spanish, s.status_name_spanish
FROM (SELECT DISTINCT institution_name_spanish FROM audit) i, (SELECT DISTINCT status_name_spanish FROM audit) s
WHERE NOT EXISTS (
 SELECT 1 FROM audit a WHERE a.run_status = 'OK' AND a.source_update >= (SELECT max(source_update) FROM audit)
  AND a.institution_name_spanish = i.institution_name_spanish AND a.status_name_spanish = s.status_name_spanish)"""

# Results of the run's requests: a pair's reports at the current version, read or not by the damage done to them.
_CLASSIFY_SQL = """
SELECT * FROM (SELECT i.institution_name_spanish, s.status_name_spanish,
 CASE WHEN EXISTS (SELECT 1 FROM audit a WHERE a.run_status = 'OK'
                   AND a.source_update >= (SELECT max(source_update) FROM audit)
                   AND a.institution_name_spanish = i.institution_name_spanish
                   AND a.status_name_spanish = s.status_name_spanish) THEN 'No Update'
      ELSE (SELECT CASE WHEN bool_or(day(p.fecha_actualizacion) % 7 >= 5) THEN 'OK' WHEN count(*) > 0 THEN 'FAIL' END
            FROM payroll p WHERE p.institucion = i.institution_name_spanish AND p.estado = s.status_name_spanish
             AND p.fecha_consulta = (SELECT max(source_update) FROM audit)
             AND CAST(replace(p.institucion, 'NATION_', '') AS INT) % 5 <> 0) END AS run_status,
 (SELECT max(source_update) FROM audit) AS source_update
FROM (SELECT DISTINCT institution_name_spanish FROM audit) i, (SELECT DISTINCT status_name_spanish FROM audit) s)
WHERE run_status IS NOT NULL"""

_REPORT_ID = "concat_ws('|', institucion, estado, strftime(fecha_actualizacion, '%Y%m%d%H%M%S'))"

ORACLE: dict[str, str] = {
    "bronze_enriched": with_views("SELECT * FROM bronze"),
    "dim_institution": with_views("SELECT * FROM dim_inst"),
    "dim_status": with_views("SELECT * FROM dim_stat"),
    "dim_position": with_views("SELECT * FROM dim_pos"),
    "names_by_phrase": """
WITH RECURSIVE p AS (
 SELECT *, split_part(p_name, ' ', 1) AS adj, split_part(p_name, ' ', 2) AS noun,
  concat_ws(' ', p_name, p_type, p_brand) AS name FROM part),
entries AS (
 SELECT spanish, min(english) AS english FROM (
  SELECT adj AS spanish, upper(adj) AS english FROM p WHERE length(adj) <> 4
  UNION ALL SELECT noun, 'the ' || noun FROM p
  UNION ALL SELECT p_name, 'one ' || p_name FROM p WHERE length(p_name) % 3 = 0
  UNION ALL SELECT p_type, lower(p_type) FROM p WHERE length(p_type) % 2 = 0
  UNION ALL SELECT noun || ' ' || p_type, 'kind ' || noun FROM p WHERE length(noun) % 2 = 1
  UNION ALL SELECT p_type || ' ' || p_brand, lower(p_brand) FROM p WHERE length(p_brand) = 7
  UNION ALL SELECT p_brand, replace(p_brand, '#', ' ') FROM p WHERE p_brand NOT LIKE '%7'
  UNION ALL SELECT name, 'entry ' || CAST(p_partkey AS VARCHAR) FROM p WHERE p_partkey % 50 = 0) GROUP BY spanish),
words AS (SELECT DISTINCT name, string_split(name, ' ') AS w FROM p),
cuts(name, w, pos, sizes, english) AS (
 SELECT name, w, 0, CAST([] AS BIGINT[]), CAST([] AS VARCHAR[]) FROM words
 UNION ALL
 SELECT c.name, c.w, c.pos + s.n, list_append(c.sizes, s.n), list_append(c.english, e.english)
 FROM cuts c CROSS JOIN (SELECT unnest(range(1, 5)) AS n) s
 JOIN entries e ON e.spanish = array_to_string(c.w[c.pos + 1:c.pos + s.n], ' ') WHERE c.pos + s.n <= len(c.w))
SELECT name, coalesce(whole.english, array_to_string(best.english, ' ')) AS english FROM words
LEFT JOIN entries whole ON whole.spanish = name
LEFT JOIN (SELECT name, arg_max(english, sizes) AS english FROM cuts WHERE pos = len(w) GROUP BY name) best USING (name)""",
    "snapshot_latest": with_views("SELECT * FROM snapshot"),
    "gold_position": with_views(_GOLD_POSITION_SQL),
    "gold_employee": with_views(_GOLD_EMPLOYEE_SQL),
    "gold_employee_positions": with_views("""
SELECT id_number, first_name, last_name, status_sp AS status, institution_sp AS institution,
 position_sp AS position, salary, allowance, start_date, years_of_service FROM snapshot"""),
    "scd2_history": with_views("SELECT * FROM scd2"),
    "scd2_current": with_views("SELECT * FROM scd2 WHERE __END_AT IS NULL"),
    "inactive_employees": with_views("""
SELECT cedula, nombre, apellido, cargo, estado, institucion, salario, gasto, fecha_de_inicio,
 __START_AT AS last_active_date, TIMESTAMP '2024-01-01 00:00:00' AS detected_at
FROM scd2 h WHERE __END_AT IS NULL AND NOT EXISTS (
 SELECT 1 FROM snapshot s WHERE s.id_number = h.cedula AND s.first_name = h.nombre
  AND s.last_name = h.apellido AND s.position_sp = h.cargo AND s.status_sp = h.estado)"""),
    "scd1_latest": with_views("SELECT * FROM last_run"),
    "audit_ok_filter": with_views("""
SELECT * FROM audit WHERE run_status = 'OK' AND source_update >= (SELECT max(source_update) FROM audit)"""),
    "pending_reports": with_views(_PENDING_SQL),
    "request_urls": with_views(f"""
SELECT institution_name_spanish, status_name_spanish,
 concat('{REPORT_BASE_URL}', '?&Ne=', replace(institution_name_spanish, ' ', '%20'),
        '&N=&A=&C=&E=', replace(status_name_spanish, ' ', '%20')) AS url
FROM ({_PENDING_SQL})"""),
    "audit_classify": with_views(_CLASSIFY_SQL),
    "updates_gate": with_views(f"""
SELECT count(*) FILTER (WHERE run_status = 'OK') AS updates,
 count(*) FILTER (WHERE run_status = 'OK') > 0 AS refresh FROM ({_CLASSIFY_SQL})"""),
    "poll_run_audit": with_views(f"""
SELECT institution_name_spanish, status_name_spanish, run_status, source_update,
 source_update + INTERVAL 1 DAY AS checked_at, source_update + INTERVAL 1 DAY AS start_at,
 source_update + INTERVAL 1 DAY + CASE WHEN run_status = 'FAIL' THEN INTERVAL 90 SECOND ELSE INTERVAL 0 SECOND END AS end_at,
 CAST(CASE WHEN run_status = 'FAIL' THEN 90 ELSE 0 END AS FLOAT) AS time
FROM ({_CLASSIFY_SQL})"""),
    "audit_append": with_views("""
SELECT institution_name_spanish, status_name_spanish, run_status, source_update, checked_at, start_at, end_at,
 CAST((epoch_us(end_at) - epoch_us(start_at)) / 1e6 AS FLOAT) AS time FROM poll_log"""),
    "mon_last_run": with_views("SELECT * FROM v_last_run"),
    "mon_counters": with_views("""
SELECT max(source_update) AS max_source_update, max(checked_at) AS max_checked_at,
 count(DISTINCT report) AS reports, CAST(sum("OK") AS BIGINT) AS files_downloaded,
 CAST(sum("ERROR") AS BIGINT) AS errors,
 sum("OK") / count(DISTINCT report) AS downloaded_ratio, sum("ERROR") / count(DISTINCT report) AS error_ratio
FROM v_last_run"""),
    "mon_run_table": with_views("""
SELECT date_trunc('second', start_at) AS start_second, report, run_status,
 date_trunc('day', source_update) AS source_day, avg(time) AS avg_time,
 CAST(sum("OK") AS BIGINT) AS ok_runs, CAST(sum("ERROR") AS BIGINT) AS error_runs
FROM v_last_run GROUP BY ALL"""),
    "mon_daily_avg": with_views("""
SELECT CAST(date_trunc('day', start_at) AS TIMESTAMP) AS day, avg(time) AS avg_time FROM api_log GROUP BY 1"""),
    "mon_trend": with_views(f"""
SELECT day, avg_time, round(f.b + f.m * x, 6) AS trend_time, avg_time IS NULL AS is_forecast
FROM (
  SELECT day, avg_time, CAST(datediff('day', DATE '1970-01-01', CAST(day AS DATE)) AS DOUBLE) AS x FROM daily
  UNION ALL
  SELECT CAST(d AS TIMESTAMP), NULL, CAST(datediff('day', DATE '1970-01-01', CAST(d AS DATE)) AS DOUBLE)
  FROM (SELECT unnest(generate_series(max(CAST(day AS DATE)) + 1, max(CAST(day AS DATE)) + {TREND_DAYS},
                                      INTERVAL 1 DAY)) AS d FROM daily)
) s, (SELECT regr_slope(avg_time, x) AS m, regr_intercept(avg_time, x) AS b FROM (
        SELECT avg_time, CAST(datediff('day', DATE '1970-01-01', CAST(day AS DATE)) AS DOUBLE) AS x FROM daily)) f"""),
    "mon_forecast": "WITH RECURSIVE" + with_views(f"""
, span AS (SELECT min(CAST(day AS DATE)) AS a, max(CAST(day AS DATE)) AS z FROM daily),
days AS (SELECT CAST(a + CAST(k AS INT) AS DATE) AS d, k, greatest(k - (z - a), 0) AS ahead, (epoch(CAST(a + CAST(k AS INT) AS TIMESTAMP)) // 86400) % 7 AS part
 FROM (SELECT a, z, unnest(range(0, (z - a) + {TREND_DAYS} + 1)) AS k FROM span)),
pts AS (SELECT days.*, daily.avg_time AS y FROM days LEFT JOIN daily ON CAST(daily.day AS DATE) = days.d),
fold AS (
 SELECT CAST(-1 AS BIGINT) AS k, (SELECT arg_min(y, k) FROM pts WHERE y IS NOT NULL) AS lev, CAST(0 AS DOUBLE) AS slo,
  CAST([0, 0, 0, 0, 0, 0, 0] AS DOUBLE[]) AS parts, CAST(NULL AS DOUBLE) AS fit
 UNION ALL
 SELECT k, l2, CASE WHEN y IS NULL THEN slo ELSE 0.05 * (l2 - lev) + (1 - 0.05) * slo END,
  list_transform(parts, lambda v, i: CASE WHEN i = part + 1 AND y IS NOT NULL THEN 0.2 * (y - l2) + (1 - 0.2) * v ELSE v END), fit2
 FROM (SELECT p.k, f.lev, f.slo, f.parts, p.part, p.y, f.lev + f.slo + f.parts[CAST(p.part + 1 AS BIGINT)] AS fit2,
        CASE WHEN p.y IS NULL THEN f.lev + f.slo
             ELSE 0.3 * (p.y - f.parts[CAST(p.part + 1 AS BIGINT)]) + (1 - 0.3) * (f.lev + f.slo) END AS l2
       FROM fold f JOIN pts p ON p.k = f.k + 1)),
dev AS (SELECT sqrt(avg((y - fit) * (y - fit))) AS sd FROM pts JOIN fold USING (k) WHERE y IS NOT NULL)
SELECT CAST(d AS TIMESTAMP) AS day, y AS avg_time, round(fit, 6) AS fitted,
 round(fit - 1.96 * sd * sqrt(greatest(ahead, 1)), 6) AS low, round(fit + 1.96 * sd * sqrt(greatest(ahead, 1)), 6) AS high,
 ahead > 0 AS is_forecast FROM pts JOIN fold USING (k), dev""").removeprefix("WITH"),
    "report_clean": with_views(f"""
SELECT nombre, apellido, cedula, cargo, salario, gasto, estado, fecha_de_inicio, fecha_actualizacion,
 fecha_consulta, CASE WHEN estado = 'P' THEN '{DEFAULT_STEM}' ELSE archivo END AS archivo, institucion
FROM payroll"""),
    "report_failures": with_views(f"""
SELECT DISTINCT {_REPORT_ID} AS report_id,
 CASE day(fecha_actualizacion) % 7 WHEN 0 THEN 'no header' WHEN 1 THEN 'no banner date'
  WHEN 2 THEN 'unreadable money' WHEN 3 THEN 'unreadable date' ELSE 'no sheet' END AS reason
FROM payroll WHERE day(fecha_actualizacion) % 7 < 5"""),
    "report_landed": with_views(f"""
SELECT nombre, apellido, cedula, cargo, salario, gasto, estado, fecha_de_inicio, fecha_actualizacion,
 fecha_consulta, CASE WHEN estado = 'P' THEN '{DEFAULT_STEM}' ELSE archivo END AS archivo, institucion
FROM payroll WHERE day(fecha_actualizacion) % 7 >= 5"""),
    "report_names": with_views(f"""
SELECT report_id, stem AS archivo,
 concat(stem, '_', estado, '_', CAST(CAST(epoch(data_version) AS BIGINT) AS VARCHAR), '_0.parquet') AS landing_file
FROM (SELECT concat_ws('|', institucion, estado, strftime(fecha_actualizacion, '%Y%m%d%H%M%S')) AS report_id,
        max(estado) AS estado, max(fecha_consulta) AS data_version,
        CASE WHEN max(estado) = 'P' THEN '{DEFAULT_STEM}' ELSE max(archivo) END AS stem
      FROM payroll GROUP BY 1)"""),
    "page_options": """
SELECT page_id, option_no, option FROM (
  SELECT page_id, generate_subscripts(items, 1) - 1 AS option_no, trim(unnest(items)) AS option
  FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1),
                                           '(?s)<a[^>]*>(.*?)</a>', 1) AS items FROM pages))
WHERE length(option) > 0 AND NOT contains(option, 'Seleccione')""",
    "page_select_options": """
SELECT page_id, n AS option_no, CASE n WHEN 2 THEN concat('MINISTERIO DE ECONOMÍA & FINANZAS ', page_id)
 ELSE concat('AÑO € ', page_id, ' &amp; &nada;') END AS option
FROM pages, (VALUES (2), (3)) t(n)""",
    "page_version": """
SELECT page_id, TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id * 7) + to_seconds(page_id % 60) AS data_version
FROM pages""",
    "clustered_write": with_views("SELECT * FROM snapshot"),
    "clustered_bronze": with_views("SELECT * FROM bronze"),
    "ingest_stream": with_views("SELECT * EXCLUDE (row_id) FROM bronze"),
    "ingest_rejected": with_views("""
SELECT 'column salario is string, not double' AS what, 1 AS n UNION ALL SELECT 'not a Parquet file', 1
UNION ALL SELECT 'rows ingested', count(*) FROM payroll"""),
    "scd2_stream": with_views("SELECT * FROM scd2"),
    "scd1_stream": with_views("SELECT * FROM last_run"),
    "dim_status_stream": with_views("SELECT * FROM dim_stat"),
    "dim_institution_stream": with_views("SELECT * FROM dim_inst"),
    "dim_position_stream": with_views("SELECT * FROM dim_pos"),
    "refresh_gold_position": with_views(_GOLD_POSITION_SQL),
    "refresh_views_consistent": with_views(f"""
SELECT 'snapshot' AS view, count(*) AS n, sum(salary) AS pay FROM snapshot
UNION ALL SELECT 'inactive_employees', count(*), sum(salario) FROM scd2 h WHERE __END_AT IS NULL AND NOT EXISTS (
 SELECT 1 FROM snapshot s WHERE s.id_number = h.cedula AND s.first_name = h.nombre
  AND s.last_name = h.apellido AND s.position_sp = h.cargo AND s.status_sp = h.estado)
UNION ALL SELECT 'gold_employee', count(*), sum(total_salary) FROM ({_GOLD_EMPLOYEE_SQL})
UNION ALL SELECT 'gold_position', count(*), sum(total_salary) FROM ({_GOLD_POSITION_SQL})"""),
    "full_refresh_history": with_views("SELECT * FROM scd2"),
    "poll_run_gold": after_poll(_GOLD_POSITION_SQL),
    "landing_files": with_views(f"""
SELECT concat(CASE WHEN estado = 'P' THEN '{DEFAULT_STEM}' ELSE archivo END, '_', estado, '_',
 CAST(CAST(epoch(fecha_consulta) AS BIGINT) AS VARCHAR), '_0.parquet') AS landing_file, count(*) AS n
FROM payroll WHERE day(fecha_actualizacion) % 7 >= 5 GROUP BY 1"""),
    "fixture_load": """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, CAST(n_nationkey AS VARCHAR) AS csv_key, n_name AS csv_name FROM nation""",
}
