"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed from the test tables (``quincena.plans.oracle.ORACLE`` holds the
DuckDB SQL that must give the same rows)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quincena.functions.columns import file_stem, landing_file_name
from quincena.operators import audit as audit_ops
from quincena.operators import bronze as bronze_ops
from quincena.operators import cdc, dims, gold, inactive, monitor, names, pages, reports, snapshot
from quincena.plans.poll import poll
from quincena.plans.refresh import Layout, full_refresh, refresh, served_views
from quincena.schemas import AUDIT_KEYS, SCD2_KEYS, SCD2_SEQUENCE, SCD2_TRACKED, payroll_schema
from quincena.session import materialize, scratch_path
from quincena.sources import testviews as tv
from quincena.sources.audit_table import append_audit, create_audit_table
from quincena.sources.fixtures import load_fixture
from quincena.sources.landing import land_files
from quincena.sources.tables import append_rows, read_table, write_clustered, write_view
from quincena.streaming import incremental as inc
from quincena.streaming.quarantine import quarantine, rejected
from quincena.streaming.store import VersionedTable

# Fixed detection time for comparable inactive-employee output.
DETECTED_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)
# Fixed check time of the poll run's test, after every version of the test tables.
POLLED_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)
# Test tie-break for events with one (keys, version): newest update, then row id.
SCD2_TIE_BREAK = ["fecha_actualizacion", "row_id"]


class Inputs:
    """Inputs of one query for (spark, sf_dir).

    The landing table (payroll), the audit log and the dictionary are
    derived from the test tables once and written to the shared checkpoint
    folder, which plays the role of the stored landing/audit tables of a
    deployment; every operator then reads those files.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def _get(self, key: str, build: Callable[[], DataFrame], store: bool = True,
             by: list[str] | None = None) -> DataFrame:
        if key not in self._cache:
            df = build()
            files = self.spark.sparkContext.defaultParallelism if by else None
            self._cache[key] = materialize(df, key, files, by) if store else df
        return self._cache[key]

    @property
    def payroll(self) -> DataFrame:
        """The landing table, written as one file per core (the test tables
        are single files, which would make every later scan one task)."""
        return self._get("payroll", lambda: tv.payroll(self.spark, self.sf_dir), by=["row_id"])

    @property
    def bronze(self) -> DataFrame:
        return self._get("bronze", lambda: bronze_ops.enrich(self.payroll), store=False)

    @property
    def audit(self) -> DataFrame:
        return self._get("audit", lambda: tv.audit(self.spark, self.sf_dir, self.payroll))

    @property
    def translations(self) -> DataFrame:
        return self._get("dict", lambda: tv.translations(self.spark, self.sf_dir, self.payroll))

    @property
    def poll_log(self) -> DataFrame:
        return self._get("poll_log", lambda: tv.poll_log(self.spark, self.sf_dir), store=False)

    def dim_institution(self) -> DataFrame:
        return self._get("dim_institution", lambda: dims.dim_institution(self.audit, self.translations))

    def dim_status(self) -> DataFrame:
        return self._get("dim_status", lambda: dims.dim_status(self.audit, self.translations))

    def dim_position(self) -> DataFrame:
        return self._get("dim_position", lambda: dims.dim_position(self.bronze, self.translations))

    def snapshot(self) -> DataFrame:
        return self._get("snapshot", lambda: snapshot.latest_snapshot(
            self.bronze, self.dim_institution(), self.dim_status(), self.dim_position()), store=False)

    def scd2(self) -> DataFrame:
        return self._get("scd2", lambda: cdc.scd2_history(
            self.bronze, SCD2_KEYS, SCD2_SEQUENCE, SCD2_TRACKED, SCD2_TIE_BREAK), store=False)


# --------------------------------------------------------------------------- queries

def q_bronze_enriched(spark, sf_dir):
    return Inputs(spark, sf_dir).bronze


def q_dim_institution(spark, sf_dir):
    return Inputs(spark, sf_dir).dim_institution()


def q_dim_status(spark, sf_dir):
    return Inputs(spark, sf_dir).dim_status()


def q_dim_position(spark, sf_dir):
    return Inputs(spark, sf_dir).dim_position()


def q_snapshot_latest(spark, sf_dir):
    return Inputs(spark, sf_dir).snapshot()


def q_gold_position(spark, sf_dir):
    return gold.position_summary(Inputs(spark, sf_dir).snapshot())


def q_gold_employee(spark, sf_dir):
    return gold.employee_summary(Inputs(spark, sf_dir).snapshot()).drop("positions_details_json")


def q_gold_employee_positions(spark, sf_dir):
    return gold.employee_positions(gold.employee_summary(Inputs(spark, sf_dir).snapshot()))


def q_scd2_history(spark, sf_dir):
    return Inputs(spark, sf_dir).scd2()


def q_scd2_current(spark, sf_dir):
    return cdc.scd2_current(Inputs(spark, sf_dir).scd2())


def q_inactive_employees(spark, sf_dir):
    """Reads the snapshot as a written view, as the refresh does."""
    i = Inputs(spark, sf_dir)
    return inactive.inactive_employees(i.scd2(), materialize(i.snapshot(), "snapshot"), detected_at=DETECTED_AT)


def q_scd1_latest(spark, sf_dir):
    return cdc.scd1_latest(Inputs(spark, sf_dir).poll_log, AUDIT_KEYS, "checked_at", ["run_id"])


# Placeholder base address of the report endpoint (deployment setting).
REPORT_BASE_URL = "https://portal.example/Formas/Reporte"
# Stem used when a response names no file (deployment setting).
DEFAULT_STEM = "report"
# Trend projection length in days.
TREND_DAYS = 7


def _current_version(audit: DataFrame):
    """The portal's current data version: the newest version in the log."""
    return audit.agg(F.max("source_update")).scalar()


def q_audit_ok_filter(spark, sf_dir):
    a = Inputs(spark, sf_dir).audit
    return audit_ops.up_to_date(a, _current_version(a))


def _plan(a: DataFrame) -> DataFrame:
    return audit_ops.request_plan(a.select("institution_name_spanish"), a.select("status_name_spanish"))


def q_pending_reports(spark, sf_dir):
    a = Inputs(spark, sf_dir).audit
    return audit_ops.pending_reports(_plan(a), a, _current_version(a))


def q_request_urls(spark, sf_dir):
    a = Inputs(spark, sf_dir).audit
    return audit_ops.request_urls(audit_ops.pending_reports(_plan(a), a, _current_version(a)), REPORT_BASE_URL)


def _polled(spark, sf_dir):
    """One run at the current version: the audit log, the plan, and the
    results of its requests as reading the reports gave them (some are
    damaged; pairs of one institution in five were not requested)."""
    i = Inputs(spark, sf_dir)
    v = _current_version(i.audit)
    requested = F.regexp_replace("institucion", "NATION_", "").cast("int") % 5 != 0
    p = materialize(i.payroll.where((F.col("fecha_consulta") == v) & requested), "polled")
    meta = materialize(tv.report_meta(p), "report_meta")
    sheets = materialize(tv.damaged_sheets(tv.report_sheets(p)), "sheet_rows")
    failures = reports.read_reports(sheets, meta, DEFAULT_STEM)[1]
    return i.audit, v, _plan(i.audit), reports.results(meta, failures)


def q_audit_classify(spark, sf_dir):
    a, v, plan, results = _polled(spark, sf_dir)
    return audit_ops.classify_runs(plan, a, v, results)


def q_updates_gate(spark, sf_dir):
    return audit_ops.updates_gate(q_audit_classify(spark, sf_dir))


def q_poll_run_audit(spark, sf_dir):
    """Audit rows of one run: failed requests took 90 seconds from the check
    time; all are checked a day after the version."""
    a, v, plan, results = _polled(spark, sf_dir)
    checked = v + F.expr("INTERVAL 1 DAY")
    times = results.where(F.col("run_status") == "FAIL").select(
        *AUDIT_KEYS, checked.alias("start_at"), (checked + F.expr("INTERVAL 90 SECONDS")).alias("end_at"))
    return audit_ops.poll_run(plan, a, v, results, times, checked)


def q_audit_append(spark, sf_dir):
    """Create the audit table (Parquet, shared folder), append typed rows built
    from the poll log, append them again, read the table back."""
    log = Inputs(spark, sf_dir).poll_log
    location = scratch_path(spark, "audit_table")
    name = "audit_" + location.rsplit("-", 1)[-1]
    create_audit_table(spark, name, location, ntz=True)
    rows = audit_ops.audit_rows(log, F.col("checked_at"))
    append_audit(spark, name, rows)
    append_audit(spark, name, rows)  # a replay adds nothing
    return spark.table(name)


def _last_run(spark, sf_dir):
    return monitor.last_run(Inputs(spark, sf_dir).poll_log, ["run_id"])


def q_mon_last_run(spark, sf_dir):
    return _last_run(spark, sf_dir)


def q_mon_counters(spark, sf_dir):
    return monitor.counters(_last_run(spark, sf_dir))


def q_mon_run_table(spark, sf_dir):
    return monitor.run_table(_last_run(spark, sf_dir))


def q_mon_daily_avg(spark, sf_dir):
    return monitor.daily_avg(monitor.with_report(Inputs(spark, sf_dir).poll_log))


def q_mon_trend(spark, sf_dir):
    return monitor.trend(materialize(monitor.daily_avg(Inputs(spark, sf_dir).poll_log), "daily"), TREND_DAYS)


def q_mon_forecast(spark, sf_dir):
    return monitor.seasonal_forecast(materialize(monitor.daily_avg(Inputs(spark, sf_dir).poll_log), "daily"), TREND_DAYS)


def q_report_clean(spark, sf_dir):
    """Raw sheet rows and report metadata are stored tables in a deployment;
    here they are derived from the payroll and written once."""
    p = Inputs(spark, sf_dir).payroll
    sheets = materialize(tv.report_sheets(p), "sheet_rows")
    meta = materialize(tv.report_meta(p), "report_meta")
    return reports.clean_reports(sheets, meta, DEFAULT_STEM)


def _damaged(spark, sf_dir):
    p = Inputs(spark, sf_dir).payroll
    sheets = materialize(tv.damaged_sheets(tv.report_sheets(p)), "sheet_rows")
    return reports.read_reports(sheets, materialize(tv.report_meta(p), "report_meta"), DEFAULT_STEM)


def q_report_failures(spark, sf_dir):
    """Reports that land nothing, with the reason."""
    return _damaged(spark, sf_dir)[1]


def q_report_landed(spark, sf_dir):
    """Rows of the sound reports among damaged ones, landed and read back."""
    landing, landed = scratch_path(spark, "landing"), _damaged(spark, sf_dir)[0]
    append_rows(landed, landing, partition_by=["archivo"])
    return spark.read.schema(landed.schema).parquet(landing)


def q_report_names(spark, sf_dir):
    meta = tv.report_meta(Inputs(spark, sf_dir).payroll)
    stem = file_stem(F.col("content_disposition"), DEFAULT_STEM)
    return meta.select("report_id", stem.alias("archivo"),
                       landing_file_name(stem, F.col("estado"), F.col("data_version")).alias("landing_file"))


# Drop-down of the test pages: the navigation list and its links.
NAV_BLOCK = r"(?s)<nav[^>]*>(.*?)</nav>"
NAV_ITEM = r"(?s)<a[^>]*>(.*?)</a>"


def q_page_options(spark, sf_dir):
    return pages.page_options(read_table(spark, sf_dir, "pages"), NAV_BLOCK, NAV_ITEM)


def q_page_select_options(spark, sf_dir):
    """Options of a drop-down whose names hold tags and character references."""
    return pages.page_options(tv.select_pages(read_table(spark, sf_dir, "pages")), pages.select_block("cmbInst"))


def q_page_version(spark, sf_dir):
    return pages.page_version(tv.portal_pages(read_table(spark, sf_dir, "pages")))


def q_clustered_write(spark, sf_dir):
    """Snapshot written as a materialised view clustered by institution and
    status, read back."""
    path = scratch_path(spark, "snapshot_view")
    write_view(Inputs(spark, sf_dir).snapshot(), path, cluster_by=["institution_sp", "status_sp"])
    return spark.read.parquet(path)


def q_clustered_bronze(spark, sf_dir):
    """Bronze laid out along a curve over institution and data version, read back."""
    path = scratch_path(spark, "clustered_bronze")
    write_clustered(materialize(Inputs(spark, sf_dir).bronze, "bronze"), path, ["institucion", "fecha_consulta"])
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- triggered streams
# The streaming queries land their input in three arrivals (time ranges of
# the data, every row exactly once) and run the stream after each arrival,
# then once more with nothing new. Arrival orders other than chronological
# deliver late data.

ARRIVALS = 3


def _arrivals(df: DataFrame, time_col: str, order: list[int]) -> list[DataFrame]:
    lo, hi = df.agg(F.min(time_col), F.max(time_col)).first()
    span = (hi - lo) / ARRIVALS
    cuts = [lo + span * i for i in range(1, ARRIVALS)]
    parts = []
    for i in range(ARRIVALS):
        c = F.lit(True)
        if i > 0:
            c = c & (F.col(time_col) >= F.lit(cuts[i - 1]).cast("timestamp_ntz"))
        if i < ARRIVALS - 1:
            c = c & (F.col(time_col) < F.lit(cuts[i]).cast("timestamp_ntz"))
        if i == 0:
            c = c | F.col(time_col).isNull()
        parts.append(df.where(c))
    return [parts[i] for i in order]


def _land_and_run(spark, df: DataFrame, time_col: str, order: list[int], run) -> None:
    landing = scratch_path(spark, "landing")
    for part in _arrivals(df, time_col, order):
        append_rows(part, landing)
        run(landing)
    run(landing)


def q_ingest_stream(spark, sf_dir):
    """Landing files → bronze through the file stream (schema enforced)."""
    i = Inputs(spark, sf_dir)
    out, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "bronze_ckpt")
    schema = payroll_schema(T.TimestampNTZType())
    bschema = []
    _land_and_run(spark, i.payroll, "fecha_consulta", [0, 1, 2],
                  lambda landing: bschema.append(
                      inc.ingest_bronze(spark, landing, schema, out, ckpt, max_files_per_trigger=4)))
    return inc.read_bronze(spark, out, bschema[-1])


def q_ingest_rejected(spark, sf_dir):
    """The payroll landed together with a file whose salaries are text and one
    that is no Parquet file: both are set aside, with their reasons, and the
    sound files go through the ingest."""
    i = Inputs(spark, sf_dir)
    landing, away, ckpt, out, done = (scratch_path(spark, n) for n in ("landing", "rejected", "check_ckpt", "bronze", "bronze_ckpt"))
    append_rows(i.payroll, landing)
    append_rows(i.payroll.withColumn("salario", F.col("salario").cast("string")).coalesce(1), landing)
    i.payroll.select("nombre").coalesce(1).write.mode("append").text(landing)
    schema = payroll_schema(T.TimestampNTZType())
    quarantine(spark, landing, schema, away, ckpt)
    bronze = inc.read_bronze(spark, out, inc.ingest_bronze(spark, landing, schema, out, done))
    return rejected(spark, away).groupBy(F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n")).unionAll(
        bronze.agg(F.lit("rows ingested").alias("what"), F.count(F.lit(1)).alias("n")))


def q_scd2_stream(spark, sf_dir):
    """Bronze arrivals out of time order → incremental type-2 history."""
    b = Inputs(spark, sf_dir).bronze
    ev, hist, ckpt = (scratch_path(spark, n) for n in ("scd2_events", "scd2_history", "scd2_ckpt"))
    _land_and_run(spark, b, "fecha_consulta", [2, 0, 1],
                  lambda landing: inc.update_history(spark, landing, b.schema, ev, hist, ckpt, SCD2_TIE_BREAK))
    return inc.read_history(spark, hist, b.schema, SCD2_TIE_BREAK)


def q_scd1_stream(spark, sf_dir):
    """Poll-log arrivals out of time order → latest poll per report."""
    log = Inputs(spark, sf_dir).poll_log
    target, ckpt = scratch_path(spark, "scd1"), scratch_path(spark, "scd1_ckpt")
    _land_and_run(spark, log, "checked_at", [1, 0, 2],
                  lambda landing: inc.update_latest_poll(spark, landing, log.schema, target, ckpt, ["run_id"],
                                                         max_files_per_trigger=4))
    return VersionedTable(spark, target).read()


def q_dim_status_stream(spark, sf_dir):
    """Audit arrivals → status dimension from a complete-mode aggregate."""
    i = Inputs(spark, sf_dir)
    a, d = i.audit, i.translations
    target, ckpt = scratch_path(spark, "dim_status"), scratch_path(spark, "dim_status_ckpt")
    _land_and_run(spark, a, "source_update", [0, 2, 1],
                  lambda landing: inc.update_name_dimension(spark, landing, a.schema, "status_name_spanish",
                                                            "status_name_english", d, target, ckpt,
                                                            max_files_per_trigger=4))
    return VersionedTable(spark, target).read()


def q_dim_institution_stream(spark, sf_dir):
    """Audit arrivals → institution dimension from a complete-mode aggregate."""
    i = Inputs(spark, sf_dir)
    a, d = i.audit, i.translations
    target, ckpt = scratch_path(spark, "dim_institution"), scratch_path(spark, "dim_institution_ckpt")
    _land_and_run(spark, a, "source_update", [2, 1, 0],
                  lambda landing: inc.update_name_dimension(spark, landing, a.schema, "institution_name_spanish",
                                                            "institution_name_english", d, target, ckpt,
                                                            max_files_per_trigger=4))
    return VersionedTable(spark, target).read()


def q_dim_position_stream(spark, sf_dir):
    """Bronze arrivals in time order → append-only position dimension."""
    i = Inputs(spark, sf_dir)
    b, d = i.bronze, i.translations
    target, ckpt = scratch_path(spark, "dim_position"), scratch_path(spark, "dim_position_ckpt")
    _land_and_run(spark, b, "fecha_consulta", [0, 1, 2],
                  lambda landing: inc.update_positions(spark, landing, b.schema, target, ckpt))
    return inc.read_positions(spark, target, b.schema, d)


def q_names_by_phrase(spark, sf_dir):
    """English names of names without an entry, cut into phrases of the dictionary."""
    found, entries = tv.part_names(spark, sf_dir)
    return names.translate_phrases(found, "name", entries, "english")


def q_refresh_gold_position(spark, sf_dir):
    """End to end: land payroll and audit rows in a fresh deployment folder,
    run one refresh, read the position summary it wrote."""
    i = Inputs(spark, sf_dir)
    layout = Layout(scratch_path(spark, "deployment"))
    append_rows(i.payroll, layout.landing)
    append_rows(i.audit, layout.audit)
    out = refresh(spark, layout, i.translations, landing_schema=i.payroll.schema,
                  audit_table_schema=i.audit.schema, tie_break=SCD2_TIE_BREAK, detected_at=DETECTED_AT)
    return spark.read.parquet(out["gold_position"])


def _deploy(spark, i: Inputs, payroll: DataFrame, audit: DataFrame) -> tuple[Layout, dict]:
    """A fresh deployment folder with what has landed so far, and its options."""
    layout = Layout(scratch_path(spark, "deployment"))
    append_rows(payroll, layout.landing)
    append_rows(audit, layout.audit)
    return layout, {"landing_schema": i.payroll.schema, "audit_table_schema": i.audit.schema,
                    "tie_break": SCD2_TIE_BREAK, "detected_at": DETECTED_AT}


def _refreshed_twice(spark, sf_dir) -> tuple[Inputs, Layout, dict]:
    """A deployment that got its rows in two arrivals, each followed by a refresh."""
    i = Inputs(spark, sf_dir)
    v = _current_version(i.audit)
    old, new = F.col("fecha_consulta") < v, F.col("fecha_consulta") >= v
    layout, options = _deploy(spark, i, i.payroll.where(old), i.audit.where(F.col("source_update") < v))
    refresh(spark, layout, i.translations, **options)
    append_rows(i.payroll.where(new), layout.landing)
    append_rows(i.audit.where(F.col("source_update") >= v), layout.audit)
    refresh(spark, layout, i.translations, **options)
    return i, layout, options


def q_refresh_views_consistent(spark, sf_dir):
    """All four views as the manifest serves them after two refreshes: rows
    and pay of each, which must be those of one state."""
    _, layout, _ = _refreshed_twice(spark, sf_dir)
    pay = {"snapshot": "salary", "inactive_employees": "salario", "gold_employee": "total_salary",
           "gold_position": "total_salary"}
    return reduce(DataFrame.unionAll, [rows.agg(F.lit(view).alias("view"), F.count(F.lit(1)).alias("n"), F.sum(pay[view]).alias("pay"))
                                       for view, rows in served_views(spark, layout).items()])


def q_full_refresh_history(spark, sf_dir):
    """After two incremental refreshes everything is rebuilt in a new
    generation; its history is the batch one."""
    i, layout, options = _refreshed_twice(spark, sf_dir)
    out = full_refresh(spark, layout, i.translations, **options)
    return inc.read_history(spark, out["scd2_history"], bronze_ops.enrich(i.payroll).schema, SCD2_TIE_BREAK)


def q_poll_run_gold(spark, sf_dir):
    """One poll run from the portal's page and the (partly damaged) report
    sheets of the newest version to the refreshed position summary."""
    i = Inputs(spark, sf_dir)
    version = F.col("fecha_consulta") == i.payroll.agg(F.max("fecha_consulta")).scalar()
    new = materialize(i.payroll.where(version), "polled")
    layout, options = _deploy(spark, i, i.payroll.where(~version), i.audit.where(
        F.col("source_update") < i.payroll.agg(F.max("fecha_consulta")).scalar()))
    sheets = materialize(tv.damaged_sheets(tv.report_sheets(new)), "sheet_rows")
    out = poll(spark, layout, tv.index_page(i.payroll), sheets, materialize(tv.report_meta(new), "report_meta"),
               i.translations, POLLED_AT, DEFAULT_STEM, **options)
    return spark.read.parquet(out["gold_position"])


def q_landing_files(spark, sf_dir):
    """The sound reports landed as files under their own names, twice (a
    replay replaces them): names and rows of the files."""
    p = Inputs(spark, sf_dir).payroll
    sheets = materialize(tv.damaged_sheets(tv.report_sheets(p)), "sheet_rows")
    rows, _ = reports.read_reports(sheets, materialize(tv.report_meta(p), "report_meta"), DEFAULT_STEM, with_file=True)
    path = scratch_path(spark, "landing")
    for _ in range(2):
        land_files(rows, path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return spark.read.schema(rows.drop("landing_file").schema).parquet(path).groupBy(name.alias("landing_file")).agg(
        F.count(F.lit(1)).alias("n"))


def q_fixture_load(spark, sf_dir):
    """nation as a JSON list and as CSV, both loaded as fixtures and joined."""
    nation, root = read_table(spark, sf_dir, "nation"), scratch_path(spark, "fixtures")
    whole = nation.coalesce(1).agg(F.to_json(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))))  # 25 rows
    whole.write.text(f"{root}/nation.json")
    nation.select("n_nationkey", "n_name").write.option("header", True).csv(f"{root}/nation.csv")
    listed = load_fixture(spark, f"{root}/nation.json")
    strings = load_fixture(spark, f"{root}/nation.csv").toDF("csv_key", "csv_name")
    return listed.join(strings, F.col("n_nationkey").cast("string") == F.col("csv_key"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_enriched": q_bronze_enriched,
    "dim_institution": q_dim_institution,
    "dim_status": q_dim_status,
    "dim_position": q_dim_position,
    "names_by_phrase": q_names_by_phrase,
    "snapshot_latest": q_snapshot_latest,
    "gold_position": q_gold_position,
    "gold_employee": q_gold_employee,
    "gold_employee_positions": q_gold_employee_positions,
    "scd2_history": q_scd2_history,
    "scd2_current": q_scd2_current,
    "inactive_employees": q_inactive_employees,
    "scd1_latest": q_scd1_latest,
    "audit_ok_filter": q_audit_ok_filter,
    "pending_reports": q_pending_reports,
    "request_urls": q_request_urls,
    "audit_classify": q_audit_classify,
    "updates_gate": q_updates_gate,
    "poll_run_audit": q_poll_run_audit,
    "audit_append": q_audit_append,
    "mon_last_run": q_mon_last_run,
    "mon_counters": q_mon_counters,
    "mon_run_table": q_mon_run_table,
    "mon_daily_avg": q_mon_daily_avg,
    "mon_trend": q_mon_trend,
    "mon_forecast": q_mon_forecast,
    "report_clean": q_report_clean,
    "report_failures": q_report_failures,
    "report_landed": q_report_landed,
    "report_names": q_report_names,
    "page_options": q_page_options,
    "page_select_options": q_page_select_options,
    "page_version": q_page_version,
    "clustered_write": q_clustered_write,
    "clustered_bronze": q_clustered_bronze,
    "ingest_stream": q_ingest_stream,
    "ingest_rejected": q_ingest_rejected,
    "scd2_stream": q_scd2_stream,
    "scd1_stream": q_scd1_stream,
    "dim_status_stream": q_dim_status_stream,
    "dim_institution_stream": q_dim_institution_stream,
    "dim_position_stream": q_dim_position_stream,
    "refresh_gold_position": q_refresh_gold_position,
    "refresh_views_consistent": q_refresh_views_consistent,
    "full_refresh_history": q_full_refresh_history,
    "poll_run_gold": q_poll_run_gold,
    "landing_files": q_landing_files,
    "fixture_load": q_fixture_load,
}
