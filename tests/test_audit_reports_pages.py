import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quincena.operators import audit, dims, monitor, pages, reports
from quincena.sources.fixtures import load_fixture

V0, V1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
AUDIT = ("institution_name_spanish string, status_name_spanish string, run_status string, "
         "source_update timestamp_ntz, checked_at timestamp_ntz")


def test_plan_pending_and_quotes(spark):
    a = spark.createDataFrame([("D'ARIEN", "E1", "OK", V1, V1), ("D'ARIEN", "E2", "OK", V0, V0),
                               ("ALFA", "E1", "FAIL", V1, V1)], AUDIT)
    plan = audit.request_plan(a.select("institution_name_spanish"), a.select("status_name_spanish"))
    assert plan.count() == 4
    pend = sorted(tuple(r) for r in audit.pending_reports(plan, a, V1).collect())
    assert pend == [("ALFA", "E1"), ("ALFA", "E2"), ("D'ARIEN", "E2")]
    results = spark.createDataFrame([("ALFA", "E1", "FAIL"), ("D'ARIEN", "E2", "FAIL"), ("D'ARIEN", "E2", "OK"),
                                     ("D'ARIEN", "E1", "OK"), ("ELSE", "E9", "OK")],
                                    "institution_name_spanish string, status_name_spanish string, run_status string")
    runs = audit.classify_runs(plan, a, V1, results)
    got = {(r[0], r[1]): r.run_status for r in runs.collect()}
    # ALFA E2 was never requested: no row; one OK among several requests counts
    assert got == {("D'ARIEN", "E1"): "No Update", ("D'ARIEN", "E2"): "OK", ("ALFA", "E1"): "FAIL"}
    assert audit.updates_gate(runs).collect()[0].asDict() == {"updates": 1, "refresh": True}
    assert audit.updates_gate(runs.union(runs)).collect()[0].asDict() == {"updates": 1, "refresh": True}
    assert audit.updates_gate(runs.limit(0)).collect()[0].asDict() == {"updates": 0, "refresh": False}


def test_plan_is_the_same_for_any_number_of_groups(spark):
    i = spark.range(30).select(F.concat(F.lit("I"), F.col("id").cast("string")).alias("institution_name_spanish"))
    s = spark.range(12).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("status_name_spanish"))
    small = sorted(tuple(r) for r in audit.request_plan(i, s).collect())
    big = sorted(tuple(r) for r in audit.request_plan(i, s, chunks=4).collect())
    assert small == big and len(small) == 360


def test_t18_fail_updates_latest_poll_not_dimension(spark):
    a = spark.createDataFrame([("I", "E", "OK", V0, V0), ("I", "E", "FAIL", V1, V1)], AUDIT)
    last = monitor.last_run(a).collect()[0]
    assert last.run_status == "FAIL" and last.ERROR == 1 and last.report == "I - E"
    d = dims.dim_status(a, spark.createDataFrame([("E", "Status")], "spanish string, english string")).collect()[0]
    assert d.last_source_update == V0 and d.status_name_english == "Status"


def test_t19_options(spark):
    html = ('<select id="ddl"><option>Seleccione uno</option><option> ALFA </option><option>   </option>'
            '<option value="2">BETA</option></select><select id="other"><option>X</option></select>')
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = [r.option for r in pages.page_options(df, pages.select_block("ddl")).orderBy("option_no").collect()]
    assert got == ["ALFA", "BETA"]


def test_page_version(spark):
    html = "<p>Fecha de actualización de los datos:   5/3/2024 2:30:00 PM</p>"
    df = spark.createDataFrame([(1, "u", html), (2, "u", "none")], "page_id long, url string, html string")
    got = sorted(tuple(r) for r in pages.page_version(df).collect())
    assert got == [(1, dt.datetime(2024, 3, 5, 14, 30)), (2, None)]


def test_t2_sheet_rows(spark):
    banner = [None, None, None, None, "Fecha de actualización: 05/03/2024 02:30:00 PM"]
    h1 = ["Nombre", "Apellido", "Cédula", "Cargo", "Salario", "Gasto", "Estado", "Fecha de Inicio"]
    h2 = ["Fecha de Inicio", "Estado", "Gasto", "Salario", "Cargo", "Cedula", "Apellido", "Nombre"]
    rows = [("r", 1, 1, ["Informe"]), ("r", 1, 2, ["INST"]), ("r", 1, 3, banner), ("r", 1, 4, []),
            ("r", 1, 5, h1), ("r", 1, 6, ["A", "B", "8-1-1", "C", "10.5", None, "E", "1/2/2020"]),
            ("r", 1, 7, ["A2", "B2", "8-1-2", "C", "11", "1", "E", "31/12/2019"]),
            ("r", 2, 5, h2), ("r", 2, 6, ["02/02/2020", "E", "2", "12", "C", "8-1-3", "B3", "A3"]),
            ("r", 2, 7, ["03/02/2020", "E", None, "13", "C", "8-1-4", None, "A4"])]
    sr = spark.createDataFrame(rows, "report_id string, sheet_no int, row_no int, cells array<string>")
    meta = spark.createDataFrame([("r", "INST", "E", 'attachment; filename="rep1.xlsx"', V1)],
                                 "report_id string, institucion string, estado string, "
                                 "content_disposition string, data_version timestamp_ntz")
    got = sorted(reports.clean_reports(sr, meta).collect(), key=lambda r: r.cedula)
    assert [r.cedula for r in got] == ["8-1-1", "8-1-2", "8-1-3", "8-1-4"]
    assert got[0].salario == 10.5 and got[0].gasto is None and got[0].fecha_de_inicio == dt.date(2020, 2, 1)
    assert got[2].nombre == "A3" and got[2].salario == 12.0 and got[3].apellido is None
    assert {r.fecha_actualizacion for r in got} == {dt.datetime(2024, 3, 5, 14, 30)}
    assert {(r.archivo, r.institucion, r.fecha_consulta) for r in got} == {("rep1", "INST", V1)}


def test_s11_fixture_loader(spark, tmp_dir):
    p = f"{tmp_dir}/a.json"
    open(p, "w").write(json.dumps([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]))
    assert sorted(r.a for r in load_fixture(spark, p).collect()) == [1, 2]
    c = f"{tmp_dir}/a.csv"
    open(c, "w").write("a,b\n1,x\n")
    assert load_fixture(spark, c).collect()[0].asDict() == {"a": "1", "b": "x"}
    with pytest.raises(ValueError):
        load_fixture(spark, f"{tmp_dir}/a.txt")


def test_trend_projects_days(spark):
    daily = spark.createDataFrame([(dt.datetime(2024, 1, d), float(d)) for d in (1, 2, 3)],
                                  "day timestamp_ntz, avg_time double")
    got = monitor.trend(daily, 2).orderBy("day").collect()
    assert [r.trend_time for r in got] == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert [r.is_forecast for r in got] == [False, False, False, True, True]


def test_s5_s6_audit_table_not_null_and_default(spark, tmp_dir):
    from quincena.sources.audit_table import append_audit, create_audit_table
    name = "audit_t_" + tmp_dir.rsplit("-", 1)[-1].replace("_", "")
    create_audit_table(spark, name, f"{tmp_dir}/audit", ntz=True)
    create_audit_table(spark, name, f"{tmp_dir}/audit", ntz=True)      # IF NOT EXISTS
    rows = spark.createDataFrame([("I", "S", "OK", V1, V0, V0, V1)],
                                 "institution_name_spanish string, status_name_spanish string, run_status string, "
                                 "source_update timestamp_ntz, checked_at timestamp_ntz, start_at timestamp_ntz, "
                                 "end_at timestamp_ntz")
    append_audit(spark, name, audit.audit_rows(rows, F.col("checked_at")))
    got = spark.table(name).collect()
    assert len(got) == 1 and got[0].time == float((V1 - V0).total_seconds())
    bad = rows.withColumn("run_status", F.lit(None).cast("string"))
    with pytest.raises(ValueError):
        append_audit(spark, name, audit.audit_rows(bad, F.col("checked_at")))
    spark.sql(f"INSERT INTO {name} (institution_name_spanish, status_name_spanish, run_status, source_update, "
              f"start_at, end_at, time) VALUES ('I', 'T', 'FAIL', TIMESTAMP_NTZ '2024-02-01 00:00:00', "
              f"TIMESTAMP_NTZ '2024-02-01 00:00:00', TIMESTAMP_NTZ '2024-02-01 00:00:00', 0.5)")
    assert spark.table(name).where("status_name_spanish = 'T'").first().checked_at is not None


def test_t17_duplicate_options_give_one_request_per_pair(spark):
    inst = spark.createDataFrame([("A",), ("A",), ("B",)], "institution_name_spanish string")
    stat = spark.createDataFrame([("E",), ("E",)], "status_name_spanish string")
    got = sorted(tuple(r) for r in audit.request_plan(inst, stat).collect())
    assert got == [("A", "E"), ("B", "E")]


def test_reports_that_cannot_be_read_whole_are_failures(spark):
    banner = [None, None, None, None, "Fecha de actualización: 05/03/2024 02:30:00 PM"]
    head = ["Nombre", "Apellido", "Cedula", "Cargo", "Salario", "Gasto", "Estado", "Fecha de Inicio"]

    def report(name, top=banner, header=head, money="1.5", date="1/2/2020"):
        out = [(name, 1, 6, ["A", "B", name, "C", money, " ", "E", date])]
        return out + [(name, 1, 3, top)] * (top is not None) + [(name, 1, 5, header)] * (header is not None)

    rows = (report("good") + report("header", header=None) + report("banner", top=None) + report("text", top=["x"])
            + report("money", money="1,200.50") + report("date", date="31/13/2020") + report("orphan")
            + report("column", header=head[:5] + ["Otro"] + head[6:]))
    sr = spark.createDataFrame(rows, "report_id string, sheet_no int, row_no int, cells array<string>")
    meta = spark.createDataFrame([(n, "I", "E", None, V1) for n in
                                  ("good", "header", "banner", "text", "money", "date", "column", "none")],
                                 "report_id string, institucion string, estado string, content_disposition string, "
                                 "data_version timestamp_ntz")
    landed, failures = reports.read_reports(sr, meta)
    assert [(r.cedula, r.salario, r.gasto) for r in landed.collect()] == [("good", 1.5, None)]
    assert dict(map(tuple, failures.collect())) == {
        "header": "no header", "banner": "no banner date", "text": "no banner date", "money": "unreadable money",
        "date": "unreadable date", "orphan": "no metadata", "none": "no sheet", "column": "no column gasto"}


def test_options_are_the_text_a_reader_sees(spark):
    html = ("<SELECT name='x' ID=ddl ><Option>&#205;NDICE <b>A</b> &amp; B</Option><option>&#xD800; &#x20ac;</option>"
            "<option>&nbsp;</option><option><!-- no --></option></SELECT>")
    df = spark.createDataFrame([(1, "u", html), (2, "u", None)], "page_id long, url string, html string")
    got = [(r.page_id, r.option) for r in pages.page_options(df, pages.select_block("ddl")).orderBy("option_no").collect()]
    assert got == [(1, "ÍNDICE A & B"), (1, "&#xD800; €")]
    other = df.withColumn("html", F.lit("<select data-id='ddl'><option>X</option></select>"))
    assert pages.page_options(other, pages.select_block("ddl")).count() == 0


def test_poll_run_feeds_the_gate(spark):
    names = "institution_name_spanish string, status_name_spanish string"
    plan = spark.createDataFrame([("I", "A"), ("I", "B"), ("I", "C")], names)
    log = spark.createDataFrame([("I", "A", "OK", V1)], names + ", run_status string, source_update timestamp_ntz")
    times = spark.createDataFrame([("I", "B", V0, V1), ("I", "C", V0, None)],
                                  names + ", start_at timestamp_ntz, end_at timestamp_ntz")
    ended = spark.createDataFrame([("I", "B", "OK"), ("I", "C", "FAIL")], names + ", run_status string")
    run = audit.poll_run(plan, log, V1, ended, times, V1)
    got = {r.status_name_spanish: (r.run_status, r.start_at, r.end_at) for r in run.collect()}
    assert got == {"A": ("No Update", V1, V1), "B": ("OK", V0, V1), "C": ("FAIL", V0, V1)}
    assert audit.updates_gate(run).first().updates == 1


SHEETS = "report_id string, sheet_no int, row_no int, cells array<string>"
META = "report_id string, institucion string, estado string, content_disposition string, data_version timestamp_ntz"
HEADER = ["Nombre", "Apellido", "Cedula", "Cargo", "Salario", "Gasto", "Estado", "Fecha de Inicio"]


def sheet(rid, n=2, banner="05/03/2024 02:30:00 PM"):
    return [(rid, 1, 3, [None] * 4 + [f"Fecha de actualización: {banner}"]), (rid, 1, 5, HEADER)] + [
        (rid, 1, 6 + k, [f"N{k}", "B", f"8-{k}", "C", "10", None, "E", "1/2/2020"]) for k in range(n)]


def meta_row(rid, inst="I", version=V1):
    return (rid, inst, "E", 'attachment; filename="rep.xlsx"', version)


def test_reports_delivered_twice_count_once(spark):
    rows = sheet("a") * 2 + sheet("b") + sheet("b")[1:2]
    metas = [meta_row("a"), meta_row("a"), meta_row("b")]
    landed, failed = reports.read_reports(spark.createDataFrame(rows, SHEETS), spark.createDataFrame(metas, META))
    assert failed.collect() == [] and landed.count() == 4


def test_contradictions_and_missing_ids_land_nothing(spark):
    rows = (sheet("two metas") + sheet("two banners") + sheet("two banners", banner="06/03/2024 02:30:00 PM")[:1]
            + sheet("two headers") + [("two headers", 1, 5, HEADER[::-1])]
            + sheet("torn") + [("torn", 1, 6, ["other"] + [None] * 7)] + sheet(None) + sheet("fine") + sheet("no meta"))
    metas = [meta_row("two metas", "I"), meta_row("two metas", "J"), *(meta_row(r) for r in ("two banners", "two headers", "torn",
                                                                                            "fine", "no rows", None))]
    landed, failed = reports.read_reports(spark.createDataFrame(rows, SHEETS), spark.createDataFrame(metas, META))
    assert {r.report_id: r.reason for r in failed.collect()} == {
        "two metas": "contradictory metadata", "two banners": "contradictory rows", "two headers": "contradictory rows",
        "torn": "contradictory rows", None: "no report id", "no meta": "no metadata", "no rows": "no sheet"}
    assert landed.count() == 2 and {r.nombre for r in landed.collect()} == {"N0", "N1"}


def test_results_come_from_reports(spark):
    metas = [meta_row("a"), meta_row("b"), meta_row("c", "J"), meta_row(None, "K")]
    failed = spark.createDataFrame([("b", "no header"), ("c", "no sheet"), (None, "no report id")], "report_id string, reason string")
    got = {r.institution_name_spanish: r.run_status
           for r in reports.results(spark.createDataFrame(metas, META), failed).collect()}
    assert got == {"I": "OK", "J": "FAIL"}


def test_landing_files_have_their_names_and_failed_tasks_leave_none(spark, tmp_dir):
    import os

    from quincena.session import ship_package
    from quincena.sources.landing import land_files
    ship_package(spark)
    rows = spark.range(5000).select(F.col("id"), F.concat(F.lit("f"), (F.col("id") % 3).cast("string"), F.lit(".parquet"))
                                    .alias("landing_file"))
    path = f"{tmp_dir}/landing"
    for _ in range(2):  # a replay replaces the files
        land_files(rows, path)
    assert sorted(f for f in os.listdir(path) if f[0] != "_") == ["f0.parquet", "f1.parquet", "f2.parquet"]
    back = spark.read.parquet(path)
    assert back.count() == 5000 and back.columns == ["id"]
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    assert {(r.id % 3, r.f) for r in back.select("id", name.alias("f")).collect()} == {(n, f"f{n}.parquet") for n in range(3)}

    broken = rows.withColumn("id", F.when(F.col("id") < 4000, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long"))) \
        .withColumn("landing_file", F.concat(F.lit("new_"), "landing_file"))
    with pytest.raises(Exception):
        land_files(broken, path)
    assert sorted(f for f in os.listdir(path) if f[0] != "_") == ["f0.parquet", "f1.parquet", "f2.parquet"]
    assert not os.path.exists(f"{path}/_staging") or os.listdir(f"{path}/_staging") == []


def test_audit_rows_are_appended_exactly_once(spark, tmp_dir):
    from quincena.sources.audit_table import append_audit, create_audit_table
    name = "audit_once_" + tmp_dir.rsplit("-", 1)[-1].replace("_", "")
    create_audit_table(spark, name, f"{tmp_dir}/audit", ntz=True)
    kind = ("institution_name_spanish string, status_name_spanish string, run_status string, source_update timestamp_ntz, "
            "checked_at timestamp_ntz, start_at timestamp_ntz, end_at timestamp_ntz, time float")
    run = [("I", s, "OK", V1, V1, V1, V1, 0.0) for s in "ABC"]
    later = [("I", "A", "FAIL", V1, dt.datetime(2024, 3, 1), V1, V1, 0.0), ("I", "Z", "OK", V1, None, V1, V1, 0.0)]
    assert append_audit(spark, name, spark.createDataFrame(run[:2] * 2, kind)) == 2
    assert append_audit(spark, name, spark.createDataFrame(run, kind)) == 1      # the run again, and the row it had lost
    assert append_audit(spark, name, spark.createDataFrame(later, kind)) == 2
    assert append_audit(spark, name, spark.createDataFrame(run, kind)) == 0
    assert spark.table(name).count() == 5


def test_seasonal_forecast_equals_a_plain_fold(spark):
    import math
    rng = __import__("random").Random(6)
    first = dt.date(2024, 1, 3)
    seen = {k: 10 + 0.1 * k + (5 if k % 7 == 2 else 0) + rng.random() for k in range(60) if k not in (4, 5, 31)}
    rows = [(dt.datetime.combine(first + dt.timedelta(days=k), dt.time()), y) for k, y in seen.items()]
    daily = spark.createDataFrame([*rows, (None, 3.0)], "day timestamp_ntz, avg_time double")
    got = {r.day.date(): r for r in monitor.seasonal_forecast(daily, 10).collect()}
    level, slope, parts, squares, fits = seen[0], 0.0, [0.0] * 7, 0.0, {}
    for k in range(70):
        at = ((first - dt.date(1970, 1, 1)).days + k) % 7
        fits[k] = level + slope + parts[at]
        if k in seen:
            squares += (seen[k] - fits[k]) ** 2
            new = 0.3 * (seen[k] - parts[at]) + 0.7 * (level + slope)
            slope, level = 0.05 * (new - level) + 0.95 * slope, new
            parts[at] = 0.2 * (seen[k] - level) + 0.8 * parts[at]
        else:
            level += slope
    sd = math.sqrt(squares / len(seen))
    assert len(got) == 70
    for k in range(70):
        r, width = got[first + dt.timedelta(days=k)], 1.96 * sd * math.sqrt(max(1, k - 59))
        assert abs(r.fitted - fits[k]) < 2e-6 and abs(r.low - fits[k] + width) < 2e-6 and abs(r.high - fits[k] - width) < 2e-6
        assert r.is_forecast == (k > 59) and (r.avg_time is None) == (k not in seen)
    assert monitor.seasonal_forecast(daily.limit(0)).collect() == []
