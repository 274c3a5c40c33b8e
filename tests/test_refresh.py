import datetime as dt

from conftest import SF0001
from quincena.operators import gold
from quincena.plans import catalog as C
from quincena.plans.refresh import Layout, Manifest, full_refresh, refresh, served_views
from quincena.sources.tables import append_rows


def test_refresh_gate_skips_without_updates(spark, tmp_dir):
    runs = spark.createDataFrame([("I", "S", "No Update"), ("I", "T", "FAIL")],
                                 "institution_name_spanish string, status_name_spanish string, run_status string")
    out = refresh(spark, Layout(tmp_dir), spark.createDataFrame([], "spanish string, english string"), run_audit=runs)
    assert out == {"updates": 0, "refreshed": False}


def test_refresh_equals_batch_and_invariants(spark, tmp_dir):
    i = C.Inputs(spark, SF0001)
    layout = Layout(tmp_dir)
    append_rows(i.payroll, layout.landing)
    append_rows(i.audit, layout.audit)
    out = refresh(spark, layout, i.translations, landing_schema=i.payroll.schema, audit_table_schema=i.audit.schema,
                  tie_break=C.SCD2_TIE_BREAK, detected_at=dt.datetime(2024, 1, 1))
    snap = spark.read.parquet(out["snapshot"])
    batch = i.snapshot()
    norm = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert norm(snap) == norm(batch) and snap.count() == 29
    # snapshot rows are bronze rows; headcounts add up
    assert snap.join(i.bronze.selectExpr("composite_key", "fecha_consulta AS snapshot_date"),
                     ["composite_key", "snapshot_date"], "left_anti").count() == 0
    gp = spark.read.parquet(out["gold_position"])
    assert gp.agg({"employee_count": "sum"}).first()[0] == 29
    ge = spark.read.parquet(out["gold_employee"])
    assert ge.count() == 27 and gold.employee_positions(ge).count() == 29
    assert spark.read.parquet(out["inactive_employees"]).count() == 697
    # a second refresh with nothing new changes nothing
    out2 = refresh(spark, layout, i.translations, landing_schema=i.payroll.schema,
                   audit_table_schema=i.audit.schema, tie_break=C.SCD2_TIE_BREAK, detected_at=dt.datetime(2024, 1, 1))
    assert norm(spark.read.parquet(out2["snapshot"])) == norm(batch)


def test_snapshot_scan_prunes_bronze_versions(spark, tmp_dir):
    """Bronze is partitioned by data version; the snapshot's version bound
    reaches the scan as a partition filter."""
    i = C.Inputs(spark, SF0001)
    layout = Layout(tmp_dir)
    append_rows(i.payroll, layout.landing)
    from quincena.streaming import incremental as inc
    from quincena.operators import snapshot
    bschema = inc.ingest_bronze(spark, layout.landing, i.payroll.schema, layout.bronze, layout.ckpt("b"))
    b = inc.read_bronze(spark, layout.bronze, bschema)
    s = snapshot.latest_snapshot(b, i.dim_institution(), i.dim_status(), i.dim_position())
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        s.explain()
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(fecha_consulta" in plan and "Subquery" in plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        s.explain("formatted")
    partition_filters = [line for line in buf.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert any("array_contains" in line and "fecha_consulta" in line for line in partition_filters)
    assert s.count() == 29


def test_refresh_without_a_successful_poll(spark, tmp_dir):
    """Only FAIL polls: the dimensions are empty and so are the views."""
    i = C.Inputs(spark, SF0001)
    layout = Layout(tmp_dir)
    append_rows(i.payroll.limit(50), layout.landing)
    append_rows(i.audit.where("run_status = 'FAIL'"), layout.audit)
    out = refresh(spark, layout, i.translations, landing_schema=i.payroll.schema, audit_table_schema=i.audit.schema,
                  tie_break=C.SCD2_TIE_BREAK, detected_at=dt.datetime(2024, 1, 1))
    assert spark.read.parquet(out["snapshot"]).count() == 0
    assert spark.read.parquet(out["inactive_employees"]).count() > 0


def norm(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def _deployment(spark, tmp_dir):
    i = C.Inputs(spark, SF0001)
    layout = Layout(tmp_dir)
    options = {"landing_schema": i.payroll.schema, "audit_table_schema": i.audit.schema, "tie_break": C.SCD2_TIE_BREAK,
               "detected_at": dt.datetime(2024, 1, 1)}
    append_rows(i.payroll.where("row_id % 2 = 0"), layout.landing)
    append_rows(i.audit, layout.audit)
    refresh(spark, layout, i.translations, **options)
    return i, layout, options


def test_a_refresh_that_fails_midway_leaves_the_old_views(spark, tmp_dir, monkeypatch):
    import pytest

    from quincena.plans import refresh as module
    i, layout, options = _deployment(spark, tmp_dir)
    before = {v: norm(df) for v, df in served_views(spark, layout).items()}
    assert set(before) == set(module.VIEWS)
    append_rows(i.payroll.where("row_id % 2 = 1"), layout.landing)
    real = module.write_view

    def failing(df, path, **k):
        if path.endswith("gold_employee"):
            raise RuntimeError("lost")
        real(df, path, **k)

    monkeypatch.setattr(module, "write_view", failing)
    with pytest.raises(RuntimeError):
        refresh(spark, layout, i.translations, **options)
    assert {v: norm(df) for v, df in served_views(spark, layout).items()} == before
    monkeypatch.setattr(module, "write_view", real)
    refresh(spark, layout, i.translations, **options)
    after = served_views(spark, layout)
    assert norm(after["snapshot"]) == norm(i.snapshot()) and norm(after["snapshot"]) != before["snapshot"]


def test_full_refresh_equals_the_incremental_state_and_goes_on(spark, tmp_dir, monkeypatch):
    import pytest

    from quincena.plans import refresh as module
    i, layout, options = _deployment(spark, tmp_dir)
    before = {v: norm(df) for v, df in served_views(spark, layout).items()}
    real = module.gold.position_summary
    monkeypatch.setattr(module.gold, "position_summary", lambda s: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        full_refresh(spark, layout, i.translations, **options)
    monkeypatch.setattr(module.gold, "position_summary", real)
    assert Manifest(spark, layout).served()[0] == 0
    full_refresh(spark, layout, i.translations, **options)
    generation, paths = Manifest(spark, layout).served()
    assert generation == 2 and all("/g=2/" in p for p in paths.values())  # 1 is the one that failed
    assert {v: norm(df) for v, df in served_views(spark, layout).items()} == before
    append_rows(i.payroll.where("row_id % 2 = 1"), layout.landing)
    refresh(spark, layout, i.translations, **options)
    assert Manifest(spark, layout).served()[0] == 2
    assert norm(served_views(spark, layout)["snapshot"]) == norm(i.snapshot())


def test_a_poll_run_again_lands_and_logs_nothing_twice(spark, tmp_dir):
    from pyspark.sql import functions as F

    from quincena.plans.poll import poll
    from quincena.session import ship_package
    from quincena.sources import testviews as tv
    ship_package(spark)
    i = C.Inputs(spark, SF0001)
    layout = Layout(tmp_dir)
    v = i.payroll.agg(F.max("fecha_consulta")).first()[0]
    new = i.payroll.where(F.col("fecha_consulta") == v)
    append_rows(i.payroll.where(F.col("fecha_consulta") < v), layout.landing)
    append_rows(i.audit.where(F.col("source_update") < v), layout.audit)
    options = {"landing_schema": i.payroll.schema, "audit_table_schema": i.audit.schema, "tie_break": C.SCD2_TIE_BREAK}
    seen = []
    for _ in range(2):
        out = poll(spark, layout, tv.index_page(i.payroll), tv.damaged_sheets(tv.report_sheets(new)), tv.report_meta(new),
                   i.translations, dt.datetime(2024, 1, 1), **options)
        seen.append((spark.read.schema(i.payroll.schema).parquet(layout.landing).count(),
                     spark.read.parquet(layout.audit).count(), norm(spark.read.parquet(out["gold_position"]))))
    assert seen[0] == seen[1]
    assert seen[0][0] == i.payroll.where((F.col("fecha_consulta") < v) | (F.dayofmonth("fecha_actualizacion") % 7 >= 5)).count()
