import datetime as dt
import os

from pyspark.sql import functions as F

from quincena.operators import cdc, dims
from quincena.streaming import incremental as inc
from quincena.streaming import sinks
from quincena.streaming.store import AppendedTable, VersionedTable
from quincena.sources.tables import append_rows

SCHEMA = ("cedula string, nombre string, apellido string, institucion string, cargo string, estado string, "
          "fecha_consulta timestamp_ntz, salario double, gasto double, fecha_de_inicio date, "
          "fecha_actualizacion timestamp_ntz, row_id long")
T = [dt.datetime(2024, m, 1) for m in range(1, 7)]


def ev(ced, t, sal, rid, cargo="C"):
    return (ced, "N", None, "I", cargo, "E", T[t], sal, None, dt.date(2020, 1, 1), T[t], rid)


def test_scd2_stream_equals_batch_under_late_data(spark, tmp_dir):
    arrivals = [[ev("1", 0, 1.0, 1), ev("2", 0, 5.0, 2)], [ev("1", 2, 1.0, 3)], [ev("1", 1, 2.0, 4)], []]
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    all_rows = []
    for rows in arrivals:
        if rows:
            append_rows(spark.createDataFrame(rows, SCHEMA), landing)
            all_rows += rows
        inc.update_history(spark, landing, spark.createDataFrame([], SCHEMA).schema, ev_root, h_root, ck,
                           ["fecha_actualizacion", "row_id"])
    got = inc.read_history(spark, h_root, spark.createDataFrame([], SCHEMA).schema,
                           ["fecha_actualizacion", "row_id"])
    keys = ["cedula", "nombre", "apellido", "institucion", "cargo", "estado"]
    want = cdc.scd2_history(spark.createDataFrame(all_rows, SCHEMA), keys, "fecha_consulta",
                            ["salario", "gasto", "fecha_de_inicio"], ["fecha_actualizacion", "row_id"])
    norm = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert norm(got) == norm(want)
    assert len(norm(got)) == 4


def test_bronze_versions_do_not_depend_on_the_session_zone(spark, tmp_dir):
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    landing, bronze, ck = (f"{tmp_dir}/{n}" for n in ("land", "bronze", "ck"))
    schema = spark.createDataFrame([], SCHEMA.replace("fecha_consulta timestamp_ntz", "fecha_consulta timestamp")).schema
    try:
        for i, writer in enumerate(("America/Panama", "Asia/Kolkata")):
            spark.conf.set(zone, writer)
            rows = spark.range(1).selectExpr("CAST(id AS STRING) AS cedula", f"timestamp_seconds(1704067200 + {i}) AS at")
            columns = [F.col("at" if f.name == "fecha_consulta" else "cedula" if f.name == "cedula" else "missing")
                       .cast(f.dataType).alias(f.name) for f in schema]
            append_rows(rows.withColumn("missing", F.lit(None).cast("string")).select(*columns), landing)
            made = inc.ingest_bronze(spark, landing, schema, bronze, ck)
        for reader in ("UTC", "America/Panama"):
            spark.conf.set(zone, reader)
            got = inc.read_bronze(spark, bronze, made).select(F.unix_timestamp("fecha_consulta").alias("s"))
            assert sorted(r.s for r in got.collect()) == [1704067200, 1704067201]
    finally:
        spark.conf.set(zone, before)


def test_t13_novelty_keeps_first_batch_date(spark, tmp_dir):
    landing, target, ck = f"{tmp_dir}/land", f"{tmp_dir}/dim", f"{tmp_dir}/ck"
    d = spark.createDataFrame([("C", "Pos C")], "spanish string, english string")
    schema = spark.createDataFrame([], SCHEMA).schema
    append_rows(spark.createDataFrame([ev("1", 3, 1.0, 1)], SCHEMA), landing)
    inc.update_positions(spark, landing, schema, target, ck)
    append_rows(spark.createDataFrame([ev("2", 1, 1.0, 2), ev("3", 1, 1.0, 3, cargo="D")], SCHEMA), landing)
    inc.update_positions(spark, landing, schema, target, ck)
    inc.update_positions(spark, landing, schema, target, ck)      # nothing new: no batch
    got = sorted(tuple(r) for r in inc.read_positions(spark, target, schema, d).collect())
    assert got == [("C", T[3], "Pos C"), ("D", T[1], None)]


def test_versioned_table_replay_rewrites_same_version(spark, tmp_dir):
    vt = VersionedTable(spark, f"{tmp_dir}/vt")
    assert vt.read() is None
    vt.commit(spark.createDataFrame([(1,)], "a int"), 0)
    vt.commit(spark.createDataFrame([(2,)], "a int"), 1)
    vt.commit(spark.createDataFrame([(3,)], "a int"), 1)
    assert [r.a for r in vt.read().collect()] == [3]
    assert [r.a for r in vt.read(before=1).collect()] == [1]


def test_dimension_stream_complete_mode(spark, tmp_dir):
    schema = ("institution_name_spanish string, status_name_spanish string, run_status string, "
              "source_update timestamp_ntz, checked_at timestamp_ntz")
    landing, target, ck = f"{tmp_dir}/land", f"{tmp_dir}/dim", f"{tmp_dir}/ck"
    d = spark.createDataFrame([("E", "Status E")], "spanish string, english string")
    first = [("I", "E", "OK", T[1], T[1]), ("I", "F", "FAIL", T[2], T[2])]
    st = spark.createDataFrame(first, schema).schema
    append_rows(spark.createDataFrame(first, schema), landing)
    inc.update_name_dimension(spark, landing, st, "status_name_spanish", "status_name_english", d, target, ck)
    append_rows(spark.createDataFrame([("J", "E", "OK", T[0], T[3])], schema), landing)
    inc.update_name_dimension(spark, landing, st, "status_name_spanish", "status_name_english", d, target, ck)
    got = sorted(tuple(r) for r in VersionedTable(spark, target).read().collect())
    batch = dims.dim_status(spark.createDataFrame(first + [("J", "E", "OK", T[0], T[3])], schema), d)
    assert got == sorted(tuple(r) for r in batch.select(*VersionedTable(spark, target).read().columns).collect())
    assert got == [("E", T[1], T[3], "Status E")]


def test_s2_schema_enforcement_case_and_missing(spark, tmp_dir):
    """Declared landing schema: ``Institucion`` matches ``institucion``
    case-insensitively, a missing column reads as NULL, extra columns drop."""
    from quincena.schemas import payroll_schema
    from pyspark.sql import types as TT
    landing, out, ck = f"{tmp_dir}/land", f"{tmp_dir}/bronze", f"{tmp_dir}/ck"
    df = spark.createDataFrame(
        [("A", "B", "8-1-2", "C", 1000.0, "E", dt.date(2020, 1, 1), T[2], T[1], "f", "INST", 7)],
        "nombre string, apellido string, cedula string, cargo string, salario double, estado string, "
        "fecha_de_inicio date, fecha_actualizacion timestamp_ntz, fecha_consulta timestamp_ntz, archivo string, "
        "Institucion string, extra int")
    append_rows(df, landing)
    inc.ingest_bronze(spark, landing, payroll_schema(TT.TimestampNTZType()), out, ck)
    bschema = inc.ingest_bronze(spark, landing, payroll_schema(TT.TimestampNTZType()), out, ck)   # no new file
    got = inc.read_bronze(spark, out, bschema).collect()
    assert len(got) == 1
    r = got[0]
    assert r.institucion == "INST" and r.gasto is None and "extra" not in r.asDict()
    assert r.composite_key == "A-B-INST-C-812" and r.antiguedad == 50 / 12 and r.fecha_consulta == T[1]


def test_failed_batch_is_replayed_idempotently(spark, tmp_dir):
    """A batch that dies after writing part of its state is replayed with the
    same batch id on the next run and overwrites its own version folders."""
    import pytest
    from quincena.streaming.runner import run_available
    from quincena.streaming.sources import landing_stream
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    keys = ["cedula", "nombre", "apellido", "institucion", "cargo", "estado"]
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = [ev("1", 0, 1.0, 1), ev("1", 1, 2.0, 2), ev("2", 0, 3.0, 3)]
    append_rows(spark.createDataFrame(rows, SCHEMA), landing)
    from quincena.streaming.store import PartitionedVersions
    real = inc.history_sink(spark, ev_root, h_root, ["fecha_actualizacion", "row_id"])
    calls = []

    def failing(batch, batch_id):
        calls.append(batch_id)
        real(batch, batch_id)
        raise RuntimeError("lost after writing")

    with pytest.raises(Exception):
        run_available(landing_stream(spark, landing, schema), ck, foreach_batch=failing)
    run_available(landing_stream(spark, landing, schema), ck, foreach_batch=real)
    got = inc.read_history(spark, h_root, schema, ["fecha_actualizacion", "row_id"])
    want = cdc.scd2_history(spark.createDataFrame(rows, SCHEMA), keys, "fecha_consulta",
                            ["salario", "gasto", "fecha_de_inicio"], ["fecha_actualizacion", "row_id"])
    norm = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert calls == [0] and norm(got) == norm(want)
    ev_schema = cdc.dedupe_events(spark.createDataFrame([], SCHEMA), keys, "fecha_consulta",
                                  ["fecha_actualizacion", "row_id"]).schema
    assert PartitionedVersions(spark, ev_root, "institucion").read_all(ev_schema).count() == 3


def test_partitioned_versions_touch_only_written_partitions(spark, tmp_dir):
    from quincena.streaming.store import PartitionedVersions
    pv = PartitionedVersions(spark, f"{tmp_dir}/pv", "p")
    schema = spark.createDataFrame([], "a int, p string").schema
    assert pv.read(schema) is None
    pv.commit(spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "a int, p string"), 0)
    pv.commit(spark.createDataFrame([(4, "x")], "a int, p string"), 1)          # only partition x changes
    got = sorted((r.a, r.p) for r in pv.read(schema).collect() if r.p is not None)
    assert got == [(2, "y"), (4, "x")]
    assert [r.a for r in pv.read(schema).where("p IS NULL").collect()] == [3]
    assert sorted(r.a for r in pv.read(schema, before=1).collect()) == [1, 2, 3]
    only_x = pv.read(schema, parts=["x"])
    assert [r.a for r in only_x.collect()] == [4]
    as_frame = pv.read(schema, parts=spark.createDataFrame([("x",), (None,)], "p string"))
    assert sorted(r.a for r in as_frame.collect()) == [3, 4]
    assert sorted(r.a for r in pv.read(schema, parts=[None, "y"]).collect()) == [2, 3]
    assert sorted(r.a for r in pv.read_all(schema).collect()) == [1, 2, 3, 4]


def test_scd2_sink_rewrites_only_touched_institutions(spark, tmp_dir):
    import os
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    schema = spark.createDataFrame([], SCHEMA).schema
    tb = ["fecha_actualizacion", "row_id"]
    first = [ev("1", 0, 1.0, 1), ("2", "N", None, "J", "C", "E", T[0], 5.0, None, dt.date(2020, 1, 1), T[0], 2)]
    append_rows(spark.createDataFrame(first, SCHEMA), landing)
    inc.update_history(spark, landing, schema, ev_root, h_root, ck, tb)
    late = [("2", "N", None, "J", "C", "E", T[1], 6.0, None, dt.date(2020, 1, 1), T[1], 3)]
    append_rows(spark.createDataFrame(late, SCHEMA), landing)
    inc.update_history(spark, landing, schema, ev_root, h_root, ck, tb)
    versions = sorted(d for d in os.listdir(h_root) if d.startswith("v="))
    assert versions == ["v=0", "v=1"]
    assert sorted(d for d in os.listdir(f"{h_root}/v=1") if d.startswith("institucion=")) == ["institucion=J"]
    got = inc.read_history(spark, h_root, schema, tb)
    assert sorted((r.institucion, r.salario) for r in got.collect()) == [("I", 1.0), ("J", 5.0), ("J", 6.0)]


INSTITUTIONS = ["", None, "A/B", "50%", "blank ", "007", "{x}"]


def test_scd2_stream_keeps_odd_institutions(spark, tmp_dir):
    """'' and NULL share a partition folder; separators and padding are escaped
    in folder names: every institution comes back as it was."""
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    schema = spark.createDataFrame([], SCHEMA).schema
    tb = ["fecha_actualizacion", "row_id"]
    rows = [(str(t), "N", None, inst, "C", "E", T[t], 1.0 + t, None, dt.date(2020, 1, 1), T[t], 10 * n + t)
            for t in range(2) for n, inst in enumerate(INSTITUTIONS)]
    for part in (rows[:len(INSTITUTIONS)], rows[len(INSTITUTIONS):]):
        append_rows(spark.createDataFrame(part, SCHEMA), landing)
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, tb)
    got = inc.read_history(spark, h_root, schema, tb)
    assert sorted((repr(r.institucion), r.cedula) for r in got.collect()) == \
        sorted((repr(i), c) for i in INSTITUTIONS for c in ("0", "1"))


def test_half_written_version_is_not_read(spark, tmp_dir):
    import os
    vt = VersionedTable(spark, f"{tmp_dir}/vt")
    vt.commit(spark.createDataFrame([(1,)], "a int"), 0)
    vt.commit(spark.createDataFrame([(2,)], "a int"), 1)
    os.remove(f"{tmp_dir}/vt/v=1/_SUCCESS")
    assert [r.a for r in vt.read().collect()] == [1]


def test_empty_newest_version_is_the_table(spark, tmp_dir):
    vt = VersionedTable(spark, f"{tmp_dir}/vt")
    empty = spark.createDataFrame([], "a int")
    assert vt.read(schema=empty.schema).collect() == []
    vt.commit(spark.createDataFrame([(1,)], "a int"), 0)
    vt.commit(empty, 1)
    assert vt.read().collect() == [] and vt.read().columns == ["a"]


def test_two_versions_are_kept(spark, tmp_dir):
    from quincena.streaming.store import PartitionedVersions
    vt, pv = VersionedTable(spark, f"{tmp_dir}/vt"), PartitionedVersions(spark, f"{tmp_dir}/pv", "p")
    one = spark.createDataFrame([(1, "x")], "a int, p string")
    pv.commit(spark.createDataFrame([(0, "x"), (0, "y")], "a int, p string"), 0, keep=2)
    for n in range(1, 5):
        vt.commit(one, n)
        pv.commit(one.withColumn("a", one.a + n), n, keep=2)
    assert vt.committed() == [3, 4]
    assert {v: pv.folders(v) for v in pv.committed()} == {0: ["p=y"], 3: ["p=x"], 4: ["p=x"]}
    assert sorted((r.a, r.p) for r in pv.read(one.schema).collect()) == [(0, "y"), (5, "x")]
    assert all(f"/v={n}/" not in f for f in pv.read(one.schema).inputFiles() for n in (1, 2, 3))


def test_new_checkpoint_continues_after_the_newest_version(spark, tmp_dir):
    schema = ("institution_name_spanish string, status_name_spanish string, run_status string, "
              "source_update timestamp_ntz, checked_at timestamp_ntz")
    landing, target = f"{tmp_dir}/land", f"{tmp_dir}/latest"
    st = spark.createDataFrame([], schema).schema
    for n, status in enumerate(["OK", "FAIL"]):
        append_rows(spark.createDataFrame([("I", "E", status, T[n], T[n])], schema), landing)
        inc.update_latest_poll(spark, landing, st, target, f"{tmp_dir}/ck1")
    append_rows(spark.createDataFrame([("I", "E", "OK", T[3], T[3])], schema), landing)
    inc.update_latest_poll(spark, landing, st, target, f"{tmp_dir}/ck2")
    got = VersionedTable(spark, target).read().collect()
    assert [(r.run_status, r.checked_at) for r in got] == [("OK", T[3])]
    assert VersionedTable(spark, target).committed() == [1, 2]


def test_late_translation_shows(spark, tmp_dir):
    landing, target, ck = f"{tmp_dir}/land", f"{tmp_dir}/pos", f"{tmp_dir}/ck"
    schema = spark.createDataFrame([], SCHEMA).schema
    names = "spanish string, english string"
    append_rows(spark.createDataFrame([ev("1", 0, 1.0, 1)], SCHEMA), landing)
    inc.update_positions(spark, landing, schema, target, ck)
    assert [tuple(r) for r in inc.read_positions(spark, target, schema, spark.createDataFrame([], names)).collect()] == [
        ("C", T[0], None)]
    append_rows(spark.createDataFrame([ev("2", 1, 1.0, 2)], SCHEMA), landing)
    inc.update_positions(spark, landing, schema, target, ck)
    d = spark.createDataFrame([("C", "Pos C")], names)
    assert [tuple(r) for r in inc.read_positions(spark, target, schema, d).collect()] == [("C", T[0], "Pos C")]


def test_novelty_writes_only_what_is_new(spark, tmp_dir):
    landing, target, ck = f"{tmp_dir}/land", f"{tmp_dir}/pos", f"{tmp_dir}/ck"
    schema = spark.createDataFrame([], SCHEMA).schema
    for n in range(4):  # each arrival brings one new position and all the old ones
        append_rows(spark.createDataFrame([ev(str(k), n, 1.0, k, cargo=f"P{k}") for k in range(n + 1)], SCHEMA), landing)
        inc.update_positions(spark, landing, schema, target, ck)
    store = AppendedTable(spark, target)
    assert [[r.position_name_spanish for r in spark.read.parquet(f"{target}/v={v}").collect()]
            for v in store.committed()] == [["P0"], ["P1"], ["P2"], ["P3"]]
    # A batch that runs again meets the versions before it and overwrites its own.
    sinks.novelty_sink(store)(spark.createDataFrame([ev("9", 0, 1.0, 9, cargo="P0"), ev("9", 0, 1.0, 9, cargo="P9")], SCHEMA), 4)
    sinks.novelty_sink(store)(spark.createDataFrame([ev("9", 2, 1.0, 9, cargo="P9")], SCHEMA), 4)
    rows = {tuple(r) for r in store.read().collect()}
    assert rows == {("P0", T[0]), ("P1", T[1]), ("P2", T[2]), ("P3", T[3]), ("P9", T[2])}


def test_name_state_in_few_stores(spark, tmp_dir):
    landing, target, ck = f"{tmp_dir}/land", f"{tmp_dir}/dim", f"{tmp_dir}/ck"
    schema = "status_name_spanish string, run_status string, source_update timestamp_ntz, checked_at timestamp_ntz"
    d = spark.createDataFrame([("B", "Be")], "spanish string, english string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n, name in enumerate(["A B", "B"]):
        append_rows(spark.createDataFrame([(name, "OK", T[n], T[n])], schema), landing)
        inc.update_name_dimension(spark, landing, spark.createDataFrame([], schema).schema, "status_name_spanish",
                                  "status_name_english", d, target, ck, state_partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert sorted(n for n in os.listdir(f"{ck}/state/0") if n.isdigit()) == ["0", "1"]
    got = {(r.status_name_spanish, r.status_name_english) for r in VersionedTable(spark, target).read().collect()}
    assert got == {("A B", None), ("B", "Be")}


TB = ["fecha_actualizacion", "row_id"]
KEYS = ["cedula", "nombre", "apellido", "institucion", "cargo", "estado"]


def norm(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def batch_history(spark, rows):
    return norm(cdc.scd2_history(spark.createDataFrame(rows, SCHEMA), KEYS, "fecha_consulta",
                                 ["salario", "gasto", "fecha_de_inicio"], TB))


def at(ced, t, sal, rid, inst):
    return (ced, "N", None, inst, "C", "E", T[t] if t is not None else None, sal, None, dt.date(2020, 1, 1), T[0], rid)


def test_scd2_batch_in_order_opens_no_old_event_file(spark, tmp_dir):
    """Old files of the event log are made unreadable: a batch in order does
    not notice, a batch with a late event does."""
    import pathlib

    import pytest
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    schema, rows = spark.createDataFrame([], SCHEMA).schema, []
    for t in range(4):
        part = [at(str(k), t, float(t // 2), 10 * t + k, "IJ"[k % 2]) for k in range(4)] + [at(f"new{t}", t, 1.0, 100 + t, "I")]
        rows += part
        append_rows(spark.createDataFrame(part, SCHEMA), landing)
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, TB)
        for f in pathlib.Path(ev_root).rglob("*.parquet"):
            f.write_bytes(b"not a parquet file")
    assert norm(inc.read_history(spark, h_root, schema, TB)) == batch_history(spark, rows)
    append_rows(spark.createDataFrame([at("0", 1, 9.0, 999, "I")], SCHEMA), landing)
    with pytest.raises(Exception):
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, TB)


def test_scd2_open_rows_are_flat_over_arrivals(spark, tmp_dir):
    """Ten arrivals of the same keys: each writes the open rows and what closes, no more."""
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    schema = spark.createDataFrame([], SCHEMA).schema
    written = []
    for t in range(10):
        part = [(*at(str(k), 0, float(t), k, "I")[:6], dt.datetime(2024, 1, 1 + t), *at(str(k), 0, float(t), k, "I")[7:])
                for k in range(5)]
        append_rows(spark.createDataFrame(part, SCHEMA), landing)
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, TB)
        written.append(spark.read.parquet(f"{h_root}/v={t}").count())
    assert written == [5] + [10] * 9
    history = inc.read_history(spark, h_root, schema, TB)
    assert history.count() == 50 and history.where("__END_AT IS NULL").count() == 5


def test_scd2_fold_equals_batch_for_any_arrivals(spark, tmp_dir):
    """Late, repeated, NULL-sequence and equal-sequence events over several
    institutions ('' and NULL share a folder), dealt to arrivals at random."""
    import random
    rng = random.Random(8)
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = [at(str(rng.randrange(4)), rng.choice([None, 0, 1, 2, 3, 4, 5]), float(rng.randrange(2)), n,
               rng.choice(["I", "J", "", None])) for n in range(90)]
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    for lo, hi in ((0, 30), (30, 45), (45, 46), (46, 80), (80, 90)):
        append_rows(spark.createDataFrame(rows[lo:hi], SCHEMA), landing)
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, TB)
        assert norm(inc.read_history(spark, h_root, schema, TB)) == batch_history(spark, rows[:hi])


def test_scd2_mending_may_leave_nothing_closed(spark, tmp_dir):
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = [at("1", 0, 1.0, 1, "I"), at("1", 1, 2.0, 2, "I"), at("1", 1, 1.0, 3, "I")]
    for part in (rows[:2], rows[2:]):
        append_rows(spark.createDataFrame(part, SCHEMA), landing)
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, TB)
    got = inc.read_history(spark, h_root, schema, TB)
    assert norm(got) == batch_history(spark, rows) and got.count() == 1


def test_bad_files_are_set_aside_once_and_stop_no_other(spark, tmp_dir):
    import os

    from pyspark.sql import types as TT

    from quincena.schemas import payroll_schema
    from quincena.session import ship_package
    from quincena.streaming.quarantine import quarantine, rejected
    ship_package(spark)
    landing, away, ck, out, done = (f"{tmp_dir}/{n}" for n in ("land", "away", "ck", "bronze", "done"))
    schema = payroll_schema(TT.TimestampNTZType())
    good = spark.createDataFrame([ev("1", 0, 1.0, 1)], SCHEMA)
    seen = []
    for n in range(2):
        append_rows(good.coalesce(1), landing)
        append_rows(good.withColumn("Salario", good.salario.cast("string")).coalesce(1), landing)
        append_rows(good.withColumn("salario", good.salario.cast("float")).coalesce(1), landing)  # the reader widens it
        append_rows(good.drop("gasto").coalesce(1), landing)
        open(f"{landing}/broken{n}.parquet", "wb").write(b"PAR1 no more")
        open(f"{landing}/empty{n}.parquet", "wb").close()  # of no length: no reader opens it
        for _ in range(2):
            quarantine(spark, landing, schema, away, ck)
        b = inc.read_bronze(spark, out, inc.ingest_bronze(spark, landing, schema, out, done))
        seen.append((b.count(), rejected(spark, away).count(), len(os.listdir(f"{away}/files"))))
    assert [(a, b) for a, b, _ in seen] == [(3, 2), (6, 4)]
    assert {r.reason for r in rejected(spark, away).collect()} == {"not a Parquet file", "column salario is string, not double"}
    assert {f"broken{n}.parquet" for n in range(2)} <= set(os.listdir(f"{away}/files"))


def test_scd2_rows_are_dealt_once(spark, tmp_dir, monkeypatch):
    """The log takes a batch without an exchange, and versions are made and
    written by one of whole rows, also where late events mend a partition
    (another is of its name); the history stays the batch one."""
    import random

    from quincena.streaming.store import HistoryVersions, PartitionedVersions
    seen = []

    def spied(cls):
        real = cls.commit

        def commit(self, df, version, **kw):
            if not self.root.endswith("_late"):
                plan = df._jdf.queryExecution().executedPlan().toString()
                seen.append((cls.__name__, plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + (not kw.get("dealt", False))))
            return real(self, df, version, **kw)
        monkeypatch.setattr(cls, "commit", commit)

    spied(PartitionedVersions)
    spied(HistoryVersions)
    rng, rows = random.Random(5), []
    for i in range(160):
        at = None if i % 31 == 0 else T[rng.randrange(6)]
        rows.append((str(rng.randrange(9)), "N", None, rng.choice(["I", "J", "", None]), "C", "E", at,
                     float(rng.randrange(3)), None, dt.date(2020, 1, 1), at or T[0], i))
    landing, ev_root, h_root, ck = (f"{tmp_dir}/{n}" for n in ("land", "ev", "hist", "ck"))
    schema, tie = spark.createDataFrame([], SCHEMA).schema, ["fecha_actualizacion", "row_id"]
    for part in (rows[:50], rows[50:51], rows[51:120], rows[120:]):
        append_rows(spark.createDataFrame(part, SCHEMA), landing)
        inc.update_history(spark, landing, schema, ev_root, h_root, ck, tie)
    keys = ["cedula", "nombre", "apellido", "institucion", "cargo", "estado"]
    want = cdc.scd2_history(spark.createDataFrame(rows, SCHEMA), keys, "fecha_consulta",
                            ["salario", "gasto", "fecha_de_inicio"], tie)
    norm = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert norm(inc.read_history(spark, h_root, schema, tie)) == norm(want)
    assert {n for name, n in seen if name == "PartitionedVersions"} == {0}
    assert max(n for name, n in seen if name == "HistoryVersions") <= 2 and len(seen) == 8
