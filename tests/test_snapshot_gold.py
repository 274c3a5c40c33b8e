import datetime as dt
import json

from quincena.operators import bronze, dims, gold, inactive, snapshot
from quincena.operators.cdc import scd2_history

V1, V2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 4, 1)
LAND = ("nombre string, apellido string, cedula string, cargo string, salario double, gasto double, estado string, "
        "fecha_de_inicio date, fecha_actualizacion timestamp_ntz, fecha_consulta timestamp_ntz, archivo string, "
        "institucion string")
AUDIT = ("institution_name_spanish string, status_name_spanish string, run_status string, "
         "source_update timestamp_ntz, checked_at timestamp_ntz")
DICT = "spanish string, english string"


def row(n, ced, inst, v, sal=1.0, gasto=None, cargo="C1", estado="E", ap="L", start=dt.date(2020, 1, 1)):
    return (n, ap, ced, cargo, sal, gasto, estado, start, v + dt.timedelta(hours=14), v, "f", inst)


def build(spark, land_rows, audit_rows, dict_rows=()):
    b = bronze.enrich(spark.createDataFrame(land_rows, LAND))
    a = spark.createDataFrame(audit_rows, AUDIT)
    d = spark.createDataFrame(list(dict_rows) or [("zz", "zz")], DICT)
    return b, snapshot.latest_snapshot(b, dims.dim_institution(a, d), dims.dim_status(a, d), dims.dim_position(b, d))


def test_t7_version_gate(spark):
    land = [row("A", "1", "I1", V2), row("B", "2", "I2", V1), row("C", "3", "I2", V2)]
    audit = [("I1", "E", "OK", V2, V2), ("I2", "E", "OK", V1, V1), ("I2", "E", "FAIL", V2, V2)]
    _, s = build(spark, land, audit)
    # I2's newest OK version (V1) is older than the status's newest (V2): no I2 rows.
    assert sorted(r.first_name for r in s.collect()) == ["A"]


def test_translations_and_unknown_position(spark):
    land = [row("A", "1", "I1", V2, cargo="C1"), row("B", "2", "I1", V2, cargo="C9")]
    audit = [("I1", "E", "OK", V2, V2)]
    _, s = build(spark, land, audit, [("I1", "Inst 1"), ("C1", "Pos 1"), ("E", "Stat E")])
    got = sorted((r.first_name, r.institution_en, r.status_en, r.position_en) for r in s.collect())
    assert got == [("A", "Inst 1", "Stat E", "Pos 1"), ("B", "Inst 1", "Stat E", None)]


def test_t3_sums_and_t9_t10(spark):
    land = [row("A", "1", "I1", V2, sal=1.0, gasto=None, start=dt.date(2021, 1, 1)),
            row("A", "1", "I1", V2, sal=2.0, gasto=3.0, start=dt.date(2019, 1, 1))]
    _, s = build(spark, land, [("I1", "E", "OK", V2, V2)])
    e = gold.employee_summary(s).collect()[0]
    assert e.total_compensation == 6.0 and e.total_salary == 3.0 and e.total_allowance == 3.0
    assert e.total_years_of_service == max(r.years_of_service for r in s.collect())
    p = gold.position_summary(s).collect()[0]
    assert p.total_compensation == 5.0 and p.employee_count == 2 and p.unique_employee_count == 1


def test_t6_multiple_names(spark):
    land = [row("A", "1", "I1", V2, ap=None), row("B", "1", "I1", V2, ap=None, cargo="C2"),
            row("A", "2", "I1", V2, ap="X"), row("B", "2", "I1", V2, ap="X", cargo="C2")]
    _, s = build(spark, land, [("I1", "E", "OK", V2, V2)])
    got = {r.id_number: r.multiple_names for r in gold.employee_summary(s).collect()}
    assert got == {"1": 0, "2": 1}


def test_t11_json_does_not_depend_on_order(spark):
    land = [row("A", "1", "I1", V2, cargo="C1"), row("A", "1", "I1", V2, cargo="C2", sal=5.0)]
    audit = [("I1", "E", "OK", V2, V2)]
    j1 = gold.employee_summary(build(spark, land, audit)[1]).collect()[0].positions_details_json
    j2 = gold.employee_summary(build(spark, land[::-1], audit)[1]).collect()[0].positions_details_json
    assert j1 == j2 and [d["position"] for d in json.loads(j1)] == ["C1", "C2"]


def _inactive(spark, land, snap_land, audit):
    b = bronze.enrich(spark.createDataFrame(land, LAND))
    h = scd2_history(b, ["cedula", "nombre", "apellido", "institucion", "cargo", "estado"], "fecha_consulta",
                     ["salario", "gasto", "fecha_de_inicio"], ["fecha_actualizacion"])
    _, s = build(spark, snap_land, audit)
    return inactive.inactive_employees(h, s, detected_at=dt.datetime(2024, 1, 1)).collect()


def test_t4_other_institution_not_flagged(spark):
    land = [row("A", "1", "I1", V2), row("A", "1", "I2", V2)]
    got = _inactive(spark, land, [row("A", "1", "I1", V2)], [("I1", "E", "OK", V2, V2)])
    assert got == []


def test_t5_null_key_always_flagged(spark):
    land = [row("A", "1", "I1", V2, cargo=None)]
    got = _inactive(spark, land, land, [("I1", "E", "OK", V2, V2)])
    assert len(got) == 1 and got[0].last_active_date == V2 and got[0].detected_at == dt.datetime(2024, 1, 1)


def test_t15_position_dimension_unique(spark):
    land = [row("A", "1", "I1", V1, cargo="C1"), row("B", "2", "I1", V2, cargo="C1"), row("C", "3", "I1", V2, cargo=None)]
    b = bronze.enrich(spark.createDataFrame(land, LAND))
    d = spark.createDataFrame([("C1", "Pos 1"), ("C1", "Position 1")], DICT)
    got = dims.dim_position(b, d).collect()
    assert len(got) == 1 and got[0].position_name_english == "Pos 1"
    assert got[0].last_seen_at == V1 + dt.timedelta(hours=14)
