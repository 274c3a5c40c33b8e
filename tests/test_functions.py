import datetime as dt

from pyspark.sql import functions as F

from quincena.functions import columns as C


def one(spark, col, data=None, schema="x string"):
    df = spark.createDataFrame(data or [(None,)], schema)
    return [r[0] for r in df.select(col).collect()]


def test_t1_pm_is_honoured(spark):
    got = one(spark, C.parse_report_datetime("x"),
              [("5/3/2024 2:30:00 PM",), ("5/3/2024 14:30:00 PM",), ("05/03/2024 09:05:01 AM",), ("junk",)])
    assert got == [dt.datetime(2024, 3, 5, 14, 30), dt.datetime(2024, 3, 5, 14, 30),
                   dt.datetime(2024, 3, 5, 9, 5, 1), None]


def test_f14_url_quote(spark):
    got = one(spark, C.url_quote("x"), [("Caja de Ahorros ñ/a(b)",), ("a*b~c",)])
    assert got == ["Caja%20de%20Ahorros%20%C3%B1/a%28b%29", "a%2Ab~c"]


def test_report_url(spark):
    got = one(spark, C.report_url("https://h/R", F.col("i"), F.col("s")), [("D'ARIEN X", "PERMANENTE")],
              "i string, s string")
    assert got == ["https://h/R?&Ne=D%27ARIEN%20X&N=&A=&C=&E=PERMANENTE"]


def test_f3_tenure(spark):
    rows = [(dt.datetime(2024, 3, 15, 0, 0), dt.date(2020, 1, 15)),   # same day of month
            (dt.datetime(2024, 2, 29, 10, 0), dt.date(2023, 11, 30)),  # both month-ends
            (dt.datetime(2024, 3, 16, 12, 0), dt.date(2024, 2, 15))]   # 31-day fraction incl. time
    got = one(spark, C.years_between("e", "s"), rows, "e timestamp_ntz, s date")
    assert got[0] == 50 / 12
    assert got[1] == 3 / 12
    assert abs(got[2] - round(1 + (86400 + 43200) / (31 * 86400), 8) / 12) < 1e-12


def test_composite_key_skips_nulls(spark):
    got = one(spark, C.composite_key(), [("A", None, "I", "C", "8-1-2")],
              "nombre string, apellido string, institucion string, cargo string, cedula string")
    assert got == ["A-I-C-812"]


def test_stamp_and_names(spark):
    got = one(spark, C.landing_file_name(F.lit("rep"), F.lit("E"), F.col("t")),
              [(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert got == ["rep_E_1704067200_0.parquet"]
    got = one(spark, C.file_stem(F.col("x"), "dflt"), [('attachment; filename="abc.xlsx"',), (None,), ("x",)])
    assert got == ["abc", "dflt", "dflt"]


def test_duration_and_header(spark):
    got = one(spark, C.duration_seconds("a", "b"),
              [(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1, 30, 500000))], "a timestamp_ntz, b timestamp_ntz")
    assert got == [90.5]
    assert one(spark, C.normalize_header("x"), [("  Fecha de Inicio ",)]) == ["fecha_de_inicio"]
    assert one(spark, C.report_label("a", "b"), [("I", None), ("I", "S")], "a string, b string") == [None, "I - S"]


def test_cluster_conf_scales_with_input():
    from quincena.session import cluster_conf
    small = cluster_conf(10 << 30, 8000)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24000
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
