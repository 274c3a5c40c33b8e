"""Declared schemas of the data model (payroll landing rows, audit log,
raw report sheets, report metadata, portal pages, translations)."""

from __future__ import annotations

from pyspark.sql import types as T

from quincena.fixed import RUN_FAIL, RUN_NO_UPDATE, RUN_OK  # noqa: F401

# Payroll landing record: twelve nullable columns, enforced on read.
PAYROLL_COLUMNS = [
    "nombre", "apellido", "cedula", "cargo", "salario", "gasto", "estado",
    "fecha_de_inicio", "fecha_actualizacion", "fecha_consulta", "archivo", "institucion",
]


def payroll_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    """Explicit landing schema. Files written by Spark from NTZ data keep
    ``TimestampNTZType``; files from other writers use ``TimestampType``."""
    ts = timestamp_type or T.TimestampType()
    s, d = T.StringType(), T.DoubleType()
    return T.StructType([
        T.StructField("nombre", s), T.StructField("apellido", s), T.StructField("cedula", s),
        T.StructField("cargo", s), T.StructField("salario", d), T.StructField("gasto", d),
        T.StructField("estado", s), T.StructField("fecha_de_inicio", T.DateType()),
        T.StructField("fecha_actualizacion", ts), T.StructField("fecha_consulta", ts),
        T.StructField("archivo", s), T.StructField("institucion", s),
    ])


# Keys and tracked columns of the payroll change history.
SCD2_KEYS = ["cedula", "nombre", "apellido", "institucion", "cargo", "estado"]
SCD2_SEQUENCE = "fecha_consulta"
SCD2_TRACKED = ["salario", "gasto", "fecha_de_inicio"]

# Snapshot columns: name there -> bronze column. Names in English come from the dimensions.
SNAPSHOT = {"composite_key": "composite_key", "first_name": "nombre", "last_name": "apellido", "id_number": "cedula",
            "salary": "salario", "allowance": "gasto", "status_sp": "estado", "institution_sp": "institucion",
            "position_sp": "cargo", "start_date": "fecha_de_inicio", "query_date": "fecha_actualizacion",
            "snapshot_date": "fecha_consulta", "years_of_service": "antiguedad", "file": "archivo"}
SNAPSHOT_ENGLISH = {"status_en": "status_name_english", "institution_en": "institution_name_english",
                    "position_en": "position_name_english"}

# Keys of the latest-poll table (one row per report).
AUDIT_KEYS = ["institution_name_spanish", "status_name_spanish"]


def audit_schema(timestamp_type: T.DataType | None = None) -> T.StructType:
    ts = timestamp_type or T.TimestampType()
    return T.StructType([
        T.StructField("institution_name_spanish", T.StringType(), False),
        T.StructField("status_name_spanish", T.StringType(), False),
        T.StructField("run_status", T.StringType(), False),
        T.StructField("source_update", ts, False),
        T.StructField("checked_at", ts, True),
        T.StructField("start_at", ts, False),
        T.StructField("end_at", ts, False),
        T.StructField("time", T.FloatType(), False),
    ])


AUDIT_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  institution_name_spanish STRING NOT NULL,
  status_name_spanish STRING NOT NULL,
  run_status STRING NOT NULL,
  source_update {ts} NOT NULL,
  checked_at {ts} DEFAULT current_timestamp(),
  start_at {ts} NOT NULL,
  end_at {ts} NOT NULL,
  time FLOAT NOT NULL
) USING parquet LOCATION '{location}'
"""

# Raw workbook rows: one row per sheet row, 1-based row numbers.
SHEET_ROWS = T.StructType([
    T.StructField("report_id", T.StringType()),
    T.StructField("sheet_no", T.IntegerType()),
    T.StructField("row_no", T.IntegerType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

REPORT_META = T.StructType([
    T.StructField("report_id", T.StringType()),
    T.StructField("institucion", T.StringType()),
    T.StructField("estado", T.StringType()),
    T.StructField("content_disposition", T.StringType()),
    T.StructField("data_version", T.TimestampNTZType()),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

TRANSLATIONS = T.StructType([
    T.StructField("spanish", T.StringType()),
    T.StructField("english", T.StringType()),
])
