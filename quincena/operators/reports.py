"""Raw report sheets → typed payroll landing records.

Input is a table of sheet rows ``(report_id, sheet_no, row_no, cells)``
(1-based rows: row 3 of the first sheet carries the banner date in cell 5,
row 5 is the header, rows 6+ are data) plus one metadata row per report.
Sheets of one report are aligned by column name, so column order may differ
between sheets. A report that cannot be read whole lands nothing: it is
listed as a failure with its reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.fixed import (ACCENTED_ID_HEADER, BANNER_CELL, BANNER_DATE_PATTERN, BANNER_ROW,
                            FIRST_DATA_ROW, FIRST_SHEET, HEADER_ROW, START_DATE_FORMAT)
from quincena.functions.columns import file_stem, landing_file_name, normalize_header, parse_report_datetime
from quincena.schemas import RUN_FAIL, RUN_OK
from quincena.session import materialize

FIELDS = ["nombre", "apellido", "cedula", "cargo", "salario", "gasto", "estado", "fecha_de_inicio"]


def _position(names, name: str):
    """1-based position of a column name in the header, NULL when absent."""
    return F.nullif(F.array_position(names, F.lit(name)), F.lit(0)).cast("int")


# Columns that some sheet of a report must have, and how their cells are read.
READ_AS = {"salario": ("money", lambda c: c.try_cast("double")),
           "gasto": ("money", lambda c: c.try_cast("double")),
           "fecha_de_inicio": ("date", lambda c: F.try_to_date(c, START_DATE_FORMAT))}


def _cell(field: str):
    return F.try_element_at("cells", F.col("_p_" + field))


def _read(field: str):
    """Typed cell; a blank one is empty."""
    text = F.nullif(F.trim(_cell(field)), F.lit(""))
    return READ_AS[field][1](text)


ROW_KEY = ["report_id", "sheet_no", "row_no"]


def _once(sheet_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each sheet row once, however often it was delivered, and the reports
    in which one row came with different cells. Both read one exchange by
    (report, sheet, row), which spreads a hot report."""
    rows = sheet_rows.select(*ROW_KEY, "cells").repartition(*ROW_KEY).distinct()
    torn = rows.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("report_id").distinct()
    return rows, torn


def _tops(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Header positions per sheet (``cédula`` stands in for a missing
    ``cedula``) and banner date per report. Their rows, at most two a sheet,
    are written first, so that joins with them go by measured bytes."""
    tops = materialize(rows.where(F.col("row_no").isin(BANNER_ROW, HEADER_ROW)), "report_tops")
    names = F.transform("cells", lambda x: normalize_header(x))
    pos = {f: _position(F.col("names"), f) for f in FIELDS}
    pos["cedula"] = F.coalesce(pos["cedula"], _position(F.col("names"), ACCENTED_ID_HEADER))
    headers = (tops.where(F.col("row_no") == HEADER_ROW)
               .select("report_id", "sheet_no", names.alias("names"))
               .select("report_id", "sheet_no", F.lit(True).alias("_header"), *[pos[f].alias("_p_" + f) for f in FIELDS]))
    banner = (tops.where((F.col("row_no") == BANNER_ROW) & (F.col("sheet_no") == FIRST_SHEET))
              .select("report_id", parse_report_datetime(
                  F.regexp_extract(F.try_element_at("cells", F.lit(BANNER_CELL)), BANNER_DATE_PATTERN, 1))
                  .alias("fecha_actualizacion")))
    return headers, banner


def _meta(report_meta: DataFrame, default_stem: str) -> DataFrame:
    """One row a report: its metadata, and whether rows of it disagree."""
    value = F.struct(F.col("data_version").cast("timestamp_ntz").alias("fecha_consulta"),
                     file_stem(F.col("content_disposition"), default_stem).alias("archivo"), "institucion", "estado")
    return report_meta.groupBy("report_id").agg(F.min(value).alias("_m"), F.max(value).alias("_n")).select(
        "report_id", "_m.fecha_consulta", "_m.archivo", "_m.institucion", F.col("_m.estado").alias("meta_estado"),
        (~F.col("_m").eqNullSafe(F.col("_n"))).alias("_disagrees"))


def _failures(rows: DataFrame, torn: DataFrame, banner: DataFrame, meta: DataFrame) -> DataFrame:
    bad = F.when(F.col("_header").isNull(), F.lit("no header"))
    for f in READ_AS:
        unreadable = (F.length(F.trim(_cell(f))) > 0) & _read(f).isNull()
        bad = bad.when((F.col("row_no") >= FIRST_DATA_ROW) & unreadable, F.lit(f"unreadable {READ_AS[f][0]}"))
    found = rows.groupBy("report_id").agg(
        F.min(bad).alias("_bad"), *[F.max(F.col("_p_" + f).isNotNull()).alias("_has_" + f) for f in READ_AS])
    known = meta.select("report_id", "_disagrees")
    dated = banner.groupBy("report_id").agg(F.max("fecha_actualizacion").isNotNull().alias("_dated"))
    reason = F.when(F.col("report_id").isNull(), F.lit("no report id")) \
              .when(F.col("_disagrees").isNull(), F.lit("no metadata")) \
              .when(F.col("_disagrees"), F.lit("contradictory metadata")) \
              .when(F.col("_has_salario").isNull(), F.lit("no sheet")) \
              .when(F.col("_torn"), F.lit("contradictory rows")).when(F.col("_bad").isNotNull(), F.col("_bad"))
    for f in READ_AS:
        reason = reason.when(~F.col("_has_" + f), F.lit(f"no column {f}"))
    reason = reason.when(~F.coalesce("_dated", F.lit(False)), F.lit("no banner date"))
    return (found.join(known, "report_id", "full").join(dated, "report_id", "left")
            .join(torn.withColumn("_torn", F.lit(True)), "report_id", "left")
            .groupBy("report_id").agg(F.min(reason).alias("reason")).where(F.col("reason").isNotNull()))


def read_reports(sheet_rows: DataFrame, report_meta: DataFrame, default_stem: str = "report",
                 with_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """Typed landing rows of the sound reports, and ``(report_id, reason)`` of
    the others.

    Landing rows: header promotion and name normalisation, money cast to
    double, start date ``d/m/yyyy`` to DATE, the banner date (PM honoured) on
    every row, then the data version, file stem and institution from the
    report metadata. A column that only some sheets have is NULL elsewhere.

    Sheet rows and metadata that were delivered more than once count once. A
    report fails without an id or metadata, with metadata or rows (of one
    sheet and number) that contradict each other, without sheet rows, with a
    sheet without header row, a money or date cell that is neither blank nor
    readable, no money or start date column in any sheet or no readable
    banner date; the first reason in that order is given (of several cells,
    the smallest). Rows land only of reports that have metadata and no failure.
    ``with_file`` adds ``landing_file``, the name of the file a row lands in.

    Failures are one aggregate over the rows (a flag a row, combined on the
    map side), written once; data rows meet only one-row-a-sheet and
    one-row-a-report tables, which AQE broadcasts by measured bytes.
    """
    rows, torn = _once(sheet_rows)
    headers, banner = _tops(rows)
    rows = rows.join(headers, ["report_id", "sheet_no"], "left")
    meta = _meta(report_meta, default_stem)
    failures = materialize(_failures(rows, torn, banner, meta), "report_failures")
    sound = meta.join(failures, "report_id", "left_anti").join(banner, "report_id").withColumn(
        "landing_file", landing_file_name("archivo", "meta_estado", "fecha_consulta")).drop("_disagrees", "meta_estado")
    landed = (rows.where(F.col("row_no") >= FIRST_DATA_ROW)
              .select("report_id", *[(_read(f) if f in READ_AS else _cell(f)).alias(f) for f in FIELDS])
              .join(sound, "report_id")
              .select(*FIELDS, "fecha_actualizacion", "fecha_consulta", "archivo", "institucion",
                      *["landing_file"] * with_file))
    return landed, failures


def results(report_meta: DataFrame, failures: DataFrame) -> DataFrame:
    """How the request of each pair ended, one row a pair and data version:
    ``OK`` if a report of it landed, ``FAIL`` if none of them did."""
    failed = failures.select("report_id", F.lit(True).alias("_failed"))
    landed = F.max(F.col("_failed").isNull())
    return report_meta.where(F.col("report_id").isNotNull()).join(failed, "report_id", "left").groupBy(
        F.col("institucion").alias("institution_name_spanish"), F.col("estado").alias("status_name_spanish"),
        F.col("data_version").cast("timestamp_ntz").alias("source_update")).agg(
        F.when(landed, F.lit(RUN_OK)).otherwise(F.lit(RUN_FAIL)).alias("run_status"))


def clean_reports(sheet_rows: DataFrame, report_meta: DataFrame, default_stem: str = "report") -> DataFrame:
    """Landing rows of ``read_reports``."""
    return read_reports(sheet_rows, report_meta, default_stem)[0]
