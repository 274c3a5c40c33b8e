"""One poll run as one path: the portal's index page says what is offered and
at which version, the audit log what is missing; the missing reports are read,
the sound ones land under their names, every request's result goes to the log,
and if anything landed the refresh follows."""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quincena.operators import audit, pages, reports
from quincena.plans.refresh import Layout, Manifest, full_refresh, refresh
from quincena.schemas import audit_schema
from quincena.session import materialize
from quincena.sources.landing import land_files
from quincena.sources.tables import append_rows

INSTITUTIONS, STATUSES = "cmbInst", "cmbEstado"


def poll(spark: SparkSession, layout: Layout, index_pages: DataFrame, sheet_rows: DataFrame, report_meta: DataFrame,
         translations: DataFrame, checked_at: _dt.datetime, default_stem: str = "report",
         audit_table_schema: T.StructType | None = None, full: bool = False, **options) -> dict:
    """Run one poll over ``index_pages`` (the portal's index page), the sheet
    rows and the metadata of the reports that its requests brought; returns
    what ``refresh`` returns. A report counts for the pair and version its
    metadata names, and only where that pair was due. Replayed with the same
    ``checked_at`` a run lands the same files and logs nothing twice."""
    schema = audit_table_schema or audit_schema()
    options = {**options, "audit_table_schema": schema}

    def offered(select_id: str, name: str) -> DataFrame:
        return pages.page_options(index_pages, pages.select_block(select_id)).select(F.col("option").alias(name))

    version = index_pages.transform(pages.page_version).agg(F.max("data_version")).first()[0]
    plan = materialize(audit.request_plan(offered(INSTITUTIONS, "institution_name_spanish"),
                                          offered(STATUSES, "status_name_spanish")), "request_plan")
    checked = F.lit(checked_at).cast("timestamp_ntz")
    log = spark.read.schema(schema).parquet(layout.audit)
    before = log.where(F.col("checked_at") < checked)  # without this run, should it be replayed
    due = materialize(audit.pending_reports(plan, before, F.lit(version)), "pending")
    meta = materialize(report_meta.join(due, (F.col("institucion") == F.col("institution_name_spanish"))
                                        & (F.col("estado") == F.col("status_name_spanish"))
                                        & (F.col("data_version") == F.lit(version)), "left_semi"), "report_meta")
    sheets = sheet_rows.join(meta.select("report_id").distinct(), "report_id", "left_semi")
    landed, failures = reports.read_reports(sheets, meta, default_stem, with_file=True)
    land_files(landed, layout.landing)
    times = spark.createDataFrame([], "institution_name_spanish string, status_name_spanish string, "
                                      "start_at timestamp_ntz, end_at timestamp_ntz")
    rows = materialize(audit.poll_run(plan, before, F.lit(version), reports.results(meta, failures), times, checked), "poll_run")
    new = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]).join(
        log.where(F.col("checked_at") == checked).select(*audit.KEYS), audit.KEYS, "left_anti")
    append_rows(materialize(new, "poll_new"), layout.audit)
    if full:
        return full_refresh(spark, layout, translations, **options)
    return refresh(spark, replace(layout, generation=Manifest(spark, layout).served()[0]), translations, run_audit=rows, **options)
