"""Poll planning over the audit log: which reports are current, which must be
requested, how each request ended, and whether anything changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quincena.functions.columns import duration_seconds, report_url
from quincena.schemas import RUN_FAIL, RUN_NO_UPDATE, RUN_OK


def up_to_date(audit: DataFrame, version) -> DataFrame:
    """Successful polls at or after the portal's current data version."""
    v = version if isinstance(version, Column) else F.lit(version)
    return audit.where((F.col("run_status") == RUN_OK) & (F.col("source_update") >= v))


def request_plan(institutions: DataFrame, statuses: DataFrame, chunks: int = 64) -> DataFrame:
    """Every (institution, status) pair the portal offers: one report request
    each, so the output *is* the product of the two option lists.

    Statuses are split by hash into ``chunks`` groups; institution rows are
    replicated once per group and meet their statuses in an equi-join on the
    group, so no task holds a whole list, whatever its length.
    """
    s = statuses.select("status_name_spanish").distinct() \
        .withColumn("_g", F.pmod(F.xxhash64("status_name_spanish"), F.lit(chunks)))
    i = institutions.select("institution_name_spanish").distinct() \
        .withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return i.join(s, "_g").drop("_g")


def pending_reports(plan: DataFrame, audit: DataFrame, version) -> DataFrame:
    """Planned pairs with no successful poll at the current version: one
    anti join instead of one existence probe per pair. Names are compared
    as typed columns, so quotes in names need no escaping."""
    current = up_to_date(audit, version).select(
        "institution_name_spanish", "status_name_spanish")
    return plan.join(current, ["institution_name_spanish", "status_name_spanish"], "left_anti")


def request_urls(pending: DataFrame, base_url: str) -> DataFrame:
    return pending.withColumn(
        "url", report_url(base_url, F.col("institution_name_spanish"), F.col("status_name_spanish")))


KEYS = ["institution_name_spanish", "status_name_spanish"]


def classify_runs(plan: DataFrame, audit: DataFrame, version, results: DataFrame) -> DataFrame:
    """Status of each planned pair in a run: ``No Update`` when already
    current, else what its request came to. ``results`` has a row for each
    request that was made (pair and ``run_status``); of several requests of a
    pair one that is ``OK`` counts. A pair that was due but has no result was
    not polled: it has no row, and stays pending."""
    current = up_to_date(audit, version).select(*KEYS).distinct().withColumn("_current", F.lit(True))
    ended = results.where(F.col("run_status").isin(RUN_OK, RUN_FAIL)).groupBy(*KEYS).agg(
        F.max(F.col("run_status") == RUN_OK).alias("_ok"))
    j = plan.join(current, KEYS, "left").join(ended, KEYS, "left")
    status = (F.when(F.col("_current"), F.lit(RUN_NO_UPDATE))
               .when(F.col("_ok"), F.lit(RUN_OK)).when(~F.col("_ok"), F.lit(RUN_FAIL)))
    v = version if isinstance(version, Column) else F.lit(version)
    return j.select(*KEYS, status.alias("run_status"), v.alias("source_update")).where(F.col("run_status").isNotNull())


def poll_run(plan: DataFrame, audit: DataFrame, version, results: DataFrame, times: DataFrame,
             checked_at) -> DataFrame:
    """Audit rows of one run over ``plan``: the status of each pair (see
    ``classify_runs``) with the start and end of its request from ``times``.
    A pair that was current, or that lacks one of its times, starts and ends
    at ``checked_at``; of several requests of a pair the whole span counts."""
    ca = checked_at if isinstance(checked_at, Column) else F.lit(checked_at)
    spans = times.groupBy(*KEYS).agg(F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at"))
    runs = classify_runs(plan, audit, version, results).join(spans, KEYS, "left").withColumns(
        {c: F.coalesce(F.when(F.col("run_status") != RUN_NO_UPDATE, F.col(c)), ca) for c in ("start_at", "end_at")})
    return audit_rows(runs, ca)


def updates_gate(runs: DataFrame) -> DataFrame:
    """Pairs that a run downloaded (each counts once, also when the run's rows
    are there twice), and whether the refresh should run."""
    pairs = runs.where(F.col("run_status") == RUN_OK).select(*KEYS).distinct()
    return pairs.agg(F.count(F.lit(1)).alias("updates")) \
        .withColumn("refresh", F.col("updates") > 0)


def audit_rows(runs: DataFrame, checked_at) -> DataFrame:
    """Typed audit rows: run time from start/end, one check time per run."""
    ca = checked_at if isinstance(checked_at, Column) else F.lit(checked_at)
    return runs.select(
        "institution_name_spanish", "status_name_spanish", "run_status", "source_update",
        ca.alias("checked_at"), "start_at", "end_at", duration_seconds("start_at", "end_at").alias("time"))
