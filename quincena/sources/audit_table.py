"""The audit (poll log) table: created once, appended once per run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quincena.schemas import AUDIT_DDL
from quincena.session import materialize

AUDIT_COLUMNS = ["institution_name_spanish", "status_name_spanish", "run_status", "source_update",
                 "checked_at", "start_at", "end_at", "time"]
NOT_NULL = [c for c in AUDIT_COLUMNS if c != "checked_at"]


def create_audit_table(spark: SparkSession, name: str, location: str, ntz: bool = False) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the declared columns; ``checked_at``
    defaults to the current time. Parquet tables accept the NOT NULL
    declaration without enforcing it, so :func:`append_audit` checks it."""
    ts = "TIMESTAMP_NTZ" if ntz else "TIMESTAMP"
    ddl = AUDIT_DDL.format(name=name, ts=ts, location=location)
    if ntz:
        ddl = ddl.replace("DEFAULT current_timestamp()", "DEFAULT localtimestamp()")
    spark.sql(ddl)


# What makes a row of the log the same row: one run checks a report once.
RUN_KEY = ["institution_name_spanish", "status_name_spanish", "checked_at"]


def append_audit(spark: SparkSession, name: str, rows: DataFrame) -> int:
    """Append typed rows by column name, each exactly once: rows whose run key
    (pair and check time) the log has, or that repeat among ``rows``, are left
    out, so a run that is replayed after a failure adds nothing. The key is
    part of the rows, so it is committed with them. Rows with NULL in a NOT
    NULL column are rejected before anything is written; a row without a check
    time has no key and is always appended. Returns the rows appended.

    ``rows`` are evaluated once (written to the shared folder); the log is
    read by key columns only, from the oldest check time of the run on."""
    target = spark.table(name)
    typed = materialize(rows.select(*[F.col(c).cast(target.schema[c].dataType) for c in target.columns]), "audit_rows")
    bad = typed.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in NOT_NULL]))
    if not bad.isEmpty():
        raise ValueError(f"audit rows with NULL in a NOT NULL column: {bad.first()}")
    keyed = typed.where(F.col("checked_at").isNotNull())
    oldest = keyed.agg(F.min("checked_at")).scalar()
    known = target.where(F.col("checked_at") >= oldest).select(*RUN_KEY)
    new = materialize(keyed.dropDuplicates(RUN_KEY).join(known, RUN_KEY, "left_anti").select(*target.columns)
                      .unionAll(typed.where(F.col("checked_at").isNull())), "audit_new")
    count = new.count()
    if count:
        new.write.mode("append").insertInto(name)
    return count
