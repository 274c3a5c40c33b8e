"""Incremental (triggered) forms of the operators, each one call per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quincena.operators import cdc, dims
from quincena.schemas import AUDIT_KEYS, RUN_OK, SCD2_KEYS, SCD2_SEQUENCE, SCD2_TRACKED
from quincena.streaming import sinks
from quincena.streaming.runner import FOLDER_ZONE, run_available
from quincena.streaming.sources import bronze_stream, landing_stream
from quincena.streaming.store import AppendedTable, HistoryVersions, PartitionedVersions, VersionedTable


BRONZE_PARTITIONS = ["fecha_consulta"]
# State stores of an aggregate whose state is one row per institution or status.
NAME_STATE_PARTITIONS = 4


def ingest_bronze(spark: SparkSession, landing_dir: str, schema: T.StructType, bronze_dir: str,
                  checkpoint: str, max_files_per_trigger: int | None = None,
                  partition_by: list[str] | None = BRONZE_PARTITIONS) -> T.StructType:
    """New landing files → bronze folder (exactly-once Parquet file sink),
    partitioned by data version so that version filters prune whole folders
    (named in UTC, whatever zone the sessions that write and read are in).
    Returns the bronze schema; read bronze with it (``read_bronze``) so the
    partition column keeps its declared type."""
    stream = bronze_stream(spark, landing_dir, schema, max_files_per_trigger)
    run_available(stream, checkpoint, sink_path=bronze_dir, partition_by=partition_by)
    return stream.schema


def read_bronze(spark: SparkSession, bronze_dir: str, bronze_schema: T.StructType) -> DataFrame:
    """Committed bronze files (the sink's log), declared schema."""
    return spark.read.schema(bronze_schema).options(**FOLDER_ZONE).parquet(bronze_dir)


# Event log and history are partitioned (and versioned) by institution.
HISTORY_PARTITION = "institucion"
HISTORY_CLUSTER = ("estado", "cargo")


def history_schema(spark: SparkSession, events_schema: T.StructType, tie_break: list[str]) -> T.StructType:
    """Schema of the type-2 history built from events of ``events_schema``
    (derived from the batch function's plan over an empty frame)."""
    empty = spark.createDataFrame([], events_schema)
    return cdc.scd2_history(empty, SCD2_KEYS, SCD2_SEQUENCE, SCD2_TRACKED, tie_break).schema


def read_history(spark: SparkSession, history_root: str, events_schema: T.StructType,
                 tie_break: list[str]) -> DataFrame | None:
    """Current type-2 history: each institution's open versions and all closed ones."""
    return HistoryVersions(spark, history_root, HISTORY_PARTITION).read(
        history_schema(spark, events_schema, tie_break))


def history_sink(spark: SparkSession, events_root: str, history_root: str, tie_break: list[str]):
    return sinks.scd2_sink(PartitionedVersions(spark, events_root, HISTORY_PARTITION),
                           HistoryVersions(spark, history_root, HISTORY_PARTITION, HISTORY_CLUSTER),
                           PartitionedVersions(spark, f"{events_root}_late", HISTORY_PARTITION),
                           SCD2_KEYS, SCD2_SEQUENCE, SCD2_TRACKED, tie_break)


def update_history(spark: SparkSession, bronze_dir: str, schema: T.StructType, events_root: str,
                   history_root: str, checkpoint: str, tie_break: list[str],
                   max_files_per_trigger: int | None = None) -> None:
    """New bronze files → type-2 history (keys, sequence and tracked columns
    of the payroll)."""
    stream = landing_stream(spark, bronze_dir, schema, max_files_per_trigger)
    sink = history_sink(spark, events_root, history_root, tie_break)
    run_available(stream, checkpoint, foreach_batch=sink)


def update_latest_poll(spark: SparkSession, audit_dir: str, schema: T.StructType, target_root: str,
                       checkpoint: str, tie_break: list[str] | None = None,
                       max_files_per_trigger: int | None = None) -> None:
    """New audit rows → latest poll per (institution, status)."""
    stream = landing_stream(spark, audit_dir, schema, max_files_per_trigger)
    sink = sinks.scd1_sink(VersionedTable(spark, target_root), AUDIT_KEYS, "checked_at", tie_break)
    run_available(stream, checkpoint, foreach_batch=sink)


def update_name_dimension(spark: SparkSession, audit_dir: str, schema: T.StructType, name_col: str,
                          out_col: str, translations: DataFrame, target_root: str, checkpoint: str,
                          max_files_per_trigger: int | None = None, translate: dims.Translate = dims.translate,
                          state_partitions: int = NAME_STATE_PARTITIONS) -> None:
    """New audit rows → newest OK version per name (complete-mode streaming
    aggregate; its state is one row per name, in few state stores) →
    dimension translated by ``translate``."""
    agg = (landing_stream(spark, audit_dir, schema, max_files_per_trigger)
           .where(F.col("run_status") == RUN_OK)
           .groupBy(name_col)
           .agg(F.max("source_update").alias("last_source_update"),
                F.max("checked_at").alias("last_checked_at")))
    sink = sinks.dimension_sink(VersionedTable(spark, target_root), name_col, translations, out_col, translate)
    run_available(agg, checkpoint, foreach_batch=sink, output_mode="complete", state_partitions=state_partitions)


def update_positions(spark: SparkSession, bronze_dir: str, schema: T.StructType, target_root: str,
                     checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """New bronze files → positions not seen before, appended."""
    stream = landing_stream(spark, bronze_dir, schema, max_files_per_trigger)
    run_available(stream, checkpoint, foreach_batch=sinks.novelty_sink(AppendedTable(spark, target_root)))


def read_positions(spark: SparkSession, target_root: str, schema: T.StructType, translations: DataFrame,
                   translate: dims.Translate = dims.translate) -> DataFrame:
    """Position dimension from the appended positions of bronze rows of
    ``schema``. Names are translated as they are read, so a dictionary entry
    that comes later shows, too."""
    columns = dims.new_positions(spark.createDataFrame([], schema)).schema
    seen = AppendedTable(spark, target_root).read(schema=columns)
    return translate(seen, "position_name_spanish", translations, "position_name_english")


__all__ = ["ingest_bronze", "update_history", "update_latest_poll", "update_name_dimension",
           "update_positions", "read_positions", "read_bronze", "read_history"]
