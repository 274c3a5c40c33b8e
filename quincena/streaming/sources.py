"""Incremental file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quincena.operators.bronze import enrich


def landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files of a landing folder, each read once, with the declared
    schema enforced (extra columns ignored, missing ones NULL; names match
    case-insensitively)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(landing_dir)


def bronze_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Landing rows with the bronze derived columns; no filters."""
    return enrich(landing_stream(spark, landing_dir, schema, max_files_per_trigger))
