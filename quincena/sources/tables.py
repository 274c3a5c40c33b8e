"""Batch reads and writes of tables (Parquet folders)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quincena.functions.curve import curve_key


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of one table stored as ``{root}/{name}.parquet`` (file or folder)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def write_view(df: DataFrame, path: str, cluster_by: list[str] | None = None,
               partition_by: list[str] | None = None) -> None:
    """Materialised-view sink: recompute and overwrite.

    ``cluster_by`` lays rows out so that Parquet min/max statistics can skip
    row groups on the query keys: range-partition on the keys plus a row
    hash (a sampled boundary shuffle; the hash lets one hot key value spread
    over several partitions instead of one task) and sort each partition.
    """
    if cluster_by:
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
        df = df.repartitionByRange(*cluster_by, spread).sortWithinPartitions(*cluster_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Landing sink: append Parquet files (one folder per partition value)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int | None = None,
                    rows_in_group: int | None = None) -> None:
    """Overwrite ``path`` with ``df`` laid out along a space-filling curve over
    ``columns``: a filter on any one of them finds few files and row groups.

    Rows are range-partitioned on the curve key and a row hash (so a hot place
    on the curve spreads over tasks) into ``files`` files (the session's
    shuffle partitions by default) and sorted in each. ``df`` should be a
    written table: the key's ranges are taken in a pass of their own."""
    key, spread = curve_key(df, columns), F.xxhash64(*[F.col(c) for c in df.columns])
    out = df.repartitionByRange(files, key, spread) if files else df.repartitionByRange(key, spread)
    w = out.sortWithinPartitions(key, *columns).write.mode("overwrite")
    if rows_in_group:
        w = w.option("parquet.block.row.count.limit", rows_in_group)
    w.parquet(path)
