"""Latest snapshot: bronze rows whose data version is the newest OK version
of both their institution and their status, with English names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.schemas import SNAPSHOT, SNAPSHOT_ENGLISH

def latest_snapshot(bronze: DataFrame, dim_inst: DataFrame, dim_stat: DataFrame,
                    dim_pos: DataFrame, prune_versions: bool = True) -> DataFrame:
    """Version-gated snapshot.

    An institution whose rows are not at its newest OK version, or a status
    whose newest OK version is elsewhere, contributes nothing (inner joins on
    name *and* version). Positions join left: unknown positions keep NULL
    English names.

    With ``prune_versions`` the bronze scan also gets the versions that are
    current in both dimensions, as scalar subqueries over them (one row per
    name): their minimum, which reaches the Parquet reader, and the set itself
    (at most one version a name), which prunes version folders of a
    version-partitioned bronze. It never changes the result: every surviving
    row equals a current version of both its institution and its status.
    """
    inst = dim_inst.select(
        F.col("institution_name_spanish").alias("_inst"),
        F.col("last_source_update").alias("_inst_version"), "institution_name_english")
    stat = dim_stat.select(
        F.col("status_name_spanish").alias("_stat"),
        F.col("last_source_update").alias("_stat_version"), "status_name_english")
    pos = dim_pos.select(F.col("position_name_spanish").alias("_pos"), "position_name_english")

    b = bronze
    if prune_versions:
        v = F.col("fecha_consulta")
        both = inst.select(F.col("_inst_version").alias("_v")).distinct().join(
            stat.select(F.col("_stat_version").alias("_v")).distinct(), "_v")
        b = b.where((v >= both.agg(F.min("_v")).scalar()) & F.array_contains(both.agg(F.collect_set("_v")).scalar(), v))
    j = (b.join(inst,
                (F.col("institucion") == F.col("_inst")) & (F.col("fecha_consulta") == F.col("_inst_version")))
          .join(stat,
                (F.col("estado") == F.col("_stat")) & (F.col("fecha_consulta") == F.col("_stat_version")))
          .join(pos, F.col("cargo") == F.col("_pos"), "left"))
    return j.select(*[F.col(c).alias(name) for name, c in {**SNAPSHOT, **SNAPSHOT_ENGLISH}.items()])
