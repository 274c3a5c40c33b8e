"""Dimension tables: institutions, statuses (newest OK data version per
name) and positions (first time seen), each with an English name taken from
a translation dictionary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.schemas import RUN_OK

# (rows, name column, dictionary, column to add) → rows with English names.
Translate = Callable[[DataFrame, str, DataFrame, str], DataFrame]


def translate(df: DataFrame, name_col: str, translations: DataFrame, out_col: str) -> DataFrame:
    """Left join a ``(spanish, english)`` dictionary; unknown names get NULL.
    The dictionary is reduced to one entry per name first so the join can
    never fan out. ``names.translate_phrases`` goes on to names made of phrases."""
    d = (translations.where(F.col("spanish").isNotNull())
         .groupBy(F.col("spanish").alias(name_col)).agg(F.min("english").alias(out_col)))
    return df.join(d, on=name_col, how="left")


def latest_ok_version(audit: DataFrame, name_col: str) -> DataFrame:
    """Newest data version and check time among successful polls, per name.
    A partial (map-side) max runs before the shuffle, so a name holding a
    large share of the polls costs one row per map task."""
    return (audit.where(F.col("run_status") == RUN_OK)
            .groupBy(name_col)
            .agg(F.max("source_update").alias("last_source_update"),
                 F.max("checked_at").alias("last_checked_at")))


def dim_institution(audit: DataFrame, translations: DataFrame, by: Translate = translate) -> DataFrame:
    g = latest_ok_version(audit, "institution_name_spanish")
    return by(g, "institution_name_spanish", translations, "institution_name_english")


def dim_status(audit: DataFrame, translations: DataFrame, by: Translate = translate) -> DataFrame:
    g = latest_ok_version(audit, "status_name_spanish")
    return by(g, "status_name_spanish", translations, "status_name_english")


def new_positions(bronze: DataFrame) -> DataFrame:
    """Distinct non-NULL positions with the earliest update time seen."""
    return (bronze.where(F.col("cargo").isNotNull())
            .groupBy(F.col("cargo").alias("position_name_spanish"))
            .agg(F.min("fecha_actualizacion").alias("last_seen_at")))


def dim_position(bronze: DataFrame, translations: DataFrame, existing: DataFrame | None = None,
                 by: Translate = translate) -> DataFrame:
    """Position dimension. With ``existing`` (the current dimension) only
    positions not yet in it are returned (append-only novelty)."""
    pos = new_positions(bronze)
    if existing is not None:
        pos = pos.join(existing.select("position_name_spanish"), "position_name_spanish", "left_anti")
    return by(pos, "position_name_spanish", translations, "position_name_english")
