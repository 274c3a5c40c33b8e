"""Bronze rows: landing records plus derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quincena.functions.columns import composite_key, years_between


def enrich(landing: DataFrame) -> DataFrame:
    """Add ``composite_key`` and ``antiguedad`` (tenure in years at the
    report's update time). No filters: bronze keeps every row."""
    return landing.withColumns({
        "composite_key": composite_key(),
        "antiguedad": years_between("fecha_actualizacion", "fecha_de_inicio"),
    })
