"""Refreshes of all tables, in dependency order.

Landed files that cannot be read are set aside (``rejected``). Streams
(``availableNow``) bring bronze, the change history, the latest poll
and the dimensions up to date with whatever landed since the last run; the
materialised views (snapshot, inactive employees, both summaries) are then
recomputed from them and written clustered by their query keys. When the
run's audit rows show no successful download, nothing is refreshed.

Views are never overwritten: each run writes all of them into a folder of its
own, and the manifest, written last, names the folders that are served. Who
reads through it sees the views of one run, also while the next one runs or
after it failed. A full refresh rebuilds everything from the landing folder in
a new generation (its own tables and checkpoints) beside the served one and
switches the manifest; later refreshes go on in that generation.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quincena.operators import dims, gold, inactive, snapshot
from quincena.operators.audit import updates_gate
from quincena.schemas import SCD2_KEYS, audit_schema, payroll_schema
from quincena.sources.tables import write_view
from quincena.streaming import incremental as inc
from quincena.streaming.quarantine import quarantine
from quincena.streaming.store import VersionedTable

# Default tie-break among events of one (keys, version) in production data:
# newest update time, then file name.
DEFAULT_TIE_BREAK = ["fecha_actualizacion", "archivo"]


SHARED = ("landing", "audit", "manifest")
VIEWS = {"snapshot": ["institution_sp", "status_sp"], "inactive_employees": ["institucion", "estado"],
         "gold_employee": ["id_number"], "gold_position": ["institution_sp", "status_sp"]}


@dataclass(frozen=True)
class Layout:
    """Folders of one deployment, all under one shared root: ``landing``,
    ``audit`` and ``manifest`` directly, all others in a generation's folder."""

    root: str
    generation: int = 0

    def __getattr__(self, name: str) -> str:  # landing, audit, bronze, ... → folder
        if name.startswith("__"):
            raise AttributeError(name)
        root = self.root.rstrip("/")
        return f"{root}/{name}" if name in SHARED else f"{root}/g={self.generation}/{name}"

    def ckpt(self, name: str) -> str:
        return f"{self._checkpoints}/{name}"


class Manifest(VersionedTable):
    """Which folders are served: one row a view, replaced as a whole."""

    def __init__(self, spark: SparkSession, layout: Layout):
        super().__init__(spark, layout.manifest)

    def served(self) -> tuple[int, dict[str, str]]:
        """The generation and the folder of each view (none yet: 0 and none)."""
        rows = self.read()
        found = [] if rows is None else rows.collect()  # one row a view
        return max((r.generation for r in found), default=0), {r.view: r.path for r in found}

    def switch(self, generation: int, paths: dict[str, str]) -> None:
        rows = self.spark.createDataFrame([(v, p, generation) for v, p in paths.items()],
                                          "view string, path string, generation int")
        self.commit(rows.coalesce(1), max(self.committed(), default=-1) + 1)


def served_views(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The views that are served, all of one run."""
    return {view: spark.read.parquet(path) for view, path in Manifest(spark, layout).served()[1].items()}


def refresh(spark: SparkSession, layout: Layout, translations: DataFrame,
            run_audit: DataFrame | None = None, landing_schema: T.StructType | None = None,
            audit_table_schema: T.StructType | None = None, tie_break: list[str] | None = None,
            detected_at: _dt.datetime | None = None, translate: dims.Translate = dims.translate) -> dict:
    """Run the refresh in the served generation; returns the gate row and the output folders.

    ``run_audit`` are the audit rows of the poll run that preceded this
    refresh (the gate counts its ``OK`` rows); without it the refresh runs.
    ``translate`` gives the dimensions their English names: by whole entries
    of the dictionary, or also by its phrases (``names.translate_phrases``).
    """
    if run_audit is not None:
        gate = updates_gate(run_audit).first()
        if not gate["refresh"]:
            return {"updates": gate["updates"], "refreshed": False}
    manifest = Manifest(spark, layout)
    layout = replace(layout, generation=manifest.served()[0])
    return _build(spark, layout, manifest, translations, landing_schema, audit_table_schema, tie_break, detected_at,
                  translate)


def full_refresh(spark: SparkSession, layout: Layout, translations: DataFrame, landing_schema: T.StructType | None = None,
                 audit_table_schema: T.StructType | None = None, tie_break: list[str] | None = None,
                 detected_at: _dt.datetime | None = None, translate: dims.Translate = dims.translate) -> dict:
    """Rebuild everything from the landing and audit folders in a new
    generation and switch to it at the end. What is served stays as it is
    until then, and for good if the rebuild fails; a generation that failed is
    not used again."""
    manifest = Manifest(spark, layout)
    layout = replace(layout, generation=manifest.next_number(layout.root, "g="))
    return _build(spark, layout, manifest, translations, landing_schema, audit_table_schema, tie_break, detected_at,
                  translate)


def _build(spark: SparkSession, layout: Layout, manifest: Manifest, translations: DataFrame, landing_schema,
           audit_table_schema, tie_break, detected_at, translate: dims.Translate) -> dict:
    lschema = landing_schema or payroll_schema()
    aschema = audit_table_schema or audit_schema()
    tb = tie_break or DEFAULT_TIE_BREAK

    quarantine(spark, layout.landing, lschema, layout.rejected, layout.ckpt("quarantine"))
    bschema = inc.ingest_bronze(spark, layout.landing, lschema, layout.bronze, layout.ckpt("bronze"))
    bronze = inc.read_bronze(spark, layout.bronze, bschema)
    inc.update_history(spark, layout.bronze, bronze.schema, layout.scd2_events, layout.scd2_history,
                       layout.ckpt("scd2"), tb)
    inc.update_positions(spark, layout.bronze, bronze.schema, layout.positions, layout.ckpt("positions"))
    inc.update_latest_poll(spark, layout.audit, aschema, layout.latest_poll, layout.ckpt("latest_poll"))
    inc.update_name_dimension(spark, layout.audit, aschema, "institution_name_spanish",
                              "institution_name_english", translations, layout.dim_institution,
                              layout.ckpt("dim_institution"), translate=translate)
    inc.update_name_dimension(spark, layout.audit, aschema, "status_name_spanish", "status_name_english",
                              translations, layout.dim_status, layout.ckpt("dim_status"), translate=translate)

    no_polls = spark.createDataFrame([], aschema)
    snap = snapshot.latest_snapshot(
        bronze,
        VersionedTable(spark, layout.dim_institution).read(schema=dims.dim_institution(no_polls, translations).schema),
        VersionedTable(spark, layout.dim_status).read(schema=dims.dim_status(no_polls, translations).schema),
        inc.read_positions(spark, layout.positions, bronze.schema, translations, translate))
    run = f"{layout.views}/run={manifest.next_number(layout.views, 'run=')}"
    paths = {view: f"{run}/{view}" for view in VIEWS}
    write_view(snap, paths["snapshot"], cluster_by=VIEWS["snapshot"])
    snap = spark.read.parquet(paths["snapshot"])
    history = inc.read_history(spark, layout.scd2_history, bronze.schema, tb)
    made = {"inactive_employees": inactive.inactive_employees(history, snap, detected_at),
            "gold_employee": gold.employee_summary(snap), "gold_position": gold.position_summary(snap)}
    for view, rows in made.items():
        write_view(rows, paths[view], cluster_by=VIEWS[view])
    manifest.switch(layout.generation, paths)
    return {"refreshed": True, **paths, "scd2_history": layout.scd2_history, "keys": SCD2_KEYS}


__all__ = ["Layout", "Manifest", "refresh", "full_refresh", "served_views", "DEFAULT_TIE_BREAK"]
