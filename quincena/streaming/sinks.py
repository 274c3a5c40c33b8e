"""``foreachBatch`` appliers that keep targets equal to the batch functions
applied to everything seen so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quincena.operators import cdc, dims
from quincena.streaming.store import (CLOSED, MENDED_CLOSED, MENDED_OPEN, OPEN, STATE, STATES_CLOSED, STATES_OPEN,
                                      AppendedTable, HistoryVersions, PartitionedVersions, VersionedTable)


def scd1_sink(store: VersionedTable, keys: list[str], sequence_by: str, tie_break: list[str] | None = None):
    """Latest row per key: reduce (current target ∪ batch) with the batch
    reducer. Order-free, so late and replayed rows are safe."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        version = store.version_of(batch_id)
        old = store.read(before=version)
        rows = batch if old is None else old.unionByName(batch.select(*old.columns))
        store.commit(cdc.scd1_latest(rows, keys, sequence_by, tie_break), version)
    return apply


def scd2_sink(events: PartitionedVersions, history: HistoryVersions, late: PartitionedVersions, keys: list[str],
              sequence_by: str, track: list[str], tie_break: list[str]):
    """Type-2 history by folding, right under late data.

    A key's open version carries its last event, so events that come after it
    are folded into it and nothing older is read: a batch in order costs what
    it brings and the open rows of the partitions (institutions) it touches,
    however long the log is.

    A late event (at or before its key's last one) may split a version that
    has long closed. So an append-only event log is kept as well, and the keys
    with late events, and only these, are made anew from it; the closed rows
    of their partitions are then written whole. All of a batch's results are
    one version of ``history``, committed together; the log's and the late
    partitions' versions carry the same number, and a replayed batch overwrites its
    own. Keys compare NULL-safely.

    Whole rows move once, to make versions: they are dealt by partition and a
    share of its keys, so that they are written where they are. The log takes
    events as they come, from the tasks that read them; which event of a
    sequence counts is told as versions are made.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        version = history.version_of(batch_id)
        part = history.part_col
        events.commit(batch, version, dealt=True)
        folders = events.folders(version)
        new = events.read_version(batch.schema, version)
        empty = cdc.scd2_history(new.limit(0), keys, sequence_by, track, tie_break)
        opened = history.read(empty.schema, before=version, folders=folders, states=STATES_OPEN)
        mended: list[str] = []
        if opened is not None:
            places = cdc.late_places(opened, new, keys, sequence_by, part)
            late.commit(places, version, keep=2)
            mended = late.folders(version)
        if not mended:
            base = empty.limit(0) if opened is None else opened
            rows = cdc.scd2_fold(base, new, keys, sequence_by, track, tie_break, part)
            history.commit(_with_state(rows), version, dealt=True)
            return
        logged = events.read_all(new.schema, upto=version - 1, folders=mended)
        closed = history.read(empty.schema, before=version, folders=mended, states=STATES_CLOSED)
        rows = cdc.scd2_mend(opened, closed, logged, new, keys, sequence_by, track, tie_break, part)
        # A folder is mended as a whole; '' and NULL share one.
        place = F.coalesce(F.col(part).cast("string"), F.lit(""))
        found = late.read_version(places.schema, version).select(place.alias("_place")).distinct()
        rows = rows.join(F.broadcast(found.withColumn("_mended", F.lit(True))), place == F.col("_place"), "left").drop("_place")
        history.commit(_with_state(rows, F.col("_mended")).drop("_mended"), version, dealt=True)
    return apply


def _with_state(rows: DataFrame, mended: Column | None = None) -> DataFrame:
    opened = F.col(cdc.END_AT).isNull()
    state = F.when(opened, F.lit(OPEN)).otherwise(F.lit(CLOSED))
    if mended is not None:
        state = F.when(mended, F.when(opened, F.lit(MENDED_OPEN)).otherwise(F.lit(MENDED_CLOSED))).otherwise(state)
    return rows.withColumn(STATE, state)


def dimension_sink(store: VersionedTable, name_col: str, translations: DataFrame, out_col: str,
                   translate: dims.Translate = dims.translate):
    """Complete-mode aggregate → translated dimension, replaced per batch."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        store.commit(translate(batch, name_col, translations, out_col), store.version_of(batch_id))
    return apply


def novelty_sink(store: AppendedTable):
    """Append-only positions: those of the batch that the target does not hold
    yet are added, with the earliest time of that batch (frozen from then on).

    The batch is reduced to one row a position before it meets the target's
    names, and only new names are written. A streaming ``dropDuplicates`` would
    keep any row's time of a batch, and its state would hold what the target
    holds already. A replayed batch meets the versions before its own and
    overwrites its own."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        version = store.version_of(batch_id)
        seen = dims.new_positions(batch)
        old = store.read(before=version, schema=seen.schema)
        store.commit(seen.join(old.select("position_name_spanish"), "position_name_spanish", "left_anti")
                     .hint("rebalance"), version)
    return apply
