"""Change-data capture: latest row per key (type 1) and change history with
validity intervals (type 2), as batch functions over an event table, and the
step that folds new events into a history that is already there.

The type-2 functions are gaps and islands over one ordering: rows are dealt
and sorted once, by key, sequence and tie-break, and everything else (which
event of a sequence counts, where a version opens, where it ends) is read off
neighbouring rows by windows that share that order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

START_AT = "__START_AT"
END_AT = "__END_AT"


def _latest(order_cols: list[str], payload: list[str]) -> Column:
    """Struct whose max is the row with the greatest ``order_cols`` (then
    greatest payload, so ties resolve deterministically)."""
    return F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                          F.struct(*[F.col(c) for c in payload]).alias("_row")))


def scd1_latest(events: DataFrame, keys: list[str], sequence_by: str,
                tie_break: list[str] | None = None) -> DataFrame:
    """One row per key: the event with the greatest ``sequence_by`` (then
    ``tie_break`` columns). Keys compare NULL-safely. Order-free, so it is
    also the incremental reducer: ``scd1_latest(target ∪ batch)``."""
    payload = [c for c in events.columns if c not in keys]
    order = [sequence_by] + list(tie_break or [])
    g = events.groupBy(*keys).agg(_latest(order, payload).alias("_m"))
    return g.select(*keys, *[F.col("_m._row")[c].alias(c) for c in payload])


def dedupe_events(events: DataFrame, keys: list[str], sequence_by: str, tie_break: list[str]) -> DataFrame:
    """One event per (keys, sequence): greatest ``tie_break`` columns win."""
    payload = [c for c in events.columns if c not in keys and c != sequence_by]
    g = events.groupBy(*keys, sequence_by).agg(_latest(tie_break, payload).alias("_m"))
    return g.select(*keys, sequence_by, *[F.col("_m._row")[c].alias(c) for c in payload])


def scd2_history(events: DataFrame, keys: list[str], sequence_by: str, track: list[str],
                 tie_break: list[str], reduce_first: bool = False) -> DataFrame:
    """Type-2 history.

    1. one event per (keys, sequence), greatest ``tie_break`` wins (of equal
       ones the greatest other columns);
    2. per key in sequence order an event opens a version when it is the
       first or any tracked column IS DISTINCT FROM the previous event;
    3. per version: ``__START_AT`` = first sequence, all other columns from
       its last event (untracked changes update in place), ``__END_AT`` =
       next version's start (NULL while open).

    One exchange and one sort. Windows spill, so a key with very many events
    costs time in its task, not memory; where one (key, sequence) repeats
    very often, ``reduce_first`` reduces events on the map side before that
    exchange, at the price of one more."""
    if reduce_first:
        events = dedupe_events(events, keys, sequence_by, tie_break)
    return _versions(events.withColumn(START_AT, F.col(sequence_by)),
                     keys, sequence_by, track, tie_break)


# Columns of dealt rows: the share of their partition that they fall to, and a hash of the keys.
SHARE, HASH = "_share", "_hash"
SHARES = 1024


def dealt(rows: DataFrame, keys: list[str], part_col: str) -> DataFrame:
    """``rows`` dealt once for all that follows: those of a key are together,
    as windows need them, and each task holds few values of ``part_col`` (a
    key), so that it can write partition folders without another exchange.

    Rows are ranged by partition value and share, one of many that a hash of
    the keys deals them to, so a hot value spreads over tasks. The hash is a
    column, too: rows sort by it first, which is a sort of numbers."""
    share = F.pmod(F.xxhash64(*keys), F.lit(SHARES)).cast("int")
    return rows.withColumn(SHARE, share).repartitionByRange(part_col, SHARE).withColumn(HASH, F.xxhash64(*keys))


def scd2_fold(open_versions: DataFrame, events: DataFrame, keys: list[str], sequence_by: str, track: list[str],
              tie_break: list[str], part_col: str | None = None) -> DataFrame:
    """What becomes of ``open_versions`` (open history rows: they carry their
    key's last event) when ``events`` come after them: the versions that
    close, with ``__END_AT``, and the open ones. Every event must have a
    greater sequence than its key's open version; nothing older is read.
    With ``part_col`` rows are left as :func:`dealt` deals."""
    since = open_versions.drop(END_AT)
    added = events.withColumn(START_AT, F.col(sequence_by)).select(*since.columns)
    rows = since.unionByName(added)
    if part_col is None:
        return _versions(rows, keys, sequence_by, track, tie_break)
    return _versions(dealt(rows, keys, part_col), keys, sequence_by, track, tie_break, [HASH, SHARE]).drop(HASH, SHARE)


# Where a row of a mended history comes from.
WAS_OPEN, WAS_CLOSED, LOGGED, NEW = range(4)


def _lateness(kind: str, sequence_by: str) -> dict[str, Column]:
    """What tells whether a key has events not after its open version's last
    one (NULL is after nothing, and nothing is after NULL)."""
    was_open, new, at = F.col(kind) == WAS_OPEN, F.col(kind) == NEW, F.col(sequence_by)
    return {"_has_open": F.max(was_open), "_has_new": F.max(new), "_seen": F.max(F.when(was_open, at)),
            "_added": F.min(F.when(new, at)), "_unplaced": F.max(new & at.isNull())}


def _is_late() -> Column:
    after = F.coalesce(F.col("_added") > F.col("_seen"), F.lit(False))
    return F.col("_has_open") & F.col("_has_new") & (F.col("_unplaced") | ~after)


def late_places(open_versions: DataFrame, events: DataFrame, keys: list[str], sequence_by: str, part_col: str) -> DataFrame:
    """Values of ``part_col`` (a key) in which ``events`` may be late: not
    after their key's open version. First whole values are judged, then, where
    any event is not after all open versions, the keys, by a 64-bit hash."""
    def told(rows: DataFrame, *by: str) -> DataFrame:
        flags = _lateness("_kind", sequence_by)
        return rows.groupBy(*by).agg(*[f.alias(name) for name, f in flags.items()]).where(_is_late()).select(*by)

    rows = reduce(DataFrame.unionByName, [
        side.select(part_col, F.xxhash64(*keys).alias(HASH), sequence_by, F.lit(kind).alias("_kind"))
        for side, kind in ((open_versions, WAS_OPEN), (events, NEW))])
    # NULLs make a value's own greatest or least time no bound of the others.
    unsure = rows.where(F.col(sequence_by).isNull()).select(part_col).union(told(rows, part_col)).distinct()
    some = unsure.select(F.col(part_col).alias("_part"))
    return told(rows.join(F.broadcast(some), F.col(part_col).eqNullSafe(F.col("_part")), "left_semi"),
                part_col, HASH).select(part_col).distinct()


def scd2_mend(open_versions: DataFrame, closed: DataFrame, logged: DataFrame, events: DataFrame, keys: list[str],
              sequence_by: str, track: list[str], tie_break: list[str], part_col: str) -> DataFrame:
    """History rows after ``events`` some of which may be late: keys with late
    events are made anew from ``logged``, the older events, and ``events``;
    for others ``events`` are folded into ``open_versions`` and ``closed``
    rows stay as they are.

    All rows are dealt and sorted once; what a
    key needs is told by a window over its rows, and the windows that make
    versions share the order."""
    columns = closed.columns

    def of_kind(rows: DataFrame, kind: int) -> DataFrame:
        if END_AT not in rows.columns:
            rows = rows.withColumn(START_AT, F.col(sequence_by)).withColumn(END_AT, F.lit(None).cast(closed.schema[END_AT].dataType))
        return rows.select(*columns).withColumn("_kind", F.lit(kind))

    sources = ((open_versions, WAS_OPEN), (closed, WAS_CLOSED), (logged, LOGGED), (events, NEW))
    rows = reduce(DataFrame.unionByName, [of_kind(*source) for source in sources])
    # Closed rows form windows of their own, which change nothing but __END_AT.
    rows = dealt(rows.withColumnRenamed(END_AT, "_ended"), keys, part_col).withColumn(
        "_stays", F.col("_kind") == WAS_CLOSED)
    by = [HASH, SHARE, "_stays"]
    rows = rows.sortWithinPartitions(HASH, SHARE, *keys, "_stays", *_order(rows, keys, sequence_by, tie_break, by))
    key, flags = Window.partitionBy(HASH, SHARE, *keys), _lateness("_kind", sequence_by)
    told = rows.withColumns({name: f.over(key) for name, f in flags.items()})
    used = told.where(F.when(_is_late(), F.col("_kind").isin(LOGGED, NEW)).otherwise(F.col("_kind") != LOGGED)).drop(*flags)
    made = _versions(used, keys, sequence_by, track, tie_break, by)
    return made.withColumn(END_AT, F.when(F.col("_stays"), F.col("_ended")).otherwise(F.col(END_AT))).select(*columns)


def _order(rows: DataFrame, keys: list[str], sequence_by: str, tie_break: list[str], by: list[str]) -> list[str]:
    """Of one key's rows: by sequence, then tie-break, then all other columns."""
    others = [c for c in rows.columns if c not in (*keys, *tie_break, *by, START_AT, sequence_by)]
    return [sequence_by, *tie_break, *others]


def _window(rows: DataFrame, keys: list[str], sequence_by: str, tie_break: list[str], by: list[str]) -> WindowSpec:
    dealt_by = [c for c in by if c in (HASH, SHARE)]
    return Window.partitionBy(*dealt_by, *keys, *[c for c in by if c not in dealt_by]).orderBy(
        *_order(rows, keys, sequence_by, tie_break, by))


def _last_of_sequence(rows: DataFrame, w: WindowSpec, sequence_by: str) -> DataFrame:
    another = F.lead(F.lit(True)).over(w).isNotNull()
    last = ~another | ~F.lead(sequence_by).over(w).eqNullSafe(F.col(sequence_by))
    return rows.withColumn("_last", last).where("_last").drop("_last")


def _versions(rows: DataFrame, keys: list[str], sequence_by: str, track: list[str], tie_break: list[str],
              by: list[str] | None = None) -> DataFrame:
    """Versions from events; ``__START_AT`` is where a row that opens a version
    opens it (its own sequence, or for an open version its start). Columns
    ``by`` part the rows beside the keys."""
    payload = [c for c in rows.columns if c not in keys and c != START_AT]
    w = _window(rows, keys, sequence_by, tie_break, by or [])
    kept = _last_of_sequence(rows, w, sequence_by)
    changed = F.lag(F.lit(True)).over(w).isNull()
    for c in track:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    flagged = kept.withColumn("_opens", changed)
    opened = F.when(F.col("_opens"), F.struct(F.col(START_AT).alias("at")))
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = flagged.select(
        *keys, *payload, F.last(opened, ignorenulls=True).over(so_far)["at"].alias(START_AT),
        F.lead(sequence_by).over(w).alias(END_AT), F.coalesce(F.lead("_opens").over(w), F.lit(True)).alias("_closes"))
    return ended.where("_closes").drop("_closes")


def scd2_current(history: DataFrame) -> DataFrame:
    """Open versions only."""
    return history.where(F.col(END_AT).isNull())
