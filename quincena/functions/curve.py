"""Space-filling curve key: rows that are near in several columns at once get
near keys, so files cut along the key have narrow ranges in each column, and a
filter on any of them skips row groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6        # a column: 64 ranges
SAMPLED = 4096  # rows from which the ranges are taken


def range_bounds(df: DataFrame, columns: list[str], bits: int = BITS, sampled: int = SAMPLED) -> dict[str, list]:
    """For each column up to ``2**bits - 1`` ascending values that cut it into
    ranges of about equal rows. From the ``sampled`` rows of least hash: a
    partial top-k, so one pass and a bounded collect. They say only where rows
    lie, never which rows there are."""
    rows = df.select(*columns).orderBy(F.xxhash64(F.monotonically_increasing_id())).limit(sampled).collect()
    out = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        cuts = (values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)) if values else ()
        out[c] = list(dict.fromkeys(cuts))
    return out


def range_number(column: Column, bounds: list, kind) -> Column:
    """How many of the ascending ``bounds`` are at most the value, by halving;
    NULL counts as the least."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        return F.when(column >= F.lit(bounds[middle]).cast(kind), search(middle + 1, hi)).otherwise(search(lo, middle))

    return search(0, len(bounds))


def curve_key(df: DataFrame, columns: list[str], bits: int = BITS, sampled: int = SAMPLED) -> Column:
    """The bits of the columns' range numbers, interleaved from the highest on."""
    bounds = range_bounds(df, columns, bits, sampled)
    numbers = [range_number(F.col(c), bounds[c], df.schema[c].dataType) for c in columns]
    key = F.lit(0)
    for bit in range(bits):
        for i, number in enumerate(reversed(numbers)):
            taken = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(taken, bit * len(columns) + i))
    return key
