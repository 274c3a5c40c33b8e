"""Join helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def null_safe_condition(left: DataFrame, right: DataFrame, keys: list[str], right_prefix: str = "") -> Column:
    """``l.k1 <=> r.k1 AND ...``; Spark still plans it as a hash join."""
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[right_prefix + k])
        cond = c if cond is None else cond & c
    return cond
