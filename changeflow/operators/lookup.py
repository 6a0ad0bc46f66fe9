"""Joining a wide table with one that has at most one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(
    df: DataFrame,
    table: DataFrame,
    left: Sequence[str | Column],
    right: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """``df`` joined with ``table``, whose key columns ``right`` are unique and named unlike any of ``df``.

    A plain equi-join at every size, so the result never depends on it. Spark broadcasts the table if
    it turns out small at run time, and splits the partitions of hot keys of ``df`` (adaptive skew join) if not.
    """
    on = None
    for a, b in zip(left, right):
        a = F.col(a) if isinstance(a, str) else a
        same = a.eqNullSafe(F.col(b)) if null_safe else a == F.col(b)
        on = same if on is None else on & same
    return df.join(table, on, how)
