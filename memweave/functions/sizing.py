"""Size checks before broadcasting, by bytes and without running anything.

The planner's own size estimate of a side (file sizes and row widths) is read
from its optimised plan. Up to ``BROADCAST_BYTES`` the side is broadcast; above,
or where the estimate is unknown and hence huge, the join is left to the
planner (sort-merge / shuffled hash, re-planned by AQE from real sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Estimates count compressed file bytes, so this leaves room for rows that are several times larger in memory.
BROADCAST_BYTES = 16 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate of ``df``; no job is started."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return estimated_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES, *, known_small: bool | None = None) -> DataFrame:
    """Hint a broadcast only when the estimate is within ``max_bytes``.

    ``known_small`` passes a verdict already established by the caller for the
    table this one derives from.
    """
    small = known_small if known_small is not None else is_small(df, max_bytes)
    return F.broadcast(df) if small else df


def rows_for_keys(big: DataFrame, keys: DataFrame, key_cols: list[str], *, small: bool) -> DataFrame:
    """Rows of a large table for a bounded set of keys.

    With ``small`` the keys are broadcast into a semi-join, so the large table
    is filtered inside its scan stage instead of being shuffled or broadcast.
    """
    k = keys.select(*key_cols).distinct()
    return big.join(F.broadcast(k) if small else k, key_cols, "left_semi")
