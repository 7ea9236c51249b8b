"""Blocks of bounded size on both sides of a pairing, for joins that score every left row against every right row of a group.

Rows of one group (equal ``by`` values) are dealt by a hash into blocks of about
a given number of rows, so a group that holds a third of a table makes more
blocks, not a larger one. A row is copied once for each block of the
other side, and a pair of blocks is one task's work: the scans do not grow
with the number of pairs, and nothing passes the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memweave.functions.sizing import broadcast_if_small
from memweave.session import materialize

#: Block numbers of both sides.
LEFT, RIGHT = "_left_block", "_right_block"


def pair_blocks(left: DataFrame, right: DataFrame, by: Sequence[str], *, left_hash: Sequence[Column], right_hash: Sequence[Column],
                left_rows: int, right_rows: int, work: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """Union of ``work(left block, right block)`` over all pairs of blocks with equal ``by`` columns (null equals null).

    ``work`` may be called with an empty table for a side that has no rows there.
    """
    by = list(by)
    sizes = materialize(
        left.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(left_rows)).alias("_n_left")).alias("l").join(
            right.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(right_rows)).alias("_n_right")).alias("r"),
            _same(by, "l", "r")).select(*[F.col(f"l.{c}").alias(f"_by{k}") for k, c in enumerate(by)], "_n_left", "_n_right"), "block-sizes")
    sizes = broadcast_if_small(sizes)

    def dealt(df: DataFrame, hashed: Sequence[Column], own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        match = F.lit(True)
        for k, c in enumerate(by):
            match = match & F.col(c).eqNullSafe(F.col(f"_by{k}"))
        cols = [F.col(c).alias(c) for c in df.columns]  # both sides may stem from one table: identities of their own
        out = df.select(*cols).join(sizes, match).withColumn(own[0], F.pmod(F.xxhash64(*hashed), F.col(own[1])))
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other[1]) - 1))
        return out.withColumn(other[0], copies).select(*df.columns, LEFT, RIGHT)

    keys = [*by, LEFT, RIGHT]
    a = dealt(left, left_hash, (LEFT, "_n_left"), (RIGHT, "_n_right"))
    b = dealt(right, right_hash, (RIGHT, "_n_right"), (LEFT, "_n_left"))
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(work, schema)


def _same(by: Sequence[str], a: str, b: str) -> Column:
    out = F.lit(True)
    for c in by:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out
