"""Spreading CPU-heavy per-row work over the cluster's cores."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from memweave.functions.sizing import estimated_bytes


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-repartition ``df`` when its estimated size gives fewer scan splits than the cluster has cores.

    A small file (one parquet row group) is read by one task; regex,
    chunking and embedding of its rows would then use one core. Inputs of
    ``maxPartitionBytes`` per core and more are left as they are, so no
    shuffle is added where the scan already spreads the rows. The size is the
    planner's estimate: nothing is executed to find it. Hashing by the row id
    keeps the placement deterministic for task retries.
    """
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    split = int(str(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))
    if estimated_bytes(df) >= target * split:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """An Arrow batch in pieces, so that no more than ``rows`` rows of it are Python objects at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
