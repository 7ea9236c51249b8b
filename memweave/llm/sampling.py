"""A bounded, repeatable sample of rows by the hash of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by_hash(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """The rows with the ``rows`` smallest hashes of ``key``.

    Only hashes (8 bytes) are compared between tasks; the rows themselves stay
    where they are and are picked by the threshold found. Rows that share the
    last key all belong to the sample.
    """
    h = F.xxhash64(key)
    cut = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.filter(F.lit(False) if cut is None else h <= F.lit(cut))
