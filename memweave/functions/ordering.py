"""Order-dependent numbering that does not put a hot group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from memweave.session import materialize


def running_total(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], value_col: str | None,
                  total_col: str, num_partitions: int | None = None) -> DataFrame:
    """Sum of ``value_col`` (rows if None) over the rows of the group that come before, in ``order_cols`` order.

    Rows are range-partitioned on (group, order) and written once together with
    the number of their partition, so a group that holds a third of the data
    spreads over many tasks, and the rows and the per-partition sums are read
    from the same files. Each task adds up its own slice; the sums, one row
    for each (group, partition), give every slice its offset. Null group
    values form a group of their own.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_cols, order_cols = list(group_cols), list(order_cols)
    value = F.lit(1) if value_col is None else F.col(value_col)
    ranged = materialize(df.repartitionByRange(n, *group_cols, *order_cols).withColumn("_rt_pid", F.spark_partition_id()), "ranged")
    before = Window.partitionBy(*group_cols, "_rt_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_rt_local", F.coalesce(F.sum(value).over(before), F.lit(0)))
    sums = ranged.groupBy(*group_cols, "_rt_pid").agg(F.sum(value).alias("_rt_n"))
    earlier = Window.partitionBy(*group_cols).orderBy("_rt_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*[F.col(c).alias(f"_rt_g{k}") for k, c in enumerate(group_cols)], F.col("_rt_pid").alias("_rt_p"),
                          F.coalesce(F.sum("_rt_n").over(earlier), F.lit(0)).alias("_rt_off"))
    same = F.col("_rt_pid") == F.col("_rt_p")
    for k, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_rt_g{k}"))
    out = local.join(offsets, same).withColumn(total_col, (F.col("_rt_off") + F.col("_rt_local")).cast("bigint"))
    return out.drop("_rt_pid", "_rt_local", "_rt_off", "_rt_p", *[f"_rt_g{k}" for k in range(len(group_cols))])


def dense_index(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], index_col: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row within its group, in ``order_cols`` order."""
    return running_total(df, group_cols, order_cols, None, index_col, num_partitions)
