"""Parquet table access for the driver-provided data sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; column pruning and filter pushdown reach this scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_source(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str | None]:
    """(folder, file-name filter) under which a file stream finds a table's files.

    A table is one file or a folder of part files: a folder is its own source,
    a file is picked by its name from the folder that holds it.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isDirectory():
        return path.toString(), None
    return sf_dir, path.getName()
