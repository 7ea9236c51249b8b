"""Session helpers.

Library functions never change session settings; only ``build_session`` (used
by tests and ``bench.py``) does. The checkpoint folder is read from the
session (``spark.checkpoint.dir``) and only set where it is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", app: str = "memweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) do we pick a fresh scratch folder. On a cluster a folder of
    the driver's own would be lost on the executors, so there an unset
    ``spark.checkpoint.dir`` is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if conf_dir:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="memweave-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


#: Scratch folders handed out, by application.
_SCRATCH: dict[str, list[str]] = {}


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this application was handed; returns their number.

    For a caller that is done with all results: DataFrames that still read
    written intermediate tables fail afterwards.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def materialize(df, name: str = "table", compression: str | None = None, partition_by: list[str] | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan only once (an
    eager checkpoint of an unpersisted plan computes it twice: once for the
    count, once for the files). The folder is shared, so a lost executor
    does not lose the data. ``compression`` is a Parquet codec (by default the
    session's); wide text rows take ``zstd``. ``partition_by`` puts the rows of
    each value of a few into files of their own.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("errorifexists").parquet(path, partitionBy=partition_by, compression=compression)
    # partitioned and without rows there is no file to take the columns from
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)
