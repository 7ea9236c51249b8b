"""A persisted collection: versioned, bucketed Parquet with snapshot reads.

Rows live under ``versions/version=<id>/collection=/namespace=/bucket=``; the
bucket is a hash of the key, so a namespace that holds most rows is many
folders. A manifest (a small table) names, for each bucket, the version that
holds its rows, and a numbered commit file names the manifest. A mutation

1. reads the buckets that its batch touches (the others are pruned),
2. writes their new rows as one new version; no file is ever overwritten, so
   nothing has to be staged although the new rows are computed from the old,
3. writes the new manifest, and last
4. publishes the commit file by a rename that fails if the number is taken.

A reader sees the snapshot of one commit, whole. A failure before step 4 leaves
the old snapshot current and only files that no manifest names; ``vacuum``
removes those. Two writers of one commit number: the later one gets a
``StoreConflict`` (atomic where the file system's rename is, as on HDFS).

A null or empty collection or namespace is stored as the Hive default partition
and reads back as ``''``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memweave.functions.sizing import broadcast_if_small
from memweave.operators import collections as C
from memweave.session import materialize

PARTITION_COLS = ["collection", "namespace"]
BUCKET_COLS = [*PARTITION_COLS, "bucket"]

#: Buckets of a namespace; at scale choose it so that a bucket of the largest namespace is about one input split.
DEFAULT_BUCKETS = 8

# Spark writes an empty partition value as the Hive default partition and
# reads it back as NULL; the default namespace is ''.
_DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"

SCHEMA_FILE = "_schema.json"

_MANIFEST_SCHEMA = "collection string, namespace string, bucket int, version string, n_rows long"


class StoreConflict(RuntimeError):
    """Another writer published the commit first; read the new snapshot and apply the mutation again."""


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs_path(spark, path)
    fs.delete(p, True)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in PARTITION_COLS})


class _Store:
    """Paths, schema and bucket count of one store; ``number`` is the commit that is read."""

    def __init__(self, spark: SparkSession, path: str, number: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        meta = json.loads(_read_text(spark, f"{self.path}/{SCHEMA_FILE}"))
        self.buckets, self.columns = meta["buckets"], meta["columns"]
        self.schema = T.StructType.fromJson(meta["schema"])
        published = versions(spark, self.path)
        self.number = published[-1] if number is None and published else number
        if self.number is not None and self.number not in published:
            raise ValueError(f"store {path} has no version {self.number}")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")

    def version_root(self, version: str) -> str:
        return f"{self.path}/versions/version={version}"

    def manifest(self) -> DataFrame:
        if self.number is None:
            return self.spark.createDataFrame([], _MANIFEST_SCHEMA)
        version = _read_text(self.spark, f"{self.path}/_commits/{self.number:012d}").strip()
        return self.spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{self.path}/_manifests/{version}")

    def files(self, held: list[str]) -> DataFrame:
        """All rows of the named versions with their bucket columns, dead buckets included."""
        if not held:
            return self.spark.createDataFrame([], self.schema)
        roots = [self.version_root(v) for v in held]
        return _named(self.spark.read.schema(self.schema).option("basePath", f"{self.path}/versions").parquet(*roots))

    def rows(self, touched: DataFrame | None = None) -> DataFrame:
        """Rows of the snapshot; with ``touched`` (bucket columns) those of its buckets only.

        Only the folders of versions that still hold something are listed; the
        semi-join with the manifest prunes partitions at run time.
        """
        live = self.manifest()
        if touched is not None:
            live = live.join(broadcast_if_small(touched), BUCKET_COLS, "left_semi")
        held = sorted(r["version"] for r in live.select("version").distinct().collect())  # one name a version
        # The comparison marks the manifest as selective, which partition pruning asks for.
        live = live.filter(F.col("n_rows") > 0).select(*BUCKET_COLS, "version")
        return self.files(held).join(broadcast_if_small(live), [*BUCKET_COLS, "version"], "left_semi")

    def touched(self, batch: DataFrame) -> DataFrame:
        """Written table of the buckets that hold, or would hold, the batch's keys."""
        return materialize(_named(batch).select(*PARTITION_COLS, self.bucket().alias("bucket")).distinct(), "touched")

    def commit(self, new_rows: DataFrame, touched: DataFrame | None) -> int:
        """Replace the touched buckets by ``new_rows``; returns the number of the new commit."""
        number = 1 if self.number is None else self.number + 1
        version = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        out = _named(new_rows).select(*self.columns).withColumn("bucket", self.bucket())
        # Rebalancing gives a bucket few files, and several tasks where it is large.
        out.hint("rebalance", *BUCKET_COLS).write.partitionBy(*BUCKET_COLS).parquet(self.version_root(version))
        manifest = (self.files([version]).groupBy(*BUCKET_COLS, "version")
                    .agg(F.count(F.lit(1)).alias("n_rows")))
        if touched is not None:
            kept = self.manifest().join(broadcast_if_small(touched), BUCKET_COLS, "left_anti")
            manifest = kept.unionByName(manifest)
        manifest.write.parquet(f"{self.path}/_manifests/{version}")
        _publish(self.spark, self.path, number, version)
        return number


def _publish(spark: SparkSession, path: str, number: int, version: str) -> None:
    draft, final = f"{path}/_commits/.{version}", f"{path}/_commits/{number:012d}"
    _write_text(spark, draft, version)
    src, fs = _fs_path(spark, draft)
    dst, _ = _fs_path(spark, final)
    if fs.exists(dst) or not fs.rename(src, dst):
        fs.delete(src, False)
        raise StoreConflict(f"commit {number} of {path} was published by another writer")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published commit numbers that can be read, ascending."""
    return sorted(int(n) for n in _names(spark, f"{path.rstrip('/')}/_commits") if n.isdigit())


def read_state(spark: SparkSession, path: str, *, version: int | None = None) -> DataFrame:
    """The store as of its last commit, or as of commit ``version``.

    The schema comes from the store's schema file, so an emptied store still
    reads, and partition values such as ``007`` are not type-inferred into numbers.
    """
    store = _Store(spark, path, version)
    return store.rows().select(*store.columns)


def live_buckets(spark: SparkSession, path: str, *, version: int | None = None) -> DataFrame:
    """The manifest: collection, namespace, bucket, the version that holds it, its rows (no data file is read)."""
    return _Store(spark, path, version).manifest()


def create_state(df: DataFrame, path: str, *, buckets: int = DEFAULT_BUCKETS) -> None:
    """Make a store of ``df`` (columns collection, namespace, key and any others); an existing one is an error."""
    spark, path = df.sparkSession, path.rstrip("/")
    p, fs = _fs_path(spark, f"{path}/{SCHEMA_FILE}")
    if fs.exists(p):
        raise FileExistsError(f"store {path} exists")
    if clash := {"bucket", "version"} & set(df.columns):
        raise ValueError(f"reserved column names: {sorted(clash)}")
    fields = [f for f in df.schema.fields if f.name not in PARTITION_COLS]
    layout = [T.StructField("version", T.StringType()), *(T.StructField(c, T.StringType()) for c in PARTITION_COLS),
              T.StructField("bucket", T.IntegerType())]
    meta = {"buckets": buckets, "columns": df.columns, "schema": T.StructType(fields + layout).jsonValue()}
    _write_text(spark, f"{path}/{SCHEMA_FILE}", json.dumps(meta))
    _Store(spark, path).commit(df, None)


def apply_upsert(spark: SparkSession, path: str, batch: DataFrame, *, seq_col: str = "seq") -> None:
    """U1 on disk: rewrite the touched buckets with the batch applied."""
    store, batch = _Store(spark, path), _named(batch)
    touched = store.touched(batch)
    if touched.isEmpty():
        return
    state = store.rows(touched).select(*store.columns)
    store.commit(C.upsert(state, batch.select(*store.columns, seq_col), seq_col=seq_col), touched)


def apply_classified_upsert(spark: SparkSession, path: str, batch: DataFrame, *, metadata_cols: list[str],
                            seq_col: str = "seq") -> DataFrame:
    """U3 on disk; returns the classification report (materialised)."""
    store, batch = _Store(spark, path), _named(batch)
    touched = store.touched(batch)
    state = store.rows(touched).select(*store.columns)
    new_state, report = C.classified_upsert(state, batch, metadata_cols=metadata_cols, seq_col=seq_col)
    report = materialize(report, "report")
    if not touched.isEmpty():
        store.commit(new_state, touched)
    return report


def apply_update(spark: SparkSession, path: str, changes: DataFrame) -> None:
    """U4 on disk: non-null fields of ``changes`` (one row a key) replace those of stored rows."""
    store, changes = _Store(spark, path), _named(changes)
    touched = store.touched(changes)
    if not touched.isEmpty():
        store.commit(C.update_in_place(store.rows(touched).select(*store.columns), changes), touched)


def apply_delete(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """U6 on disk: remove the rows with the full keys (collection, namespace, key); only buckets holding one are rewritten."""
    wanted = _named(keys).select(*C.KEY_COLS).distinct()
    state = read_state(spark, path)
    apply_removal(spark, path, state.join(broadcast_if_small(wanted), list(C.KEY_COLS), "left_semi"),
                  lambda rows: C.remove_keys(rows, wanted, key_cols=C.KEY_COLS))


def apply_removal(spark: SparkSession, path: str, doomed: DataFrame, remove) -> None:
    """U7-U10, B5 on disk: ``remove`` maps the rows of the buckets that hold ``doomed`` rows to those that stay."""
    store = _Store(spark, path)
    touched = store.touched(doomed)
    if not touched.isEmpty():
        store.commit(remove(store.rows(touched).select(*store.columns)), touched)


def compact(spark: SparkSession, path: str) -> None:
    """Rewrite the whole store as one version, for stores with many small commits."""
    store = _Store(spark, path)
    store.commit(store.rows(), None)


def vacuum(spark: SparkSession, path: str, *, keep: int = 1) -> int:
    """Drop all but the last ``keep`` commits and the files that none of those names; returns the folders deleted.

    No mutation or reader of a dropped commit may be under way; versions numbered above the last commit are left alone.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    path, published = path.rstrip("/"), versions(spark, path)
    kept = [_Store(spark, path, n) for n in published[-keep:]]
    live = kept[0].manifest()
    for store in kept[1:]:
        live = live.unionByName(store.manifest())
    live = materialize(live.select("version", *BUCKET_COLS).distinct(), "live")
    named = {r["version"] for r in live.select("version").distinct().collect()}
    manifests = {_read_text(spark, f"{path}/_commits/{s.number:012d}").strip() for s in kept}
    settled = lambda version: int(version.split("-")[0]) <= published[-1]

    for number in published[:-keep]:
        _delete(spark, f"{path}/_commits/{number:012d}")
    for version in _names(spark, f"{path}/_manifests"):
        if settled(version) and version not in manifests:
            _delete(spark, f"{path}/_manifests/{version}")
    dropped = 0
    for folder in _names(spark, f"{path}/versions"):
        version = folder.removeprefix("version=")
        if settled(version) and version not in named:
            _delete(spark, f"{path}/versions/{folder}")
            dropped += 1
    # folder names are escaped as Spark's writer escapes them
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    stored = kept[-1].files(sorted(named)).select("version", *BUCKET_COLS).distinct()
    for r in stored.join(broadcast_if_small(live), ["version", *BUCKET_COLS], "left_anti").toLocalIterator():
        names = "/".join(f"{c}={escape(r[c] or _DEFAULT_PARTITION)}" for c in PARTITION_COLS)
        _delete(spark, f"{path}/versions/version={r['version']}/{names}/bucket={r['bucket']}")
        dropped += 1
    return dropped
