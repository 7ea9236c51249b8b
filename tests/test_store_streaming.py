import glob
import hashlib
import os
import random

import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from memweave.operators import collections as C
from memweave.plans.io_queries import s1_file_scan
from memweave.sources import files as FS
from memweave.sources import store
from memweave.streaming.upserts import run_upsert_stream

SCHEMA = "collection string, namespace string, key string, lang string, seq long"


def _state(spark, path):
    df = spark.createDataFrame([("c", "a", "k1", "en", 0), ("c", "a", "k2", "fr", 0), ("c", "b", "k3", "de", 0)],
                               SCHEMA).drop("seq")
    store.create_state(df, path)


def _files(path):
    return set(glob.glob(f"{path}/versions/**/*.parquet", recursive=True))


def test_upsert_rewrites_only_touched_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    schema = "collection string, namespace string, key string, lang string"
    rows = [("c", n, f"k{i}", "en") for n in ("a", "b") for i in range(40)]
    store.create_state(spark.createDataFrame(rows, schema), path, buckets=4)
    before = _files(path)
    batch = spark.createDataFrame([("c", "a", "k1", "it", 5), ("c", "a", "k1", "xx", 4)], SCHEMA)
    store.apply_upsert(spark, path, batch)
    assert {r.key: r.lang for r in store.read_state(spark, path).filter("lang <> 'en'").collect()} == {"k1": "it"}
    assert store.read_state(spark, path).count() == 80
    new = _files(path) - before
    assert before <= _files(path)  # nothing is overwritten
    assert len({os.path.dirname(f) for f in new}) == 1 and "collection=c/namespace=a/bucket=" in new.pop()
    held = store.live_buckets(spark, path).collect()
    assert len(held) == 8 and sum(r.n_rows for r in held) == 80
    assert sum(r.version.startswith("000000000002") for r in held) == 1


def test_state_scan_is_pruned_by_the_manifest(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    _state(spark, path)
    plan = store.read_state(spark, path).filter("collection = 'c'")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "= c)" in plan.split("PartitionFilters")[1]


@pytest.mark.parametrize("step", ["rows", "manifest", "publish"])
def test_failure_between_the_steps_leaves_the_old_state(spark, tmp_dir, monkeypatch, step):
    path = f"{tmp_dir}/state"
    _state(spark, path)
    before = sorted(store.read_state(spark, path).collect())
    batch = spark.createDataFrame([("c", "a", "k1", "it", 5), ("c", "b", "k3", "it", 6)], SCHEMA)

    def fail(*_args, **_kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "rows":  # a task dies while it computes the new rows
            bad = batch.withColumn("lang", F.when(F.col("key") == "k3", F.raise_error(F.lit("lost"))).otherwise(F.col("lang")))
        else:
            bad = batch
            m.setattr(*((store._Store, "files") if step == "manifest" else (store, "_publish")),
                      fail if step == "publish" else _failing_second(store._Store.files, fail))
        with pytest.raises(Exception, match="lost"):
            store.apply_upsert(spark, path, bad)
    assert store.versions(spark, path) == [1] and sorted(store.read_state(spark, path).collect()) == before
    store.apply_upsert(spark, path, batch)  # the same mutation again goes through beside the leftovers
    assert {r.key: r.lang for r in store.read_state(spark, path).collect()} == {"k1": "it", "k2": "fr", "k3": "it"}
    store.vacuum(spark, path)
    assert {r.key: r.lang for r in store.read_state(spark, path).collect()} == {"k1": "it", "k2": "fr", "k3": "it"}
    assert len({f.split("version=")[1].split("/")[0] for f in _files(path)}) <= 2


def _failing_second(real, fail):
    """``real`` for the reads of the old rows, a failure where the new version is counted for the manifest."""
    return lambda self, held: fail() if held[0].startswith("000000000002") else real(self, held)


def test_snapshots_conflicts_compaction(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    _state(spark, path)
    late = store._Store(spark, path)  # a second writer that starts from the first snapshot
    touched = late.touched(late.rows())
    reader = store.read_state(spark, path)
    store.apply_upsert(spark, path, spark.createDataFrame([("c", "a", "k9", "es", 6)], SCHEMA))
    with pytest.raises(store.StoreConflict):
        late.commit(late.rows().limit(0), touched)
    assert reader.count() == 3 and store.read_state(spark, path).count() == 4
    assert store.read_state(spark, path, version=1).count() == 3
    with pytest.raises(ValueError):
        store.read_state(spark, path, version=7)
    assert store.vacuum(spark, path, keep=2) >= 1  # the late writer's files
    assert store.read_state(spark, path, version=1).count() == 3
    store.compact(spark, path)
    store.vacuum(spark, path)
    assert store.versions(spark, path) == [3] and store.read_state(spark, path).count() == 4
    assert {f.split("version=")[1][:12] for f in _files(path)} == {"000000000003"}


def test_update_and_removal_on_disk(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    _state(spark, path)
    store.apply_update(spark, path, spark.createDataFrame([("c", "a", "k1", "it"), ("c", "a", "none", "it")],
                                                          "collection string, namespace string, key string, lang string"))
    store.apply_removal(spark, path, store.read_state(spark, path).filter("lang = 'fr'"),
                        lambda rows: C.remove_where(rows, {"lang": "fr"}, collection="c"))
    assert {r.key: r.lang for r in store.read_state(spark, path).collect()} == {"k1": "it", "k3": "de"}
    n = len(store.versions(spark, path))
    store.apply_removal(spark, path, store.read_state(spark, path).filter("lang = 'zz'"), lambda rows: rows)
    assert len(store.versions(spark, path)) == n  # nothing touched, nothing committed


def test_empty_store_null_names_and_reserved_columns(spark, tmp_dir):
    path, schema = f"{tmp_dir}/state", "collection string, namespace string, key string, lang string"
    store.create_state(spark.createDataFrame([], schema), path)
    assert store.read_state(spark, path).count() == 0 and store.live_buckets(spark, path).count() == 0
    batch = spark.createDataFrame([(None, None, "k", "en", 1), ("", "", "k", "fr", 2)], SCHEMA)
    store.apply_upsert(spark, path, batch)
    assert [tuple(r) for r in store.read_state(spark, path).collect()] == [("", "", "k", "fr")]
    with pytest.raises(FileExistsError):
        store.create_state(spark.createDataFrame([], schema), path)
    with pytest.raises(ValueError):
        store.create_state(spark.createDataFrame([], schema + ", bucket int"), f"{tmp_dir}/other")


def test_delete_empties_partition(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    _state(spark, path)
    store.apply_delete(spark, path, spark.createDataFrame([("c", "b", "k3")], "collection string, namespace string, key string"))
    rows = sorted(r.key for r in store.read_state(spark, path).collect())
    assert rows == ["k1", "k2"]


def test_stream_of_batches_equals_one_batch(spark, tmp_dir):
    path, src = f"{tmp_dir}/state", f"{tmp_dir}/in"
    _state(spark, path)
    b1 = spark.createDataFrame([("c", "a", "k1", "en", 1), ("c", "a", "k5", "xx", 2)], SCHEMA)
    b2 = spark.createDataFrame([("c", "b", "k3", "pt", 3)], SCHEMA)
    b1.coalesce(1).write.mode("append").parquet(src)
    b2.coalesce(1).write.mode("append").parquet(src)
    run_upsert_stream(spark, source_dir=src, schema=b1.schema, state_path=path, checkpoint_path=f"{tmp_dir}/ck",
                      report_path=f"{tmp_dir}/report", metadata_cols=["lang"])
    rows = {r.key: r.lang for r in store.read_state(spark, path).collect()}
    assert rows == {"k1": "en", "k2": "fr", "k3": "pt", "k5": "xx"}
    ops = {r.key: r.op for r in spark.read.parquet(f"{tmp_dir}/report").collect()}
    assert ops == {"k1": "skip", "k5": "upsert", "k3": "update"}


def test_file_sink_and_inventory(spark, tmp_dir):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    FS.write_text_files(df, f"{tmp_dir}/out")
    try:
        FS.write_text_files(df, f"{tmp_dir}/out")
    except Exception:
        pass
    else:
        raise AssertionError("errorifexists must refuse to overwrite")
    FS.write_text_files(df, f"{tmp_dir}/out", mode="overwrite")
    req = spark.createDataFrame([(n,) for n in os.listdir(f"{tmp_dir}/out") if n.startswith("part")] + [("nope",)],
                                "path string")
    inv = {r.path: r.exists for r in FS.file_inventory(spark, req, f"{tmp_dir}/out").collect()}
    assert inv["nope"] is False and sum(inv.values()) >= 1


def test_default_namespace_and_numeric_names_round_trip(spark, tmp_dir):
    path = f"{tmp_dir}/state"
    df = spark.createDataFrame([("007", "", "k1", "en"), ("007", "", "k2", "fr")],
                               "collection string, namespace string, key string, lang string")
    store.create_state(df, path)
    rows = sorted((r.collection, r.namespace, r.key) for r in store.read_state(spark, path).collect())
    assert rows == [("007", "", "k1"), ("007", "", "k2")]
    store.apply_delete(spark, path, spark.createDataFrame([("007", "", "k1"), ("007", "", "k2")], "collection string, namespace string, key string"))
    assert store.read_state(spark, path).count() == 0


def test_delete_keeps_other_collections_and_odd_names(spark, tmp_dir):
    path, names = f"{tmp_dir}/state", ["ns:1", "x/y", "%", "a=b", "plain", ""]
    schema = "collection string, namespace string, key string, lang string"
    rows = [(c, n, "k", "en") for c in ("A", "B:1") for n in names]
    store.create_state(spark.createDataFrame(rows, schema), path)
    left = set(rows)
    for c, n, k, lang in rows[:6]:
        store.apply_delete(spark, path, spark.createDataFrame([(c, n, k)], "collection string, namespace string, key string"))
        left.remove((c, n, k, lang))
        assert {tuple(r) for r in store.read_state(spark, path).select("collection", "namespace", "key", "lang").collect()} == left


def test_inventory_of_qualified_roots(spark, tmp_dir):
    spark.createDataFrame([("a",)], "text string").coalesce(1).write.text(f"{tmp_dir}/t")
    name = next(n for n in os.listdir(f"{tmp_dir}/t") if n.startswith("part"))
    req = spark.createDataFrame([(name,), ("nope",)], "path string")
    for root in (f"{tmp_dir}/t", f"file:{tmp_dir}/t", f"file://{tmp_dir}/t/"):
        assert {r.path: r.exists for r in FS.file_inventory(spark, req, root).collect()} == {name: True, "nope": False}


@pytest.fixture
def odd_files(tmp_dir):
    """Names to bodies: a body larger than a scan split, and what a line reader drops, unpacks or cannot tell."""
    mark = b"\xef\xbb\xbf"
    bodies = {"a b%20\u00e9": b"PAR1\n\nxx\r\n\xff\xfe\x00", "end": b"x\n", "newlines": b"\n\n\n", "none": b"\x00" * 100_000,
              "mark": mark, "mark_newline": mark + b"\n", "mark_text": mark + b"ab\ncd", "mark_twice": mark * 2 + b"\nz\n",
              "x.gz": b"not packed\n", "sub/large": random.Random(1).randbytes(12 << 20)}
    for name, body in bodies.items():
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}.parquet", "wb") as f:
            f.write(body)
    return {f"{n}.parquet": (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items()}


@pytest.fixture
def small_pieces(spark):
    """Scan splits of 1 MB, and no file of more as one row."""
    conf = {"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.sources.binaryFile.maxLength": str(1 << 20)}
    kept = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_file_scan_query_reads_no_file_as_one_row(spark, tmp_dir, odd_files, small_pieces):
    rows = s1_file_scan(spark, tmp_dir).collect()
    assert sorted(tuple(r) for r in rows) == sorted((n.split("/")[-1], *v) for n, v in odd_files.items())


def test_digests_keep_the_listing(spark, tmp_dir, odd_files, small_pieces):
    files = FS.scan_files(spark, tmp_dir, glob="*.parquet")
    rows = FS.with_sha256(files, tmp_dir, suffix=".parquet")
    assert rows.columns == ["path", "modificationTime", "length", "sha256"]
    found = [(r.path.split(f"{tmp_dir}/")[1], (r.length, r.sha256)) for r in rows.collect()]
    assert sorted(found) == sorted(odd_files.items())
    with pytest.raises(Exception, match="not read: "):  # a listed file that the suffix leaves out
        FS.with_sha256(files, tmp_dir, suffix=".txt").collect()


def test_a_digest_of_other_bytes_than_listed_fails():
    lines = pa.table({"_file": ["f", "f", "g"], "_size": [4, 4, 9], "_line": [b"a", b"b", b"c"]})
    found = FS._file_digests(iter(lines.to_batches(max_chunksize=1)))
    assert next(found).to_pylist() == [{"_file": "f", "sha256": hashlib.sha256(b"a\nb\n").hexdigest()}]
    with pytest.raises(ValueError, match="g: 1 bytes read, 9 listed"):
        next(found)


def test_scratch_is_released(spark):
    from memweave import session

    held = session._SCRATCH.pop(spark.sparkContext.applicationId, [])
    try:
        df = session.materialize(spark.range(3).toDF("x"), "t")
        path = session._SCRATCH[spark.sparkContext.applicationId][0]
        assert df.count() == 3 and os.path.isdir(path)
        assert session.release_scratch(spark) == 1 and not os.path.exists(path)
    finally:
        session._SCRATCH[spark.sparkContext.applicationId] = held


def test_usage_stream_reads_a_table_of_part_files(spark, tmp_dir):
    from memweave.plans.io_queries import p5_stream_usage

    rows = [(i, 0, "user" if i % 2 else "assistant", "a b c") for i in range(12)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv.repartition(3).write.parquet(f"{tmp_dir}/many/conversations.parquet")
    os.makedirs(f"{tmp_dir}/one")
    conv.toPandas().to_parquet(f"{tmp_dir}/one/conversations.parquet")
    for folder in ("many", "one"):
        got = {r.role: (r.n_messages, r.tokens) for r in p5_stream_usage(spark, f"{tmp_dir}/{folder}").collect()}
        assert got == {"user": (6, 18), "assistant": (6, 18)}, folder


def test_stream_takes_an_arrival_of_many_files_as_one_batch(spark, tmp_dir):
    path, src = f"{tmp_dir}/state", f"{tmp_dir}/in"
    _state(spark, path)
    late = [("c", "a", "k%d" % i, "new", 100 + i) for i in range(1, 9)]
    for rows in ([("c", "a", "k%d" % i, "old", i) for i in range(1, 9)], late):
        spark.createDataFrame(rows, SCHEMA).repartition(4).write.mode("append").parquet(src)
        run_upsert_stream(spark, source_dir=src, schema=spark.createDataFrame([], SCHEMA).schema, state_path=path, checkpoint_path=f"{tmp_dir}/ck",
                          report_path=f"{tmp_dir}/report", metadata_cols=["lang"], files_per_batch=None)
    assert sorted({r.epoch for r in spark.read.parquet(f"{tmp_dir}/report").select("epoch").collect()}) == [0, 1]
    state = {(r.namespace, r.key): r.lang for r in store.read_state(spark, path).collect()}
    assert all(state["a", r[2]] == "new" for r in late)
