"""Registered queries over the stored form of a collection.

Each writes ``records`` as a store, applies the mutation on disk and reads the
last snapshot; the SQL is that of the in-memory operator.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.operators import collections as C
from memweave.plans.catalog import REGISTRY, register
from memweave.plans.collection_queries import _state_out
from memweave.plans.fixtures import incoming, records, request_keys, with_views
from memweave.session import scratch_dir
from memweave.sources import store
from memweave.sources.tables import load


def _sql(name: str) -> str:
    return REGISTRY[name][1]


def _stored(spark, sf_dir) -> str:
    path = f"{scratch_dir(spark, 'store')}/state"
    store.create_state(records(spark, sf_dir), path)
    return path


@register("u1_stored_upsert", _sql("u1_upsert"))
def u1_stored_upsert(spark, sf_dir):
    path = _stored(spark, sf_dir)
    store.apply_upsert(spark, path, incoming(spark, sf_dir))
    return _state_out(store.read_state(spark, path))


@register("u4_stored_update", _sql("u4_update_in_place"))
def u4_stored_update(spark, sf_dir):
    path = _stored(spark, sf_dir)
    changes = C.latest_per_key(incoming(spark, sf_dir)).select("collection", "namespace", "key", "lang", "source")
    store.apply_update(spark, path, changes)
    return _state_out(store.read_state(spark, path))


@register("u6_stored_delete", _sql("u6_remove_keys"))
def u6_stored_delete(spark, sf_dir):
    path = _stored(spark, sf_dir)
    namespaces = store.live_buckets(spark, path).filter("collection = 'c1'").select("namespace").distinct()
    keys = request_keys(spark, sf_dir).select("key").distinct()
    # a full key names the namespace: every wanted key in each namespace of the collection (a handful)
    wanted = keys.withColumn("collection", F.lit("c1")).join(
        namespaces.agg(F.collect_set("namespace").alias("_all")).withColumn("collection", F.lit("c1")), "collection")
    store.apply_delete(spark, path, wanted.select("collection", F.explode("_all").alias("namespace"), "key"))
    return store.read_state(spark, path).select(*C.KEY_COLS)


@register("u7_stored_filter", _sql("u7_remove_filter"))
def u7_stored_filter(spark, sf_dir):
    path = _stored(spark, sf_dir)
    doomed = store.read_state(spark, path).filter("collection = 'c1' and lang = 'en'")
    store.apply_removal(spark, path, doomed, lambda rows: C.remove_where(rows, {"lang": "en"}, collection="c1"))
    return store.read_state(spark, path).select(*C.KEY_COLS, "lang")


@register("u8_stored_documents", _sql("u8_remove_documents"))
def u8_stored_documents(spark, sf_dir):
    path = _stored(spark, sf_dir)
    ids = load(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select(F.col("doc_id").cast("string").alias("document_id"))
    doomed = store.read_state(spark, path).filter("collection = 'c1'").join(ids, "document_id", "left_semi")
    store.apply_removal(spark, path, doomed, lambda rows: C.remove_documents(rows, ids, collection="c1"))
    return store.read_state(spark, path).select(*C.KEY_COLS, "document_id")


@register("u9_stored_namespace", _sql("u9_clear_namespace"))
def u9_stored_namespace(spark, sf_dir):
    path = _stored(spark, sf_dir)
    doomed = store.read_state(spark, path).filter("collection = 'c1' and namespace = 'ns1'")
    store.apply_removal(spark, path, doomed, lambda rows: C.clear_namespace(rows, "ns1", collection="c1"))
    return store.read_state(spark, path).select(*C.KEY_COLS)


@register("u10_stored_delete", _sql("u10_delete"))
def u10_stored_delete(spark, sf_dir):
    path = _stored(spark, sf_dir)
    ids = request_keys(spark, sf_dir)
    doomed = (store.read_state(spark, path).filter("collection = 'c1' and namespace = 'ns2' and lang = 'en'")
              .join(ids.select("key"), "key", "left_semi"))
    store.apply_removal(spark, path, doomed,
                        lambda rows: C.delete(rows, collection="c1", ids=ids, namespace="ns2", where={"lang": "en"}))
    return store.read_state(spark, path).select(*C.KEY_COLS, "lang")


@register("u1_stored_snapshots", with_views("""
SELECT 1 AS version, collection, count(*) AS n_vectors FROM records GROUP BY collection
UNION ALL
SELECT 2, collection, count(*) FROM (
  SELECT collection, namespace, key FROM records UNION SELECT collection, namespace, key FROM incoming) t
GROUP BY collection
UNION ALL
SELECT 3, collection, count(*) FROM (
  SELECT collection, namespace, key FROM records UNION SELECT collection, namespace, key FROM incoming) t
WHERE namespace <> 'ns1' GROUP BY collection""", "records", "incoming"))
def u1_stored_snapshots(spark, sf_dir):
    """Vectors of each collection in all three snapshots, read after the last commit."""
    path = _stored(spark, sf_dir)
    store.apply_upsert(spark, path, incoming(spark, sf_dir))
    doomed = store.read_state(spark, path).filter("namespace = 'ns1'")
    store.apply_removal(spark, path, doomed, lambda rows: C.clear_namespace(rows, "ns1", collection=None))
    seen = [store.read_state(spark, path, version=v).groupBy("collection").agg(F.count(F.lit(1)).alias("n_vectors"))
            .select(F.lit(v).alias("version"), "collection", "n_vectors") for v in store.versions(spark, path)]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@register("g7_stored_namespaces", with_views("""
SELECT collection, namespace, count(*) AS n_vectors FROM records GROUP BY ROLLUP (collection, namespace)""", "records"))
def g7_stored_namespaces(spark, sf_dir):
    """Namespaces and their sizes from the manifest: no data file is read."""
    held = store.live_buckets(spark, _stored(spark, sf_dir))
    return held.rollup(*store.PARTITION_COLS).agg(F.sum("n_rows").alias("n_vectors"))
