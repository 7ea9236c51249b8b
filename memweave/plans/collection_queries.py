"""Registered collection queries (U1-U12, G1-G8) over the derived records view."""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.operators import collections as C
from memweave.plans.catalog import register
from memweave.plans.fixtures import collections_registry, incoming, records, request_keys, with_views
from memweave.sources.tables import load

META = ["document_id", "lang", "source"]
STATE_SQL = "collection, namespace, key, document_id, lang, source, round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i)), 4) AS emb_check"
LATEST_SQL = """
SELECT * FROM incoming
QUALIFY row_number() OVER (PARTITION BY collection, namespace, key ORDER BY seq DESC) = 1"""
KEYS = "collection, namespace, key"


def _state_out(df):
    return df.select("collection", "namespace", "key", "document_id", "lang", "source",
                     # every element, weighted by its place
                     F.round(F.aggregate(F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0).cast("double"),
                                         lambda a, x: a + x), 4).alias("emb_check"))


def _not_in(alias_l: str, alias_r: str) -> str:
    return " AND ".join(f"{alias_l}.{c} = {alias_r}.{c}" for c in ("collection", "namespace", "key"))


@register("u1_upsert", with_views(f"""
, latest AS ({LATEST_SQL})
SELECT {STATE_SQL} FROM (
  SELECT r.* FROM records r WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE {_not_in('l', 'r')})
  UNION ALL
  SELECT collection, namespace, key, document_id, embedding, lang, source FROM latest)""",
    "records", "incoming"))
def u1_upsert(spark, sf_dir):
    new_state = C.upsert(records(spark, sf_dir), incoming(spark, sf_dir),
                         registry=collections_registry(spark, sf_dir), strict=True)
    return _state_out(new_state)


U2_SQL = """
SELECT b.collection, b.namespace, b.key, b.seq,
  CASE WHEN s.key IS NULL THEN 'upsert'
       WHEN b.document_id IS NOT DISTINCT FROM s.document_id AND b.lang IS NOT DISTINCT FROM s.lang
            AND b.source IS NOT DISTINCT FROM s.source THEN 'skip'
       ELSE 'update' END AS op
FROM incoming b LEFT JOIN records s ON s.collection = b.collection AND s.namespace = b.namespace AND s.key = b.key"""


@register("u2_classify", with_views(U2_SQL, "records", "incoming"))
def u2_classify(spark, sf_dir):
    labelled = C.classify(records(spark, sf_dir), incoming(spark, sf_dir), metadata_cols=META)
    return labelled.select("collection", "namespace", "key", "seq", "op")


@register("u3_classified_upsert", with_views(f"""
, labelled AS ({U2_SQL}),
changes AS (
  SELECT i.* FROM incoming i JOIN labelled l ON l.key = i.key AND l.seq = i.seq AND l.collection = i.collection
  WHERE l.op <> 'skip'
  QUALIFY row_number() OVER (PARTITION BY i.collection, i.namespace, i.key ORDER BY i.seq DESC) = 1)
SELECT {STATE_SQL} FROM (
  SELECT r.* FROM records r WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE {_not_in('c', 'r')})
  UNION ALL
  SELECT collection, namespace, key, document_id, embedding, lang, source FROM changes)""",
    "records", "incoming"))
def u3_classified_upsert(spark, sf_dir):
    new_state, _ = C.classified_upsert(records(spark, sf_dir), incoming(spark, sf_dir), metadata_cols=META)
    return _state_out(new_state)


@register("u3_upsert_report", with_views(f"""
SELECT key, seq, op, CASE op WHEN 'skip' THEN 0 WHEN 'upsert' THEN 1 ELSE 2 END AS op_order
FROM ({U2_SQL}) t""", "records", "incoming"))
def u3_upsert_report(spark, sf_dir):
    _, report = C.classified_upsert(records(spark, sf_dir), incoming(spark, sf_dir), metadata_cols=META)
    return report.select("key", "seq", "op", "op_order")


@register("u4_update_in_place", with_views(f"""
, latest AS ({LATEST_SQL})
SELECT r.collection, r.namespace, r.key, r.document_id,
       coalesce(l.lang, r.lang) AS lang, coalesce(l.source, r.source) AS source,
       round(list_sum(list_transform(r.embedding, lambda x, i: x::DOUBLE * i)), 4) AS emb_check
FROM records r LEFT JOIN latest l ON {_not_in('l', 'r')}""", "records", "incoming"))
def u4_update_in_place(spark, sf_dir):
    changes = C.latest_per_key(incoming(spark, sf_dir)).select("collection", "namespace", "key", "lang", "source")
    return _state_out(C.update_in_place(records(spark, sf_dir), changes))


@register("u5_batch_counts", with_views("""
SELECT collection, namespace, coalesce(batch_no, -1) AS batch_no, count(*) AS n_vectors FROM (
  SELECT collection, namespace,
         (row_number() OVER (PARTITION BY collection, namespace ORDER BY seq) - 1) // 100 AS batch_no
  FROM incoming) t
GROUP BY ROLLUP (collection, namespace, batch_no)""", "incoming"))
def u5_batch_counts(spark, sf_dir):
    # Total rows carry batch_no -1 instead of NULL.
    out = C.batch_counts(incoming(spark, sf_dir))
    return out.withColumn("batch_no", F.coalesce(F.col("batch_no"), F.lit(-1).cast("bigint")))


@register("u6_remove_keys", with_views(f"""
SELECT {KEYS} FROM records r WHERE NOT (r.collection = 'c1' AND r.key IN (SELECT key FROM request_keys))""", "records", "request_keys"))
def u6_remove_keys(spark, sf_dir):
    return C.remove_keys(records(spark, sf_dir), request_keys(spark, sf_dir), collection="c1").select("collection", "namespace", "key")


@register("u7_remove_filter", with_views(f"""
SELECT {KEYS}, lang FROM records WHERE NOT (collection = 'c1' AND coalesce(lang = 'en', false))""", "records"))
def u7_remove_filter(spark, sf_dir):
    return C.remove_where(records(spark, sf_dir), {"lang": "en"}, collection="c1").select("collection", "namespace", "key", "lang")


@register("u8_remove_documents", with_views(f"""
SELECT {KEYS}, document_id FROM records
WHERE NOT (collection = 'c1' AND document_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1))""", "records"))
def u8_remove_documents(spark, sf_dir):
    ids = load(spark, sf_dir, "labels").filter(F.col("toxic") == 1).select(F.col("doc_id").cast("string").alias("document_id"))
    return C.remove_documents(records(spark, sf_dir), ids, collection="c1").select("collection", "namespace", "key", "document_id")


@register("u9_clear_namespace", with_views(f"""
SELECT {KEYS} FROM records WHERE NOT (collection = 'c1' AND namespace = 'ns1')""", "records"))
def u9_clear_namespace(spark, sf_dir):
    return C.clear_namespace(records(spark, sf_dir), "ns1", collection="c1").select("collection", "namespace", "key")


@register("u10_delete", with_views(f"""
SELECT {KEYS}, lang FROM records r
WHERE NOT (r.collection = 'c1' AND r.key IN (SELECT key FROM request_keys) AND r.namespace = 'ns2' AND coalesce(r.lang = 'en', false))""",
    "records", "request_keys"))
def u10_delete(spark, sf_dir):
    out = C.delete(records(spark, sf_dir), collection="c1", ids=request_keys(spark, sf_dir), namespace="ns2", where={"lang": "en"})
    return out.select("collection", "namespace", "key", "lang")


NEW_NAMES_SQL = "SELECT DISTINCT 'c' || CAST(label % 5 AS VARCHAR) AS name FROM embeddings"


def _new_names(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("c"), (F.col("label") % 5).cast("string")).alias("name")).distinct()


@register("u11_create_collections", with_views(f"""
SELECT name, state FROM registry
UNION ALL
SELECT n.name, 'Ready' AS state FROM ({NEW_NAMES_SQL}) n WHERE n.name NOT IN (SELECT name FROM registry)""",
    "registry"))
def u11_create_collections(spark, sf_dir):
    reg, _ = C.create_collections(collections_registry(spark, sf_dir), _new_names(spark, sf_dir))
    return reg


@register("u12_drop_collections", with_views("""
SELECT name, state FROM registry WHERE name NOT IN ('c1', 'c_pending')""", "registry"))
def u12_drop_collections(spark, sf_dir):
    names = spark.createDataFrame([("c1",), ("c_pending",)], "name string")
    return C.drop_collections(collections_registry(spark, sf_dir), names, strict=True)


@register("g1_list_collections", with_views("SELECT DISTINCT coalesce(name, '') AS name FROM registry", "registry"))
def g1_list_collections(spark, sf_dir):
    return C.list_collections(collections_registry(spark, sf_dir))


@register("g2_collection_exists", with_views(f"""
SELECT n.name, coalesce(bool_or(r.state = 'Ready'), false) AS exists
FROM ({NEW_NAMES_SQL} UNION SELECT 'c_pending') n LEFT JOIN registry r ON r.name = n.name
GROUP BY n.name""", "registry"))
def g2_collection_exists(spark, sf_dir):
    names = _new_names(spark, sf_dir).unionByName(spark.createDataFrame([("c_pending",)], "name string"))
    return C.collections_exist(collections_registry(spark, sf_dir), names, policy="remote")


@register("g3_get_batch", with_views("""
SELECT k.ord, r.key, r.collection, r.namespace, r.document_id, r.lang, r.source
FROM request_keys k JOIN records r ON r.key = k.key""", "records", "request_keys"))
def g3_get_batch(spark, sf_dir):
    out = C.get_batch(records(spark, sf_dir), request_keys(spark, sf_dir), include_vectors=False)
    return out.select("ord", "key", "collection", "namespace", "document_id", "lang", "source")


@register("g4_fetch_no_vectors", with_views("""
SELECT r.key, r.collection, r.namespace, r.document_id, r.lang, r.source
FROM records r WHERE r.namespace = 'ns1' AND r.key IN (SELECT key FROM request_keys)""", "records", "request_keys"))
def g4_fetch_no_vectors(spark, sf_dir):
    keys = request_keys(spark, sf_dir).select("key").distinct().withColumn("ord", F.lit(0))
    state = records(spark, sf_dir).filter(F.col("namespace") == "ns1")
    out = C.get_batch(state, keys, include_vectors=False)
    return out.select("key", "collection", "namespace", "document_id", "lang", "source")


@register("g5_filter_query", with_views(f"""
SELECT {KEYS}, lang FROM records WHERE lang = 'de' ORDER BY key LIMIT 10""", "records"))
def g5_filter_query(spark, sf_dir):
    return C.query_by_filter(records(spark, sf_dir), {"lang": "de"}, top_k=10).select(
        "collection", "namespace", "key", "lang")


@register("g6_by_document", with_views(f"""
SELECT {KEYS}, document_id FROM records
WHERE document_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY key) <= 3""", "records"))
def g6_by_document(spark, sf_dir):
    ids = load(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("document_id"))
    return C.by_document(records(spark, sf_dir), ids, per_document=3).select(
        "collection", "namespace", "key", "document_id")


@register("g7_namespaces", with_views("SELECT DISTINCT collection, namespace FROM records", "records"))
def g7_namespaces(spark, sf_dir):
    return C.list_namespaces(records(spark, sf_dir))


@register("g8_index_stats", with_views("""
SELECT collection, namespace, count(*) AS n_vectors,
       CAST(min(len(embedding)) AS BIGINT) AS min_dim, CAST(max(len(embedding)) AS BIGINT) AS max_dim
FROM records WHERE lang IN ('en', 'fr')
GROUP BY ROLLUP (collection, namespace)""", "records"))
def g8_index_stats(spark, sf_dir):
    return C.index_stats(records(spark, sf_dir), where={"lang": ["en", "fr"]})
