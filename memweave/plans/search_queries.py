"""Registered similarity and keyword queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.functions import vectors as V
from memweave.operators import pruned, search
from memweave.plans.catalog import register
from memweave.plans.fixtures import records, with_views
from memweave.sources.tables import load

REC_COLS = "r.collection, r.namespace, r.key, r.document_id, r.lang, r.source"


def _queries_from(rec, *match):
    return rec.select(F.col("key").alias("qid"), F.col("embedding").alias("query_vector"), *match)


# --- N1/N2: pairwise similarity of consecutive vectors ----------------------

@register("n1_pair_similarity", """
SELECT a.vec_id AS vec_id,
       round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine,
       round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot,
       round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS euclidean
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
""")
def n1_pair_similarity(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    a, b = e.alias("a"), e.alias("b")
    j = a.join(b, F.col("b.vec_id") == F.col("a.vec_id") + 1)
    return j.select(F.col("a.vec_id").alias("vec_id"),
                    F.round(V.cosine("a.embedding", "b.embedding"), 6).alias("cosine"),
                    F.round(V.dot("a.embedding", "b.embedding"), 6).alias("dot"),
                    F.round(V.euclidean("a.embedding", "b.embedding"), 6).alias("euclidean"))


# --- N3: one query vector, in-memory rule ------------------------------------

@register("n3_nearest_single", with_views("""
SELECT r.collection, r.namespace, r.key, r.document_id, r.lang, r.source, s.score
FROM (SELECT r.key, round(list_cosine_similarity(r.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score
      FROM records r, (SELECT embedding FROM embeddings WHERE vec_id = 0) q
      WHERE r.collection = 'c0') s
JOIN records r ON r.key = s.key
WHERE s.score >= 0.2
ORDER BY s.score DESC, r.key
LIMIT 10""", "records"))
def n3_nearest_single(spark, sf_dir):
    qv = load(spark, sf_dir, "embeddings").filter(F.col("vec_id") == 0).select("embedding").first()["embedding"]
    rec = records(spark, sf_dir).filter(F.col("collection") == "c0")
    return search.nearest(rec, qv, top_k=10, min_relevance=0.2, policy="memory")


# --- N3 many: every record's nearest neighbours in its collection -----------

N3_MANY_SQL = with_views(f"""
SELECT qid, collection, namespace, key, document_id, lang, source, score FROM (
  SELECT q.key AS qid, {REC_COLS},
         round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score
  FROM records q JOIN records r ON q.collection = r.collection) s
WHERE score >= 0.3
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) <= 10""", "records")


@register("n3_nearest_many", N3_MANY_SQL)
def n3_nearest_many(spark, sf_dir):
    rec = records(spark, sf_dir)
    return search.nearest_many(rec, _queries_from(rec, "collection"), top_k=10, min_relevance=0.3,
                               policy="memory", match_cols=["collection"])


@register("n3_nearest_blocks", N3_MANY_SQL)
def n3_nearest_blocks(spark, sf_dir):
    """The same search as a join of query and record blocks, as for a query table beyond the broadcast limit."""
    rec = records(spark, sf_dir)
    return search.nearest_many(rec, _queries_from(rec, "collection"), top_k=10, min_relevance=0.3, policy="memory", match_cols=["collection"],
                               max_broadcast_bytes=0, query_block=256, record_block=512)


@register("n3_pruned_nearest", N3_MANY_SQL)
def n3_pruned_nearest(spark, sf_dir):
    """The same search over a stored index, reading only blocks whose bound reaches the k-th score."""
    rec = records(spark, sf_dir)
    index = pruned.build_index(rec, match_cols=["collection"], rows_per_block=32)
    return pruned.nearest(index, _queries_from(rec, "collection"), top_k=10, min_relevance=0.3)[0]


# --- N4: remote rule (top-k, then strict floor), within namespace ------------

@register("n4_nearest_remote", with_views(f"""
SELECT * FROM (
  SELECT q.key AS qid, {REC_COLS},
         round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score
  FROM records q JOIN records r ON q.collection = r.collection AND q.namespace = r.namespace) s
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC NULLS LAST, key) <= 5
    AND score > 0.25""", "records"))
def n4_nearest_remote(spark, sf_dir):
    rec = records(spark, sf_dir)
    return search.nearest_many(rec, _queries_from(rec, "collection", "namespace"), top_k=5, min_relevance=0.25,
                               policy="remote", match_cols=["collection", "namespace"])


# --- N5: metadata filter before ranking --------------------------------------

N5_MANY_SQL = with_views(f"""
SELECT * FROM (
  SELECT q.key AS qid, {REC_COLS},
         round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score
  FROM records q JOIN records r ON q.collection = r.collection
  WHERE r.lang = 'en') s
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC NULLS LAST, key) <= 5
    AND score > 0.2""", "records")


@register("n5_filtered_nearest", N5_MANY_SQL)
def n5_filtered_nearest(spark, sf_dir):
    rec = records(spark, sf_dir)
    filtered = rec.filter(F.col("lang") == "en")
    return search.nearest_many(filtered, _queries_from(rec, "collection"), top_k=5, min_relevance=0.2,
                               policy="remote", match_cols=["collection"])


@register("n5_pruned_filtered", N5_MANY_SQL)
def n5_pruned_filtered(spark, sf_dir):
    """The filtered search over an index of all records."""
    rec = records(spark, sf_dir)
    index = pruned.build_index(rec, match_cols=["collection"], rows_per_block=32)
    return pruned.nearest(index, _queries_from(rec, "collection"), top_k=5, min_relevance=0.2, policy="remote", where=F.col("lang") == "en")[0]


# --- N6 / N10: raw query, no threshold, ids and scores only -----------------

@register("n6_raw_query", with_views("""
SELECT qid, collection, namespace, key, score FROM (
  SELECT q.key AS qid, r.collection, r.namespace, r.key,
         round(list_cosine_similarity(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score
  FROM records q JOIN records r ON q.collection = r.collection AND q.namespace = r.namespace) s
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) <= 3""", "records"))
def n6_raw_query(spark, sf_dir):
    rec = records(spark, sf_dir).select("collection", "namespace", "key", "embedding")
    return search.nearest_many(rec, _queries_from(records(spark, sf_dir), "collection", "namespace"), top_k=3,
                               min_relevance=None, policy="remote", match_cols=["collection", "namespace"])


@register("n2_dot_nearest", with_views("""
SELECT qid, key, score FROM (
  SELECT q.key AS qid, r.key,
         round(list_inner_product(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score
  FROM records q JOIN records r ON q.collection = r.collection) s
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) <= 5""", "records"))
def n2_dot_nearest(spark, sf_dir):
    rec = records(spark, sf_dir)
    slim = rec.select("collection", "key", "embedding")
    out = search.nearest_many(slim, _queries_from(rec, "collection"), top_k=5, min_relevance=None,
                              policy="remote", metric="dotproduct", match_cols=["collection"])
    return out.select("qid", "key", "score")


@register("n2_euclidean_nearest", with_views("""
SELECT qid, key, score FROM (
  SELECT q.key AS qid, r.key,
         round(list_distance(q.embedding::DOUBLE[], r.embedding::DOUBLE[]), 6) AS score
  FROM records q JOIN records r ON q.collection = r.collection AND q.key <> r.key) s
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score ASC, key) <= 5""", "records"))
def n2_euclidean_nearest(spark, sf_dir):
    rec = records(spark, sf_dir)
    queries = _queries_from(rec, "collection")
    slim = rec.select("collection", "key", "embedding")
    # Other records only: the query itself sits at distance 0.
    out = search.nearest_many(slim, queries, top_k=6, min_relevance=None, policy="remote",
                              metric="euclidean", match_cols=["collection"])
    out = out.filter(F.col("qid") != F.col("key"))
    return search.rank_within(out, ["qid"], [F.col("score").asc(), F.col("key").asc()], 5).select("qid", "key", "score")


# --- W1: keyword paging --------------------------------------------------------

@register("w1_keyword_page", """
WITH q AS (SELECT DISTINCT item_id AS qid, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM benchmark),
d AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents),
hits AS (SELECT q.qid, d.doc_id, count(*) AS score FROM d JOIN q ON d.term = q.term GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM hits)
SELECT r.qid, r.doc_id, r.score, r.rank, substr(doc.text, 1, 160) AS snippet
FROM ranked r JOIN documents doc ON doc.doc_id = r.doc_id
WHERE r.rank > 5 AND r.rank <= 10""")
def w1_keyword_page(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    queries = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    page = search.keyword_search(docs, queries, count=5, offset=5)
    return page.select("qid", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"), "snippet")


@register("n10_ids_only", with_views("""
SELECT collection, namespace, key, round(list_cosine_similarity(r.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS score
FROM records r, (SELECT embedding FROM embeddings WHERE vec_id = 1) q
WHERE r.collection = 'c1'
QUALIFY row_number() OVER (ORDER BY score DESC, key) <= 10""", "records"))
def n10_ids_only(spark, sf_dir):
    qv = load(spark, sf_dir, "embeddings").filter(F.col("vec_id") == 1).select("embedding").first()["embedding"]
    rec = records(spark, sf_dir).filter(F.col("collection") == "c1")
    return search.nearest(rec, qv, top_k=10, min_relevance=None, include_metadata=False)
