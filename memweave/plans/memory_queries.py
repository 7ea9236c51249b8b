"""Registered memory-search queries over ingested records."""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.functions.filters import tag_filters
from memweave.operators import embedding as E
from memweave.operators import search
from memweave.operators.tokens import count_tokens
from memweave.plans import ingest as P
from memweave.plans.catalog import register
from memweave.plans.ingest_queries import BASE, PROVIDER_CLASS, STAMP
from memweave.plans.text_queries import LINE_LIMIT, OVERLAP, PARAGRAPH_LIMIT
from memweave.sources.tables import load

OPTS64 = P.IngestOptions(max_tokens_per_line=LINE_LIMIT, max_tokens_per_paragraph=PARAGRAPH_LIMIT,
                         overlap_tokens=OVERLAP, generators=((PROVIDER_CLASS, "hash64", 64),), stamp=STAMP)
FILTERS = [{"lang": "en"}, {"source": "src1"}]
FILTERS_SQL = "(lang = 'en' OR source = 'src1')"


def memory_records(spark, sf_dir):
    files = P.import_files(load(spark, sf_dir, "documents"))
    return P.records(P.embeddings(P.partitions(files, OPTS64, materialize=True), OPTS64), OPTS64)


def _queries(spark, sf_dir):
    return load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))


def _hash_vectors(src: str, id_col: str, text_expr: str, p: str) -> str:
    """Sparse hashed vectors (id, b, w) with float32 weights, plus their norms."""
    return rf"""
{p}t AS (SELECT {id_col} AS id, unnest(regexp_extract_all(lower({text_expr}), '[\p{{L}}\p{{N}}]+')) AS term FROM {src}),
{p}b AS (SELECT id, (('0x' || substr(md5(term), 1, 4))::INTEGER) % 64 AS b, count(*) AS c FROM {p}t GROUP BY 1, 2),
{p}n AS (SELECT id, sqrt(sum(c * c)) AS n FROM {p}b GROUP BY 1),
{p}w AS (SELECT {p}b.id, b, CAST(CAST(c / n AS FLOAT) AS DOUBLE) AS w FROM {p}b JOIN {p}n USING (id)),
{p}norm AS (SELECT id, sqrt(sum(w * w)) AS nn FROM {p}w GROUP BY 1)"""


SCORED = BASE + "," + _hash_vectors("parts", "part_id", "text", "r") + "," + _hash_vectors(
    "benchmark", "item_id", "text", "q") + f""",
recs AS (SELECT part_id, 'd=' || document_id || '//p=' || part_id AS key, text, n_tokens FROM parts
         WHERE {FILTERS_SQL}),
dots AS (SELECT q.id AS qid, r.id AS part_id, sum(q.w * r.w) AS dot
         FROM qw q JOIN rw r USING (b) WHERE r.id IN (SELECT part_id FROM recs) GROUP BY 1, 2),
scored AS (
  SELECT d.qid, recs.key, recs.text, recs.n_tokens, round(d.dot / (qn.nn * rn.nn), 6) AS score
  FROM dots d JOIN qnorm qn ON qn.id = d.qid JOIN rnorm rn ON rn.id = d.part_id
  JOIN recs ON recs.part_id = d.part_id)"""


@register("n7_memory_search", SCORED + """
SELECT qid, key, score FROM scored WHERE score >= 0.3
QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) <= 5""")
def n7_memory_search(spark, sf_dir):
    hits = search.search_memory(memory_records(spark, sf_dir), _queries(spark, sf_dir),
                                embedder=E.hashed_embedder(64), filters=FILTERS, min_relevance=0.3, limit=5)
    return hits.select("qid", "key", "score")


@register("n8_tag_filter", BASE + """
SELECT 'd=' || document_id || '//p=' || part_id AS key, document_id FROM parts
WHERE lang = 'fr' OR (lang = 'en' AND source IN ('src1', 'src2'))""")
def n8_tag_filter(spark, sf_dir):
    recs = memory_records(spark, sf_dir)
    pred = tag_filters(F.col("tags"), [{"lang": "fr"}, {"lang": "en", "source": ["src1", "src2"]}])
    return recs.filter(pred).select("key", "document_id")


@register("n9_grounding", SCORED + """,
hits AS (
  SELECT * FROM scored WHERE score >= 0.2
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) <= 10),
run AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY qid ORDER BY score DESC, key ROWS UNBOUNDED PRECEDING) AS run,
         row_number() OVER (PARTITION BY qid ORDER BY score DESC, key) AS rnk
  FROM hits)
SELECT qid, CAST(count(*) AS BIGINT) AS n_facts, CAST(sum(n_tokens) AS BIGINT) AS n_tokens,
       sha256(string_agg(text, chr(10) ORDER BY rnk)) AS facts_sha256
FROM run WHERE run <= 400 GROUP BY qid""")
def n9_grounding(spark, sf_dir):
    recs = memory_records(spark, sf_dir).withColumn("text", F.col("payload.text"))
    hits = search.search_memory(recs, _queries(spark, sf_dir), embedder=E.hashed_embedder(64), filters=FILTERS,
                                min_relevance=0.2, limit=10)
    hits = hits.withColumn("n_tokens", count_tokens(F.col("text"), "whitespace"))
    g = search.grounding(hits, token_budget=400)
    return g.select("qid", "n_facts", "n_tokens", F.sha2("facts", 256).alias("facts_sha256"))
