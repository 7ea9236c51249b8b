"""Registered ingest queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from memweave.operators import embedding as E
from memweave.operators import ingest as I
from memweave.operators import records as R
from memweave.plans import ingest as P
from memweave.plans.catalog import register
from memweave.plans.text_queries import LINE_LIMIT, OVERLAP, PARAGRAPH_LIMIT, chunk_ctes
from memweave.session import materialize as write_once
from memweave.sources.tables import load

PROVIDER_CLASS = "org.example.memweave.embedding.HashedTermEmbedder"
PROVIDER = "memweave.embedding.HashedTermEmbedder"
GENERATORS = ((PROVIDER_CLASS, "hash64", 64), (PROVIDER_CLASS, "hash32", 32))
STAMP = "2024-01-01T00:00:00"
OPTS = P.IngestOptions(max_tokens_per_line=LINE_LIMIT, max_tokens_per_paragraph=PARAGRAPH_LIMIT,
                       overlap_tokens=OVERLAP, generators=GENERATORS, stamp=STAMP)
PREVIOUS_OPTS = P.IngestOptions(max_tokens_per_line=LINE_LIMIT, max_tokens_per_paragraph=120, overlap_tokens=0,
                                generators=GENERATORS, stamp="2023-06-01T00:00:00")


def _sid(*parts: str) -> str:
    return f"substr(sha256(concat_ws('/', {', '.join(parts)})), 1, 32)"


FILES_CTE = f"""
files AS (
  SELECT CAST(doc_id AS VARCHAR) AS document_id, {_sid("CAST(doc_id AS VARCHAR)", "'content.txt'")} AS file_id,
         lang, source FROM documents)"""


def parts_cte(p: str = "") -> str:
    return f"""
{p}parts AS (
  SELECT f.document_id, f.file_id, c.part_no, {_sid("f.file_id", "CAST(c.part_no AS VARCHAR)")} AS part_id,
         'content.txt.partition.' || CAST(c.part_no AS VARCHAR) || '.txt' AS name,
         CAST(length(c.text) AS INTEGER) AS size, sha256(c.text) AS sha256, c.text, c.n_tokens, f.lang, f.source
  FROM {p}chunks c JOIN files f ON f.document_id = CAST(c.doc_id AS VARCHAR))"""


BASE = f"WITH RECURSIVE {chunk_ctes(LINE_LIMIT, PARAGRAPH_LIMIT, OVERLAP)},{FILES_CTE},{parts_cte()}"
JOBS_CTE = f"""
gens AS (SELECT * FROM (VALUES ('{PROVIDER}', 'hash64', 64), ('{PROVIDER}', 'hash32', 32)) g(provider, generator, dim)),
jobs AS (
  SELECT p.*, g.provider, g.generator, g.dim,
         p.name || '.' || g.provider || '.' || g.generator || '.text_embedding' AS embedding_name
  FROM parts p, gens g)"""


def _docs(spark, sf_dir):
    return load(spark, sf_dir, "documents")


def _parts(spark, sf_dir, opts=OPTS):
    return P.partitions(P.import_files(_docs(spark, sf_dir)), opts)


# --- S7 / S8 / C5 --------------------------------------------------------------

@register("s7_import_text", f"""
SELECT CAST(doc_id AS VARCHAR) AS document_id, {_sid("CAST(doc_id AS VARCHAR)", "'content.txt'")} AS file_id,
       'content.txt' AS name, CAST(length(text) AS INTEGER) AS size, 'text/plain' AS mime_type,
       'extracted_text' AS artifact_type, sha256(text) AS sha256,
       array_to_string(list_sort(list_filter(['lang:' || lang, 'source:' || source], lambda x: x IS NOT NULL)), '|') AS tags
FROM documents""")
def s7_import_text(spark, sf_dir):
    a = I.import_text(_docs(spark, sf_dir))
    return a.select("document_id", "file_id", "name", "size", "mime_type", "artifact_type", "sha256",
                    R.flat_tags(F.col("tags")).alias("tags"))


PAGE_TEXT_SQL = r"""
trim(regexp_replace(
  replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'),
      '(?is)<nav\b.*?</nav>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'),
  '[ \t\n\r\f]+', ' ', 'g'))"""


@register("s8_web_import", f"""
SELECT CAST(page_id AS VARCHAR) AS document_id, url, CAST(length(t) AS INTEGER) AS size, sha256(t) AS sha256
FROM (SELECT page_id, url, {PAGE_TEXT_SQL} AS t FROM pages)""")
def s8_web_import(spark, sf_dir):
    a = I.import_web_pages(load(spark, sf_dir, "pages"))
    return a.select("document_id", "url", "size", "sha256")


@register("c5_mime_gate", f"""
WITH arts AS (
  SELECT CAST(doc_id AS VARCHAR) AS document_id, 'content.txt' AS name, 'text/plain' AS mime_type FROM documents
  UNION ALL
  SELECT CAST(page_id AS VARCHAR), 'content.url.extract.txt', 'text/plain' FROM pages
  UNION ALL
  SELECT CAST(page_id AS VARCHAR), 'page.html', 'text/html' FROM pages)
SELECT document_id, name, mime_type,
       CASE WHEN mime_type IN ('text/plain', 'text/markdown') THEN 'accept' ELSE 'reject' END AS decision
FROM arts""")
def c5_mime_gate(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    raw_html = pages.select(
        F.col("page_id").cast("string").alias("document_id"), F.lit("page.html").alias("name"),
        F.lit(I.MIME_HTML).alias("mime_type"), F.lit(I.TYPE_EXTRACTED_TEXT).alias("artifact_type"))
    cols = ["document_id", "name", "mime_type", "artifact_type"]
    arts = (I.import_text(_docs(spark, sf_dir)).select(*cols)
            .unionByName(I.import_web_pages(pages).select(*cols)).unionByName(raw_html))
    ok, rejected = I.partition_gate(arts)
    return (ok.select("document_id", "name", "mime_type", F.lit("accept").alias("decision"))
            .unionByName(rejected.select("document_id", "name", "mime_type", F.lit("reject").alias("decision"))))


# --- C7 / P1 --------------------------------------------------------------------

@register("c7_chunk_descriptors", BASE + """
SELECT document_id, part_no, part_id AS artifact_id, file_id AS parent_id, name, size, sha256,
       CAST(n_tokens AS INTEGER) AS n_tokens
FROM parts""")
def c7_chunk_descriptors(spark, sf_dir):
    return _parts(spark, sf_dir).select("document_id", "part_no", "artifact_id", "parent_id", "name", "size",
                                        "sha256", "n_tokens")


@register("p1_import_chunks", BASE + """
SELECT document_id, part_no, CAST(n_tokens AS INTEGER) AS n_tokens, sha256 FROM parts""")
def p1_import_chunks(spark, sf_dir):
    return _parts(spark, sf_dir).select("document_id", "part_no", "n_tokens", "sha256")


# --- E1 --------------------------------------------------------------------------

@register("e1_hashed_embedding", r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
b AS (SELECT doc_id, (('0x' || substr(md5(term), 1, 4))::INTEGER) % 64 AS bucket, count(*) AS c FROM t GROUP BY 1, 2),
n AS (SELECT doc_id, sqrt(sum(c * c)) AS norm FROM b GROUP BY 1)
SELECT b.doc_id, CAST(b.bucket AS INTEGER) AS bucket,
       round(CAST(CAST(b.c / n.norm AS FLOAT) AS DOUBLE), 6) AS weight
FROM b JOIN n USING (doc_id)""")
def e1_hashed_embedding(spark, sf_dir):
    v = E.embed(_docs(spark, sf_dir).select("doc_id", "text"))
    return (v.select("doc_id", F.posexplode("embedding").alias("bucket", "w"))
            .filter(F.col("w") != 0)
            .select("doc_id", F.col("bucket").cast("int").alias("bucket"),
                    F.round(F.col("w").cast("double"), 6).alias("weight")))


# --- E3 - E7 ---------------------------------------------------------------------

def _jobs(spark, sf_dir):
    return E.with_generators(E.embeddable(_parts(spark, sf_dir)), GENERATORS)


@register("e3_embedding_jobs", BASE + "," + JOBS_CTE + """
SELECT document_id, part_no, provider, generator, embedding_name FROM jobs""")
def e3_embedding_jobs(spark, sf_dir):
    j = _jobs(spark, sf_dir)
    return j.select("document_id", "part_no", "provider", "generator",
                    E.embedding_name(F.col("name"), F.col("provider"), F.col("generator")).alias("embedding_name"))


@register("e4_pending_embeddings", f"""
WITH RECURSIVE {chunk_ctes(LINE_LIMIT, PARAGRAPH_LIMIT, OVERLAP)},
{chunk_ctes(LINE_LIMIT, 120, 0, 'old_')},{FILES_CTE},{parts_cte()},{parts_cte('old_')},{JOBS_CTE}
SELECT document_id, part_no, provider, generator, embedding_name FROM jobs j
WHERE NOT (generator = 'hash64' AND EXISTS (SELECT 1 FROM old_parts o WHERE o.part_id = j.part_id AND o.sha256 = j.sha256))""")
def e4_pending_embeddings(spark, sf_dir):
    """Jobs left after an earlier run with other chunk limits and the first generator only: changed chunks, the new generator."""
    before = replace(PREVIOUS_OPTS, generators=GENERATORS[:1])
    earlier = write_once(P.embeddings(_parts(spark, sf_dir, before), before)
                         .select("source_partition_id", "provider", "generator", F.sha2("text", 256).alias("sha256")), "earlier")
    p = E.pending(_jobs(spark, sf_dir), earlier)
    return p.select("document_id", "part_no", "provider", "generator",
                    E.embedding_name(F.col("name"), F.col("provider"), F.col("generator")).alias("embedding_name"))


@register("e5_reuse_report", BASE + "," + JOBS_CTE + """
SELECT provider, generator, count(*) AS n_jobs, count(DISTINCT sha256) AS n_distinct,
       count(*) - count(DISTINCT sha256) AS saved_calls
FROM jobs GROUP BY provider, generator""")
def e5_reuse_report(spark, sf_dir):
    return E.reuse_report(_jobs(spark, sf_dir))


@register("e6_embedding_rows", BASE + "," + JOBS_CTE + f"""
SELECT document_id, part_no, generator, {_sid("part_id", "provider", "generator")} AS embedding_id,
       embedding_name, CAST(dim AS INTEGER) AS vector_size, part_id AS source_partition_id,
       '{STAMP}' AS timestamp
FROM jobs""")
def e6_embedding_rows(spark, sf_dir):
    rows = E.embed_jobs(_jobs(spark, sf_dir), GENERATORS, stamp=STAMP)
    return rows.select("document_id", "part_no", "generator", "embedding_id", "embedding_name", "vector_size",
                       "source_partition_id", "timestamp")


@register("e7_processed_gate", BASE + """
SELECT document_id, part_no FROM parts
WHERE document_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 1)""")
def e7_processed_gate(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    done_docs = load(spark, sf_dir, "labels").filter(F.col("quality") == 1).select(
        F.col("doc_id").cast("string").alias("document_id"))
    log = E.mark_processed(parts.join(done_docs, "document_id", "left_semi"), "generate_embeddings")
    return E.not_processed(parts, log, "generate_embeddings").select("document_id", "part_no")


# --- B ---------------------------------------------------------------------------

def _records(spark, sf_dir, opts=OPTS):
    return P.records(P.embeddings(_parts(spark, sf_dir, opts), opts), opts)


RID = "'d=' || document_id || '//p=' || part_id"


@register("b1_record_ids", BASE + f"""
SELECT document_id, part_no, {RID} AS record_id FROM parts""")
def b1_record_ids(spark, sf_dir):
    p = _parts(spark, sf_dir)
    return p.select("document_id", "part_no", R.record_id(F.col("document_id"), F.col("artifact_id")).alias("record_id"))


TAGS_SQL = """array_to_string(list_sort(list_filter([
  '__document_id:' || document_id, '__file_type:text/plain', '__file_id:' || file_id, '__file_part:' || part_id,
  'lang:' || lang, 'source:' || source], lambda x: x IS NOT NULL)), '|')"""


@register("b2_prepare_records", BASE + "," + JOBS_CTE + f"""
SELECT {RID} AS key, generator AS namespace, {TAGS_SQL} AS tags,
       'content.txt' AS file, '' AS url, provider AS vector_provider, generator AS vector_generator,
       '{STAMP}' AS last_update, sha256 AS text_sha256, CAST(dim AS INTEGER) AS vector_size
FROM jobs""")
def b2_prepare_records(spark, sf_dir):
    r = _records(spark, sf_dir)
    return r.select("key", "namespace", R.flat_tags(F.col("tags")).alias("tags"), F.col("payload.file").alias("file"),
                    F.col("payload.url").alias("url"), F.col("payload.vector_provider").alias("vector_provider"),
                    F.col("payload.vector_generator").alias("vector_generator"),
                    F.col("payload.last_update").alias("last_update"),
                    F.sha2(F.col("payload.text"), 256).alias("text_sha256"),
                    F.size("embedding").cast("int").alias("vector_size"))


@register("b4_records_without_vectors", BASE + f"""
SELECT {RID} AS record_id, 0 AS vector_size, '' AS vector_provider FROM parts""")
def b4_records_without_vectors(spark, sf_dir):
    rows = R.partitions_as_embeddings(_parts(spark, sf_dir))
    recs = R.prepare_records(rows, stamp=STAMP)
    return recs.select("record_id", F.size("embedding").alias("vector_size"),
                       F.col("payload.vector_provider").alias("vector_provider"))


@register("b5_stale_records", f"""
WITH RECURSIVE {chunk_ctes(LINE_LIMIT, PARAGRAPH_LIMIT, OVERLAP)},
{chunk_ctes(LINE_LIMIT, 120, 0, 'old_')},{FILES_CTE},{parts_cte()},{parts_cte('old_')}
SELECT 'd=' || o.document_id || '//p=' || o.part_id AS key, g.generator AS namespace
FROM old_parts o, (VALUES ('hash64'), ('hash32')) g(generator)
WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.document_id = o.document_id AND p.part_id = o.part_id)""")
def b5_stale_records(spark, sf_dir):
    previous = _records(spark, sf_dir, PREVIOUS_OPTS)
    current = _records(spark, sf_dir)
    return R.stale_records(previous, current).select("key", "namespace")


@register("b6_artifact_listing", BASE + """
SELECT document_id, artifact_type, count(*) AS n FROM (
  SELECT document_id, 'extracted_text' AS artifact_type FROM files
  UNION ALL SELECT document_id, 'text_partition' FROM parts
  UNION ALL SELECT document_id, 'text_embedding_vector' FROM parts
  UNION ALL SELECT document_id, 'text_embedding_vector' FROM parts) t
GROUP BY document_id, artifact_type""")
def b6_artifact_listing(spark, sf_dir):
    files = P.import_files(_docs(spark, sf_dir))
    parts = P.partitions(files, OPTS)
    emb = P.embeddings(parts, OPTS).select("document_id", F.col("embedding_type").alias("artifact_type"))
    arts = (files.select("document_id", "artifact_type").unionByName(parts.select("document_id", "artifact_type"))
            .unionByName(emb))
    listed = I.artifacts_of_type(arts, I.TYPE_EXTRACTED_TEXT, I.TYPE_TEXT_PARTITION, I.TYPE_EMBEDDING)
    return listed.groupBy("document_id", "artifact_type").agg(F.count(F.lit(1)).alias("n"))


@register("b7_fan_out", BASE + f"""
SELECT t.target, {RID} AS record_id FROM parts, (VALUES ('primary'), ('replica')) t(target)""")
def b7_fan_out(spark, sf_dir):
    recs = R.prepare_records(R.partitions_as_embeddings(_parts(spark, sf_dir)), stamp=STAMP)
    return R.fan_out(recs, ["primary", "replica"]).select("target", "record_id")


@register("b8_metadata_size")
def b8_metadata_size(spark, sf_dir):
    recs = _records(spark, sf_dir).withColumnRenamed("key", "record_id")
    valid, too_large = R.validate_metadata(recs, limit=4096)
    return (valid.select("record_id", "metadata_bytes", F.lit(True).alias("valid"))
            .unionByName(too_large.select("record_id", "metadata_bytes", F.lit(False).alias("valid"))))


@register("p3_full_ingest", BASE + "," + JOBS_CTE + f"""
SELECT 'memory' AS collection, generator AS namespace, {RID} AS key, document_id,
       CAST(dim AS INTEGER) AS vector_size, sha256 AS text_sha256, '{STAMP}' AS last_update
FROM jobs""")
def p3_full_ingest(spark, sf_dir):
    files = P.import_files(_docs(spark, sf_dir))
    previous = P.ingest(None, files, PREVIOUS_OPTS)
    state = P.ingest(previous, files, OPTS)
    return state.select("collection", "namespace", "key", "document_id",
                        F.size("embedding").cast("int").alias("vector_size"),
                        F.sha2(F.col("payload.text"), 256).alias("text_sha256"),
                        F.col("payload.last_update").alias("last_update"))


# --- P3 over two runs: one collection with edits, one with a replaced generator -----

REVISED_STAMP = "2024-02-01T00:00:00"
MEMORY_OPTS = (OPTS, replace(OPTS, stamp=REVISED_STAMP))
ARCHIVE_OPTS = (replace(OPTS, collection="archive", generators=GENERATORS[:1]),
                replace(OPTS, collection="archive", generators=GENERATORS[1:], stamp=REVISED_STAMP))


def revised_documents(spark, sf_dir):
    """The next state of ``documents``: by ``doc_id % 3`` cut to the first half, emptied, or untouched."""
    cut = F.expr("substring(text, 1, cast(floor(length(text) / 2) as int))")
    m = F.col("doc_id") % 3
    return _docs(spark, sf_dir).withColumn("text", F.when(m == 0, cut).when(m == 1, F.lit("")).otherwise(F.col("text")))


@register("p3_reingest", f"""WITH RECURSIVE
revised AS (SELECT * REPLACE (CASE doc_id % 3 WHEN 0 THEN substr(text, 1, length(text) // 2) WHEN 1 THEN '' ELSE text END AS text)
            FROM documents),
{chunk_ctes(LINE_LIMIT, PARAGRAPH_LIMIT, OVERLAP, src="revised")},{FILES_CTE},{parts_cte()},
runs AS (SELECT * FROM (VALUES ('memory', 'hash64', 64), ('memory', 'hash32', 32), ('archive', 'hash32', 32)) r(collection, generator, dim)),
words AS (SELECT part_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS term FROM parts),
buckets AS (
  SELECT part_id, dim, (('0x' || substr(md5(term), 1, 4))::INTEGER) % dim AS bucket, count(*) AS c
  FROM words, (VALUES (64), (32)) d(dim) GROUP BY ALL),
norms AS (SELECT part_id, dim, sqrt(sum(c * c)) AS norm FROM buckets GROUP BY ALL),
vectors AS (
  SELECT part_id, dim, sum(CAST(CAST(c / norm AS FLOAT) AS DOUBLE) * (bucket + 1)) AS emb_check
  FROM buckets JOIN norms USING (part_id, dim) GROUP BY ALL)
SELECT r.collection, r.generator AS namespace, {RID} AS key, document_id, r.dim AS vector_size, sha256 AS text_sha256,
       CASE WHEN r.collection = 'memory' AND CAST(document_id AS BIGINT) % 3 = 2 THEN '{STAMP}' ELSE '{REVISED_STAMP}' END AS last_update,
       round(coalesce(v.emb_check, 0), 4) AS emb_check
FROM parts CROSS JOIN runs r LEFT JOIN vectors v USING (part_id, dim)""")
def p3_reingest(spark, sf_dir):
    """Both collections ingested, then again from the revised documents; unchanged documents keep their first stamp."""
    first, second = P.import_files(_docs(spark, sf_dir)), P.import_files(revised_documents(spark, sf_dir))
    state, known = P.ingest_changed(None, None, first, MEMORY_OPTS[0])
    archive, also = P.ingest_changed(None, None, first, ARCHIVE_OPTS[0])
    state, known = state.unionByName(archive), known.unionByName(also)
    for opts in (MEMORY_OPTS[1], ARCHIVE_OPTS[1]):
        state, known = P.ingest_changed(state, known, second, opts)
    weighted = F.transform("embedding", lambda x, i: x.cast("double") * (i + 1))
    return state.select("collection", "namespace", "key", "document_id", F.size("embedding").cast("int").alias("vector_size"),
                        F.sha2(F.col("payload.text"), 256).alias("text_sha256"), F.col("payload.last_update").alias("last_update"),
                        F.round(F.aggregate(weighted, F.lit(0.0).cast("double"), lambda a, x: a + x), 4).alias("emb_check"))


@register("e2_embeddable", BASE + """
SELECT document_id, count(*) AS n_embeddable FROM parts GROUP BY document_id""")
def e2_embeddable(spark, sf_dir):
    files = P.import_files(_docs(spark, sf_dir))
    parts = _parts(spark, sf_dir)
    cols = ["document_id", "artifact_type", "mime_type"]
    emb = parts.select("document_id", F.lit(I.TYPE_EMBEDDING).alias("artifact_type"),
                       F.lit(I.MIME_EMBEDDING).alias("mime_type"))
    arts = files.select(*cols).unionByName(parts.select(*cols)).unionByName(emb)
    return E.embeddable(arts).groupBy("document_id").agg(F.count(F.lit(1)).alias("n_embeddable"))


@register("p2_import_steps", BASE + """
SELECT document_id, part_no, CAST(n_tokens AS INTEGER) AS n_tokens, sha256 FROM parts""")
def p2_import_steps(spark, sf_dir):
    steps = [lambda df: I.partition_gate(df)[0],
             lambda df: I.partition_artifacts(df, max_tokens_per_line=LINE_LIMIT,
                                              max_tokens_per_paragraph=PARAGRAPH_LIMIT, overlap_tokens=OVERLAP)]
    out = P.run_steps(P.import_files(_docs(spark, sf_dir)), steps)
    return out.select("document_id", "part_no", "n_tokens", "sha256")


@register("b3_save_embeddings", BASE + "," + JOBS_CTE + """
SELECT document_id, generator, count(*) AS n_records, CAST(min(dim) AS INTEGER) AS vector_size FROM jobs
GROUP BY document_id, generator""")
def b3_save_embeddings(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return recs.groupBy("document_id", F.col("namespace").alias("generator")).agg(
        F.count(F.lit(1)).alias("n_records"), F.min(F.size("embedding")).cast("int").alias("vector_size"))
