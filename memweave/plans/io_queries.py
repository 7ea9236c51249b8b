"""Registered file and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from memweave.plans.catalog import register
from memweave.plans.collection_queries import META, STATE_SQL, U2_SQL, _not_in, _state_out
from memweave.plans.fixtures import incoming, records, with_views
from memweave.plans.text_queries import WORD_RE2
from memweave.session import scratch_dir
from memweave.sources import files as FS
from memweave.sources import store
from memweave.sources.tables import TABLES, load, stream_source
from memweave.streaming.upserts import run_upsert_stream
from memweave.streaming.usage import run_usage_stream


@register("s1_file_scan")
def s1_file_scan(spark, sf_dir):
    f = FS.with_sha256(FS.scan_files(spark, sf_dir, glob="*.parquet"), sf_dir, suffix=".parquet")
    return f.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length", "sha256")


@register("s2_file_inventory")
def s2_file_inventory(spark, sf_dir):
    wanted = spark.createDataFrame([(f"{t}.parquet",) for t in TABLES] + [("missing.parquet",)], "path string")
    return FS.file_inventory(spark, wanted, sf_dir, glob="*.parquet").select("path", "exists", "length")


U3_STATE_SQL = with_views(f"""
, labelled AS ({U2_SQL}),
changes AS (
  SELECT i.* FROM incoming i JOIN labelled l ON l.key = i.key AND l.seq = i.seq AND l.collection = i.collection
  WHERE l.op <> 'skip'
  QUALIFY row_number() OVER (PARTITION BY i.collection, i.namespace, i.key ORDER BY i.seq DESC) = 1)
SELECT {STATE_SQL} FROM (
  SELECT r.* FROM records r WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE {_not_in('c', 'r')})
  UNION ALL
  SELECT collection, namespace, key, document_id, embedding, lang, source FROM changes)""", "records", "incoming")


@register("p4_stream_upsert", U3_STATE_SQL)
def p4_stream_upsert(spark, sf_dir):
    base = scratch_dir(spark, "p4")
    state_path, source_dir = f"{base}/state", f"{base}/incoming"
    store.create_state(records(spark, sf_dir), state_path)
    inc = incoming(spark, sf_dir)
    # Three arriving batches of part files: even and odd sequence numbers, then the repeats.
    first = F.col("seq") < 2000000
    for part in (first & (F.col("seq") % 2 == 0), first & (F.col("seq") % 2 == 1), ~first):
        inc.filter(part).write.mode("append").parquet(source_dir)
        run_upsert_stream(spark, source_dir=source_dir, schema=inc.schema, state_path=state_path, files_per_batch=None,
                          checkpoint_path=f"{base}/checkpoint", report_path=f"{base}/report", metadata_cols=META)
    return _state_out(store.read_state(spark, state_path))


@register("p5_stream_usage", f"""
SELECT role, count(*) AS n_messages,
       CAST(sum(len(regexp_extract_all(coalesce(text, ''), '{WORD_RE2}'))) AS BIGINT) AS tokens
FROM conversations GROUP BY role""")
def p5_stream_usage(spark, sf_dir):
    base = scratch_dir(spark, "p5")
    conv = load(spark, sf_dir, "conversations")
    source, glob = stream_source(spark, sf_dir, "conversations")
    run_usage_stream(spark, source=source, glob=glob, schema=conv.schema,
                     out_path=f"{base}/usage", checkpoint_path=f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/usage")


# --- P4 over the events table: weekly files streamed in time order ---------------

def event_records(spark, sf_dir):
    """One record per (event type, user): metadata = value and props; later events win."""
    ev = load(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("collection"), F.lit("").alias("namespace"),
                     F.col("user_id").cast("string").alias("key"), "value", "props", "ts",
                     F.col("ts").alias("seq"))


@register("p4_event_stream", """
SELECT event_type AS collection, '' AS namespace, CAST(user_id AS VARCHAR) AS key, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) = 1""")
def p4_event_stream(spark, sf_dir):
    from memweave.operators import collections as C

    base = scratch_dir(spark, "p4e")
    state_path, source_dir = f"{base}/state", f"{base}/events"
    recs = event_records(spark, sf_dir).withColumn("_week", F.date_trunc("week", "ts"))
    # The calendar weeks present are a handful of values; each week arrives as one batch of part files.
    weeks = sorted(r["_week"] for r in recs.select("_week").distinct().collect())
    first = recs.filter(F.col("_week") == weeks[0]).drop("_week")
    store.create_state(C.latest_per_key(first).drop("seq"), state_path)
    for w in weeks[1:]:
        recs.filter(F.col("_week") == w).drop("_week").write.mode("append").parquet(source_dir)
        run_upsert_stream(spark, source_dir=source_dir, schema=first.schema, state_path=state_path, files_per_batch=None,
                          checkpoint_path=f"{base}/checkpoint", report_path=f"{base}/report",
                          metadata_cols=["value", "props"])
    return store.read_state(spark, state_path).select("collection", "namespace", "key", "value", "props")


@register("s3_write_table", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def s3_write_table(spark, sf_dir):
    """S3: create a table in a fresh folder (refusing to overwrite), read it back."""
    path = f"{scratch_dir(spark, 's3')}/pages"
    pages = load(spark, sf_dir, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))
    FS.write_table(pages, path, mode="errorifexists")
    return spark.read.parquet(path)
