"""Derived tables used by the registered queries.

Each view exists twice: as a Spark DataFrame built from the parquet tables and
as a DuckDB CTE over the same tables. The SQL form feeds the independent
oracle; the two are written separately, not generated from each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memweave.sources.tables import load


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per embedding; metadata from documents by a left join."""
    e = load(spark, sf_dir, "embeddings")
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return (e.join(d, e["vec_id"] == d["doc_id"], "left")
            .select(F.concat(F.lit("c"), (F.col("label") % 3).cast("string")).alias("collection"),
                    F.concat(F.lit("ns"), (F.col("vec_id") % 4).cast("string")).alias("namespace"),
                    F.col("vec_id").cast("string").alias("key"),
                    (F.col("vec_id") % 50).cast("string").alias("document_id"),
                    "embedding", "lang", "source"))


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert batch against ``records``.

    ``vec_id % 3 = 0``: same metadata, reversed vector (classified skip);
    ``% 3 = 1``: changed ``lang`` (update); ``% 3 = 2``: new keys
    ``vec_id + 1000000`` (upsert). Keys with ``% 15 = 1`` appear a second time
    later in the batch with another ``source`` (last one wins). ``seq`` orders
    the batch.
    """
    e = load(spark, sf_dir, "embeddings")
    d = load(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    base = e.join(d, e["vec_id"] == d["doc_id"], "left")
    m = F.col("vec_id") % 3
    key = F.when(m == 2, F.col("vec_id") + 1000000).otherwise(F.col("vec_id"))
    first = base.select(
        F.concat(F.lit("c"), (F.col("label") % 3).cast("string")).alias("collection"),
        F.concat(F.lit("ns"), (F.col("vec_id") % 4).cast("string")).alias("namespace"),
        key.cast("string").alias("key"),
        (F.col("vec_id") % 50).cast("string").alias("document_id"),
        F.when(m == 0, F.reverse("embedding")).otherwise(F.col("embedding")).alias("embedding"),
        F.when(m == 1, F.concat(F.coalesce(F.col("lang"), F.lit("")), F.lit("-v2"))).otherwise(F.col("lang")).alias("lang"),
        F.col("source"),
        F.col("vec_id").alias("seq"))
    second = (first.filter((F.col("seq") % 15) == 1)
              .withColumn("source", F.lit("dup"))
              .withColumn("seq", F.col("seq") + 2000000))
    return first.unionByName(second)


def collections_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of collections: every collection of ``records`` is Ready, plus one pending."""
    rec = records(spark, sf_dir).select(F.col("collection").alias("name")).distinct()
    ready = rec.select("name", F.lit("Ready").alias("state"))
    pending = spark.createDataFrame([("c_pending", "Initializing")], "name string, state string")
    return ready.unionByName(pending)


def request_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys asked for by a batch get: every labelled document id, quality-1 ids twice."""
    lab = load(spark, sf_dir, "labels")
    once = lab.select((F.col("doc_id") * 2).cast("bigint").alias("ord"), F.col("doc_id").cast("string").alias("key"))
    twice = (lab.filter(F.col("quality") == 1)
             .select((F.col("doc_id") * 2 + 1).cast("bigint").alias("ord"), F.col("doc_id").cast("string").alias("key")))
    return once.unionByName(twice)


# ---------------------------------------------------------------------------
# DuckDB forms (oracle side)
# ---------------------------------------------------------------------------

SQL_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "records": ("""
SELECT 'c' || CAST(e.label % 3 AS VARCHAR) AS collection,
       'ns' || CAST(e.vec_id % 4 AS VARCHAR) AS namespace,
       CAST(e.vec_id AS VARCHAR) AS key,
       CAST(e.vec_id % 50 AS VARCHAR) AS document_id,
       e.embedding, d.lang, d.source
FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id""", ()),
    "incoming_first": ("""
SELECT 'c' || CAST(e.label % 3 AS VARCHAR) AS collection,
       'ns' || CAST(e.vec_id % 4 AS VARCHAR) AS namespace,
       CAST(CASE WHEN e.vec_id % 3 = 2 THEN e.vec_id + 1000000 ELSE e.vec_id END AS VARCHAR) AS key,
       CAST(e.vec_id % 50 AS VARCHAR) AS document_id,
       CASE WHEN e.vec_id % 3 = 0 THEN list_reverse(e.embedding) ELSE e.embedding END AS embedding,
       CASE WHEN e.vec_id % 3 = 1 THEN coalesce(d.lang, '') || '-v2' ELSE d.lang END AS lang,
       d.source, e.vec_id AS seq
FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id""", ()),
    "incoming": ("""
SELECT * FROM incoming_first
UNION ALL
SELECT collection, namespace, key, document_id, embedding, lang, 'dup' AS source, seq + 2000000 AS seq
FROM incoming_first WHERE seq % 15 = 1""", ("incoming_first",)),
    "registry": ("""
SELECT DISTINCT collection AS name, 'Ready' AS state FROM records
UNION ALL SELECT 'c_pending' AS name, 'Initializing' AS state""", ("records",)),
    "request_keys": ("""
SELECT CAST(doc_id * 2 AS BIGINT) AS ord, CAST(doc_id AS VARCHAR) AS key FROM labels
UNION ALL
SELECT CAST(doc_id * 2 + 1 AS BIGINT) AS ord, CAST(doc_id AS VARCHAR) AS key FROM labels WHERE quality = 1""", ()),
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for dep in SQL_VIEWS[n][1]:
            visit(dep)
        ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n][0]}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"


def register_sql_view(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    SQL_VIEWS[name] = (sql, deps)
