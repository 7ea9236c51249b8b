"""Embedding stage.

The embedder is pluggable: any function ``Column(text) -> Column(array<float>)``
(typically a pandas UDF calling a model). The built-in default is a hashed
term-frequency vector: lower-cased letter/digit terms, bucket = first 16 bits
of the term's MD5 modulo ``dim``, L2-normalised. It is a deterministic stand-in
for a hosted model, not a replacement for one.

Hashing runs in the JVM; only the per-row bucket arrays (ints) travel to a
vectorised NumPy ``bincount`` in an Arrow-batched pandas UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memweave.functions.parallel import spread
from memweave.functions.sizing import broadcast_if_small
from memweave.operators.ingest import (EMBEDDING_EXTENSION, MIME_EMBEDDING, PARTITIONABLE_MIME,
                                       TYPE_EMBEDDING, TYPE_SYNTHETIC_DATA, TYPE_TEXT_PARTITION)
from memweave.operators.search import terms
from memweave.session import materialize

Embedder = Callable[[Column], Column]
DEFAULT_DIM = 64
#: Jobs of one text that are gathered in a row; those of a text with more are joined to its vectors.
GROUP_JOBS = 1000


def term_buckets(text: Column, dim: int) -> Column:
    """Bucket of every term: ``conv(substr(md5(term), 1, 4), 16, 10) % dim``."""
    return F.transform(terms(text), lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int"), F.lit(dim)))


def _bincount_l2(dim: int):
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def bincount_l2(buckets: pd.Series) -> pd.Series:
        n = len(buckets)
        lens = np.fromiter((0 if b is None else len(b) for b in buckets), dtype=np.int64, count=n)
        out = np.zeros((n, dim), dtype=np.float64)
        if lens.sum():
            flat = np.concatenate([np.asarray(b, dtype=np.int64) for b in buckets if b is not None and len(b)])
            rows = np.repeat(np.arange(n), lens)
            np.add.at(out, (rows, flat), 1.0)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        out = np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)
        return pd.Series(list(out.astype(np.float32)))

    return bincount_l2


def hashed_embedder(dim: int = DEFAULT_DIM) -> Embedder:
    """E1 default: hashed term-frequency vector of ``dim`` floats, L2-normalised."""
    udf = _bincount_l2(dim)
    return lambda text: udf(term_buckets(text, dim))


def embed(df: DataFrame, *, embedder: Embedder | None = None, text_col: str = "text",
          out_col: str = "embedding", strict: bool = False) -> DataFrame:
    """Add the vector of each text.

    A NULL or empty vector is an error (``strict``, the job fails) or a NULL
    ``out_col`` the caller can route to rejects.
    """
    embedder = embedder or hashed_embedder()
    v = embedder(F.col(text_col))
    out = spread(df).withColumn(out_col, v)
    bad = F.col(out_col).isNull() | (F.size(out_col) == 0)
    if strict:
        out = out.filter(F.when(bad, F.raise_error(F.lit("embedding generator returned no vector"))).otherwise(F.lit(True)))
    return out


def embeddable(artifacts: DataFrame) -> DataFrame:
    """Partitions and synthetic data in plain text or markdown."""
    return artifacts.filter(F.col("artifact_type").isin(TYPE_TEXT_PARTITION, TYPE_SYNTHETIC_DATA)
                            & F.col("mime_type").isin(*PARTITIONABLE_MIME))


def provider_name(class_name: Column) -> Column:
    """provider = last three dotted parts of the generator's class name."""
    return F.substring_index(class_name, ".", -3)


def with_generators(partitions: DataFrame, generators: Sequence[tuple[str, str, int]]) -> DataFrame:
    """One job per (partition, generator).

    Generators are a short configuration list, so each partition row is
    expanded with ``explode`` over a literal array (no join).
    """
    gens = F.array(*[F.struct(F.lit(p).alias("provider_class"), F.lit(g).alias("generator"), F.lit(int(d)).alias("dim"))
                     for p, g, d in generators])
    return (partitions.withColumn("_gen", F.explode(gens))
            .withColumn("provider", provider_name(F.col("_gen.provider_class")))
            .withColumn("generator", F.col("_gen.generator"))
            .withColumn("dim", F.col("_gen.dim")).drop("_gen"))


def embedding_name(part_name: Column, provider: Column, generator: Column) -> Column:
    """``{partition file}.{provider}.{generator}.text_embedding``."""
    return F.concat(part_name, F.lit("."), provider, F.lit("."), generator, F.lit(EMBEDDING_EXTENSION))


def pending(jobs: DataFrame, existing: DataFrame) -> DataFrame:
    """Drop jobs whose (partition, provider, generator) already has an embedding.

    When ``existing`` also carries the ``sha256`` of the text it was made from
    (E5), a job is skipped only if its text is unchanged: partition ids are
    positional, so an edited document must not keep a stale vector.
    """
    cols = ["artifact_id", "provider", "generator"] + (["sha256"] if "sha256" in existing.columns else [])
    keys = existing.select(F.col("source_partition_id").alias("artifact_id"), *cols[1:]).distinct()
    return jobs.join(broadcast_if_small(keys), cols, "left_anti")


def not_processed(artifacts: DataFrame, log: DataFrame, step: str) -> DataFrame:
    """Artifacts the ``step`` has not handled yet (``log`` holds (artifact_id, step))."""
    done = log.filter(F.col("step") == step).select("artifact_id").distinct()
    return artifacts.join(done, "artifact_id", "left_anti")


def mark_processed(artifacts: DataFrame, step: str) -> DataFrame:
    """Log rows to append after a step ran."""
    return artifacts.select("artifact_id", F.lit(step).alias("step"))


def with_existing(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """E5: partitions or jobs with ``_stored``, the (provider, generator, embedding) of earlier runs for the same text.

    The vectors of all generators of a partition meet it in one join, so partitions can be joined before they are
    expanded to jobs. Where ``existing`` names documents, a vector is taken for its own document only.
    """
    keys = ["artifact_id", "sha256"] + (["document_id"] if "document_id" in existing.columns else [])
    stored = existing.withColumnRenamed("source_partition_id", "artifact_id").groupBy(*keys).agg(
        F.collect_list(F.struct("provider", "generator", "embedding")).alias("_stored"))
    return rows.join(stored, keys, "left")


def embed_jobs(jobs: DataFrame, generators: Sequence[tuple[str, str, int]], *,
               embedders: dict[str, Embedder] | None = None, stamp: str,
               existing: DataFrame | None = None) -> DataFrame:
    """E5 + E6: embed each distinct text once per generator, build embedding rows.

    ``generators`` is the configuration the jobs were expanded with;
    ``embedders`` maps generator name to embedder, and generators without one
    use the hashed default of their ``dim``. ``stamp`` is the run time (a
    parameter, so reruns are reproducible). ``existing`` (source_partition_id,
    provider, generator, sha256, embedding) holds vectors of an earlier run:
    a job whose partition text is unchanged keeps its stored vector and only
    the others are embedded. Jobs that come from ``with_existing`` already
    carry theirs.
    """
    embedders = embedders or {}
    if existing is not None:
        jobs = with_existing(jobs, existing)
    reuse = "_stored" in jobs.columns
    if reuse:
        own = F.filter("_stored", lambda s: (s["provider"] == F.col("provider")) & (s["generator"] == F.col("generator")))
        jobs = jobs.withColumn("_own", F.explode_outer(own)).withColumn("_old", F.col("_own.embedding")).drop("_own", "_stored")
        todo = jobs.filter(F.col("_old").isNull())
    else:
        todo = jobs

    def embedded(texts: DataFrame) -> DataFrame:
        for i, (_cls, gen, dim) in enumerate(generators):
            texts = texts.withColumn(f"_v{i}", (embedders.get(gen) or hashed_embedder(int(dim)))(F.col("text")))
        return texts

    def picked(rows: DataFrame) -> DataFrame:
        vector = F.lit(None)
        for i, (_cls, gen, _dim) in enumerate(generators):
            vector = F.when(F.col("generator") == gen, F.col(f"_v{i}")).otherwise(vector)
        return rows.withColumn("embedding", vector).select(*jobs.columns, "embedding")

    # E5: every distinct text (by SHA-256) is embedded once per generator. The jobs of a text travel with it, so the text
    # is shuffled once; those of a text with many jobs stay where they are and its vectors are joined to them.
    todo = todo.filter(F.col("sha256").isNotNull())
    hashed = F.xxhash64("sha256")
    frequent = materialize(todo.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP_JOBS)
                           .select("_hash"), "frequent")
    common = None
    if not frequent.isEmpty():
        listed = broadcast_if_small(frequent)
        common = todo.join(listed, hashed == F.col("_hash"), "left_semi")
        todo = todo.join(listed, hashed == F.col("_hash"), "left_anti")
    rest = [c for c in jobs.columns if c not in ("sha256", "text")]
    # Placed before they are grouped: gathered in the scan's larger tasks they would spill.
    grouped = todo.repartition("sha256").groupBy("sha256").agg(F.first("text").alias("text"), F.collect_list(F.struct(*rest)).alias("_jobs"))
    out = picked(embedded(grouped).withColumn("_job", F.explode("_jobs")).select("*", "_job.*"))
    if common is not None:
        vectors = embedded(common.select("sha256", "text").dropDuplicates(["sha256"])).drop("text")
        out = out.unionByName(picked(common.join(vectors, "sha256")))
    if reuse:
        kept = jobs.filter(F.col("_old").isNotNull() | F.col("sha256").isNull())
        out = out.unionByName(kept.withColumn("embedding", F.col("_old")))
    bad = F.col("embedding").isNull() | (F.size("embedding") == 0)
    out = out.filter(F.when(bad, F.raise_error(F.lit("embedding generator returned no vector"))).otherwise(F.lit(True)))
    return embedding_rows(out, stamp)


def embedding_rows(out: DataFrame, stamp: str) -> DataFrame:
    """The embedding artifact rows of jobs that carry a vector."""
    return out.select(
        "document_id", "file_id",
        F.sha2(F.concat_ws("/", "artifact_id", "provider", "generator"), 256).substr(1, 32).alias("embedding_id"),
        F.col("artifact_id").alias("source_partition_id"),
        embedding_name(F.col("name"), F.col("provider"), F.col("generator")).alias("embedding_name"),
        F.lit(MIME_EMBEDDING).alias("embedding_mime"), F.lit(TYPE_EMBEDDING).alias("embedding_type"),
        "provider", "generator", "embedding", F.size("embedding").cast("int").alias("vector_size"),
        F.lit(stamp).alias("timestamp"), "tags", "text", "url", "name", "file_name", "upload_mime",
        "part_no", "sha256")


def reuse_report(jobs: DataFrame) -> DataFrame:
    """E5: per generator, jobs, distinct texts and calls saved by reuse."""
    return jobs.groupBy("provider", "generator").agg(
        F.count(F.lit(1)).alias("n_jobs"), F.countDistinct("sha256").alias("n_distinct"),
    ).withColumn("saved_calls", F.col("n_jobs") - F.col("n_distinct"))
