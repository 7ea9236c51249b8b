"""Composed document ingest (P1-P3): plain function composition of the operators."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from memweave.functions.sizing import broadcast_if_small, is_small
from memweave.operators import collections as C
from memweave.operators import embedding as E
from memweave.operators import ingest as I
from memweave.operators import records as R
from memweave.session import materialize as write_once


@dataclass(frozen=True)
class IngestOptions:
    max_tokens_per_line: int = 40
    max_tokens_per_paragraph: int = 200
    overlap_tokens: int = 20
    count_mode: str = "whitespace"
    collection: str = "memory"
    generators: Sequence[tuple[str, str, int]] = (
        ("org.example.memweave.embedding.HashedTermEmbedder", "hash64", 64),
    )
    stamp: str = "2024-01-01T00:00:00"
    embedders: dict = field(default_factory=dict)


def import_files(documents: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """S7 + S8: extracted-text artifacts of documents and fetched pages."""
    parts = []
    if documents is not None:
        parts.append(I.import_text(documents))
    if pages is not None:
        parts.append(I.import_web_pages(pages))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def partitions(files: DataFrame, opts: IngestOptions, *, materialize: bool = False) -> DataFrame:
    """Gate (C5) and partition (C1-C4, C6, C7); returns chunk artifacts.

    With ``materialize`` the partitions are written once to the shared
    checkpoint folder (as the pipeline writes partition files to storage), so
    the embedding stage reads them instead of re-chunking per generator.
    """
    accepted, _rejected = I.partition_gate(files)
    parts = I.partition_artifacts(accepted, max_tokens_per_line=opts.max_tokens_per_line,
                                  max_tokens_per_paragraph=opts.max_tokens_per_paragraph,
                                  overlap_tokens=opts.overlap_tokens, mode=opts.count_mode)
    if materialize:
        parts = write_once(parts, "partitions", "zstd")
    return parts


def embeddings(parts: DataFrame, opts: IngestOptions, existing: DataFrame | None = None) -> DataFrame:
    """Embedding rows of every partition.

    With ``existing`` (vectors of an earlier run with their text hashes) only
    new or changed partitions are embedded; unchanged ones reuse their vector.
    The partitions are then written once with their stored vectors, for both
    the texts to embed and the rows.
    """
    parts = E.embeddable(parts)
    if existing is not None:
        parts = write_once(E.with_existing(parts, existing), "partitions", "zstd")
    jobs = E.with_generators(parts, opts.generators)
    return E.embed_jobs(jobs, opts.generators, embedders=opts.embedders, stamp=opts.stamp)


def stored_embeddings(state: DataFrame) -> DataFrame:
    """Vectors of a records state, keyed as embedding jobs are (for reuse on re-ingest)."""
    return state.select("document_id", F.col("part_id").alias("source_partition_id"),
                        F.col("payload.vector_provider").alias("provider"),
                        F.col("payload.vector_generator").alias("generator"),
                        F.sha2(F.col("payload.text"), 256).alias("sha256"), "embedding")


def own_records(state: DataFrame, opts: IngestOptions) -> DataFrame:
    """The records of a run's collection; its documents are matched with the partitions (``E.with_existing``)."""
    return state.filter(F.col("collection") == F.lit(opts.collection))


def records(emb_rows: DataFrame, opts: IngestOptions) -> DataFrame:
    """Collection rows keyed by record id, one namespace per generator."""
    recs = R.prepare_records(emb_rows, stamp=opts.stamp).withColumn("namespace", F.col("payload.vector_generator"))
    return recs.select(F.lit(opts.collection).alias("collection"), "namespace", F.col("record_id").alias("key"),
                       "document_id", "file_id", "part_id", "embedding", "tags", "payload")


def ingest(state: DataFrame | None, files: DataFrame, opts: IngestOptions) -> DataFrame:
    """Chunks -> embeddings -> records -> purge stale -> upsert. Returns the new state.

    Only records of ``opts.collection`` and of the documents in ``files`` are
    read for reuse, purged or replaced; a document that gives no chunk any
    more loses all its records there.
    """
    existing = None
    if state is not None:
        # Only vectors of the run's generators can be reused; without any, nothing is joined.
        existing = stored_embeddings(own_records(state, opts)).filter(F.col("generator").isin([g for _p, g, _d in opts.generators]))
        documents = write_once(files.select("document_id").distinct(), "documents")
        if is_small(documents):
            existing = existing.join(F.broadcast(documents), "document_id", "left_semi")
        existing = None if existing.isEmpty() else existing
    parts = partitions(files, opts, materialize=existing is None)
    # The run's records feed both the upsert and the returned state: write them once to
    # the shared checkpoint folder instead of recomputing chunks and vectors.
    new = write_once(records(embeddings(parts, opts, existing), opts), "records", "zstd")
    if state is None:
        return new
    kept = R.purge(state, documents, collection=opts.collection)
    # Record keys are unique within a run, so every row carries the same sequence number.
    return C.upsert(kept, new.withColumn("seq", F.lit(0)), dedupe=False, hits_in=F.col("collection") == F.lit(opts.collection))


def file_digests(files: DataFrame, opts: IngestOptions) -> DataFrame:
    """(collection, document_id, digest): one digest of all of a document's files and of the options that shape its records.

    Text hashes, tags, urls, chunk limits and generator names count; the stamp does not, nor does the code behind a
    generator's name (a changed embedder needs a new name).
    """
    setup = json.dumps([opts.max_tokens_per_line, opts.max_tokens_per_paragraph, opts.overlap_tokens, opts.count_mode,
                        [list(g) for g in opts.generators]])
    url = F.col("url") if "url" in files.columns else F.lit(None).cast("string")
    parts = F.array("file_id", "name", "mime_type", url, "sha256", R.flat_tags(F.col("tags")))
    one = F.to_json(F.transform(parts, lambda x: F.coalesce(x, F.lit("\0"))))
    return (files.groupBy("document_id").agg(F.array_sort(F.collect_list(one)).alias("_files"))
            .select(F.lit(opts.collection).alias("collection"), "document_id",
                    F.sha2(F.concat_ws("\n", F.lit(setup), "_files"), 256).alias("digest")))


def ingest_changed(state: DataFrame | None, manifest: DataFrame | None, files: DataFrame,
                   opts: IngestOptions) -> tuple[DataFrame, DataFrame]:
    """P3/E5 across runs: ``ingest`` of those documents only whose digest is not in the manifest of earlier runs.

    Returns the new state and manifest (collection, document_id, digest). A document with an equal digest is neither
    chunked, hashed by chunk, embedded, purged nor rewritten: its records keep their old stamp. An edited one is ingested
    whole (unchanged chunks keep their vector); one whose files became empty loses its records; a replaced generator
    changes every digest of the collection. Documents that are not in ``files`` stay as they are. Only ids and digests
    are shuffled to find the changes.
    """
    digests = write_once(file_digests(files, opts), "digests")
    if state is None or manifest is None:
        return ingest(state, files, opts), digests
    keys = ["collection", "document_id"]
    changed = write_once(digests.join(manifest, [*keys, "digest"], "left_anti").select("document_id"), "changed")
    due = files.join(broadcast_if_small(changed), "document_id", "left_semi")
    return ingest(state, due, opts), manifest.join(digests, keys, "left_anti").unionByName(digests)


def run_steps(files: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Import with selectable steps, applied in order with ``DataFrame.transform``."""
    out = files
    for step in steps:
        out = out.transform(step)
    return out
