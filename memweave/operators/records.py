"""Memory records (B1-B8): build, fan out, validate and purge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memweave.functions.sizing import broadcast_if_small, is_small
from memweave.session import materialize

# --- fixed values: reserved tag and payload names ---------------------------
TAG_DOCUMENT_ID = "__document_id"
TAG_FILE_TYPE = "__file_type"
TAG_FILE_ID = "__file_id"
TAG_FILE_PART = "__file_part"
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# ---------------------------------------------------------------------------


def record_id(document_id: Column, part_id: Column) -> Column:
    """B1: ``d={documentId}//p={partId}``."""
    return F.concat(F.lit("d="), document_id, F.lit("//p="), part_id)


def merge_tags(reserved: Sequence[tuple[str, Column]], user: Column) -> Column:
    """B2: reserved tags plus user tags; values of a repeated key are concatenated.

    (``map_concat`` would fail on a duplicate key, so entries are grouped.)
    """
    res = F.array(*[F.struct(F.lit(k).alias("key"), F.array(v.cast("string")).alias("value")) for k, v in reserved])
    entries = F.concat(res, F.coalesce(F.map_entries(user), F.array().cast("array<struct<key:string,value:array<string>>>")))
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(F.transform(
        keys, lambda k: F.struct(k.alias("key"),
                                 F.flatten(F.transform(F.filter(entries, lambda e: e["key"] == k),
                                                       lambda e: e["value"])).alias("value"))))


def format_stamp(ts: str | Column) -> Column:
    c = F.lit(ts) if isinstance(ts, str) else ts
    return F.date_format(F.to_timestamp(c), STAMP_FORMAT)


def prepare_records(rows: DataFrame, *, stamp: str, vector_col: str = "embedding",
                    file_type_col: str = "upload_mime") -> DataFrame:
    """One record per embedding row.

    ``rows`` needs document_id, file_id, source_partition_id, name (partition
    file), text, url, tags, provider, generator and the vector. Output:
    record_id, document_id, file_id, part_id, embedding, tags, payload.
    """
    part = F.col("source_partition_id")
    file_type = F.col(file_type_col) if file_type_col in rows.columns else F.lit("text/plain")
    tags = merge_tags([(TAG_DOCUMENT_ID, F.col("document_id")), (TAG_FILE_TYPE, file_type),
                       (TAG_FILE_ID, F.col("file_id")), (TAG_FILE_PART, part)], F.col("tags"))
    payload = F.struct(F.col("file_name").alias("file"), F.coalesce(F.col("url"), F.lit("")).alias("url"),
                       F.col("text").alias("text"), F.col("provider").alias("vector_provider"),
                       F.col("generator").alias("vector_generator"), format_stamp(stamp).alias("last_update"))
    return rows.select(record_id(F.col("document_id"), part).alias("record_id"), "document_id", "file_id",
                       part.alias("part_id"), F.col(vector_col).cast("array<float>").alias("embedding"),
                       tags.alias("tags"), payload.alias("payload"))


def partitions_as_embeddings(partitions: DataFrame) -> DataFrame:
    """Without embeddings, each partition becomes a record with an empty vector."""
    return partitions.drop("source_partition_id").select(
        "*", F.col("artifact_id").alias("source_partition_id"), F.lit("").alias("provider"),
        F.lit("").alias("generator"), F.array().cast("array<float>").alias("embedding"))


def stale_records(previous: DataFrame, current: DataFrame, *, documents: DataFrame | None = None,
                  collection: str | None = None, key_cols: Sequence[str] = ("collection", "namespace", "key")) -> DataFrame:
    """Records of earlier runs of the same documents that the current run no longer produces.

    ``documents`` (document_id) are the documents of the run, which may have
    left no record at all; by default those of ``current``. Only records of
    ``collection`` can be stale; without it, those of a (collection, document)
    that ``current`` names.
    """
    key_cols = list(key_cols)
    run = documents if documents is not None else current
    if collection is None:
        docs, on, scope = current, ["collection", "document_id"], previous
    else:
        docs, on, scope = run, ["document_id"], previous.filter(F.col("collection") == F.lit(collection))
    if collection is None and documents is not None:
        raise ValueError("documents need a collection")
    old = scope.join(broadcast_if_small(docs.select(*on).distinct()), on, "left_semi").select(*previous.columns)
    return old.join(current.select(*key_cols), key_cols, "left_anti").select(*previous.columns)


def purge(state: DataFrame, documents: DataFrame, *, collection: str) -> DataFrame:
    """The state without the records of a run's ``documents`` (document_id) in ``collection``.

    These are the stale ones (``stale_records``) and those that the run writes again. Other collections pass without
    a join. Of the collection's documents the fewer ones, those that go or those that stay, are broadcast where they
    are small, so records are shuffled only where neither are; to find them, ids alone are.
    """
    inside = F.col("collection").eqNullSafe(F.lit(collection))
    own = state.filter(inside)
    if is_small(documents):
        left = own.join(F.broadcast(documents), "document_id", "left_anti")
    else:
        stay = materialize(own.select("document_id").distinct().join(documents, "document_id", "left_anti")
                           .withColumnRenamed("document_id", "_stay"), "stay")
        if is_small(stay):
            left = own.join(F.broadcast(stay), F.col("document_id").eqNullSafe(F.col("_stay")), "left_semi")
        else:
            left = own.join(documents, "document_id", "left_anti")
    return state.filter(~inside).unionByName(left.select(*state.columns))


def fan_out(records: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Every record to every configured store (write with ``partitionBy('target')``)."""
    return records.withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets])))


def metadata_size(tags: Column, payload: Column) -> Column:
    """JSON size in bytes of a record's metadata."""
    return F.octet_length(F.to_json(F.struct(tags.alias("tags"), payload.alias("payload"))))


def validate_metadata(records: DataFrame, *, limit: int) -> tuple[DataFrame, DataFrame]:
    """Split records into (valid, too_large) by metadata size."""
    sized = records.withColumn("metadata_bytes", metadata_size(F.col("tags"), F.col("payload")))
    ok = F.col("metadata_bytes") <= F.lit(limit)
    return sized.filter(ok), sized.filter(~ok)


def flat_tags(tags: Column, sep: str = "|") -> Column:
    """Tags as sorted ``key:value`` strings joined by ``sep`` (for display and checks)."""
    pairs = F.flatten(F.transform(F.map_entries(tags),
                                  lambda e: F.transform(e["value"], lambda v: F.concat(e["key"], F.lit(":"), v))))
    return F.array_join(F.array_sort(pairs), sep)
