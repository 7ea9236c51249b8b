"""Keyed collections: mutation (U1-U12) and reads.

State is a records table keyed by ``(collection, namespace, key)`` and stored
partitioned by ``collection``/``namespace``. Every operator returns a new
DataFrame; ``memweave.sources.store`` writes back only touched partitions.

Scale notes: a batch usually touches a small part of the state, so the batch
keys are broadcast when a count proves them small and the state is never
shuffled for an upsert or delete; otherwise the planner shuffles both sides on
the key (AQE splits skewed partitions).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memweave.functions.filters import equality_filter
from memweave.functions.ordering import dense_index
from memweave.functions.sizing import broadcast_if_small, is_small
from memweave.session import materialize

KEY_COLS = ("collection", "namespace", "key")
POLICIES = ("memory", "remote")


class CollectionError(ValueError):
    pass


# ---------------------------------------------------------------------------
# upsert
# ---------------------------------------------------------------------------

def latest_per_key(batch: DataFrame, key_cols: Sequence[str] = KEY_COLS, seq_col: str = "seq") -> DataFrame:
    """Last write in input order wins for duplicate keys inside a batch.

    An aggregate (``max_by`` on the sequence number) rather than a window: it
    combines map-side, so a key repeated across a third of the batch still
    sends one row per task to the shuffle.
    """
    key_cols = list(key_cols)
    rest = [c for c in batch.columns if c not in key_cols]
    latest = batch.groupBy(*key_cols).agg(F.max_by(F.struct(*rest), F.col(seq_col)).alias("_row"))
    return latest.select(*key_cols, *[F.col("_row")[c].alias(c) for c in rest]).select(*batch.columns)


def check_collections(batch: DataFrame, registry: DataFrame, *, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split a batch into rows whose collection exists and rejects.

    ``strict`` makes the job fail at run time (``raise_error``) when any row
    targets a missing collection, which is the in-memory store's behaviour.
    """
    names = broadcast_if_small(registry.select(F.col("name").alias("_coll")).distinct())
    tagged = batch.join(names, batch["collection"] == names["_coll"], "left")
    missing = tagged.filter(F.col("_coll").isNull()).drop("_coll")
    good = tagged.filter(F.col("_coll").isNotNull()).drop("_coll")
    if strict:
        # A filter predicate is always evaluated, so a missing collection fails the job.
        guard = F.when(F.col("_coll").isNull(),
                       F.raise_error(F.concat(F.lit("collection does not exist: "), F.col("collection")))
                       ).otherwise(F.lit(True))
        good = tagged.filter(guard).drop("_coll")
    return good, missing


def upsert(state: DataFrame, batch: DataFrame, *, key_cols: Sequence[str] = KEY_COLS, seq_col: str = "seq",
           registry: DataFrame | None = None, strict: bool = True, dedupe: bool = True,
           batch_small: bool | None = None, hits_in: Column | None = None) -> DataFrame:
    """Replace whole rows by key; new keys are added.

    Result = (state without the batch keys) union (latest batch row per key).
    ``dedupe=False`` skips the last-write-wins aggregate for batches whose keys
    are unique by construction (e.g. one record per chunk and generator).
    ``hits_in`` is for a large batch of mostly new keys, and names the state rows
    that can hold any of them: the keys found on both sides are written once, so
    that state rows are not shuffled for the others.
    """
    key_cols = list(key_cols)
    if registry is not None:
        batch, _ = check_collections(batch, registry, strict=strict)
    latest = latest_per_key(batch, key_cols, seq_col) if dedupe else batch
    keys = latest.select(*key_cols)
    if hits_in is not None and not is_small(keys):
        held = state.filter(hits_in).select(*key_cols)
        keys, batch_small = materialize(keys.join(held, key_cols, "left_semi"), "hits"), None
    keys = broadcast_if_small(keys, known_small=batch_small)
    kept = state.join(keys, key_cols, "left_anti").select(*state.columns)
    return kept.unionByName(latest.select(*state.columns), allowMissingColumns=True)


# ---------------------------------------------------------------------------
# Classified upsert
# ---------------------------------------------------------------------------

def metadata_map(cols: Sequence[str]) -> Column:
    """Metadata as a map of its non-null fields."""
    entries = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in cols])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def same_metadata(a: Column, b: Column) -> Column:
    """Maps cannot be compared with ``=`` in Spark: compare sorted entry arrays."""
    return F.array_sort(F.map_entries(a)) == F.array_sort(F.map_entries(b))


def classify(state: DataFrame, batch: DataFrame, *, metadata_cols: Sequence[str] | None = None,
             metadata_col: str | None = None, key_cols: Sequence[str] = KEY_COLS,
             batch_small: bool | None = None) -> DataFrame:
    """Label each batch row ``upsert`` (absent), ``skip`` (same metadata) or ``update``.

    Compared against the state before the batch. The vector is not compared:
    a new vector with unchanged metadata is a skip. NULL metadata on either
    side is an update. The lookup key is ``key`` unless it is empty, then the
    metadata id (``key_fallback`` column when present).
    """
    key_cols = list(key_cols)
    if metadata_col is None:
        if not metadata_cols:
            raise ValueError("metadata_cols or metadata_col is required")
        b_meta, s_meta = metadata_map(metadata_cols), metadata_map(metadata_cols)
    else:
        b_meta, s_meta = F.col(metadata_col), F.col(metadata_col)
    b = batch.withColumn("_meta", b_meta)
    if "key_fallback" in b.columns:
        b = b.withColumn("key", F.when(F.coalesce(F.col("key"), F.lit("")) != "", F.col("key"))
                         .otherwise(F.col("key_fallback")))
    # The batch is the preserved side of the outer join and cannot be
    # broadcast; so the state is first cut to the batch's keys with a
    # broadcast semi-join (a map-side filter, the state is not shuffled).
    keys = broadcast_if_small(b.select(*key_cols).distinct(), known_small=batch_small)
    hit = state.join(keys, key_cols, "left_semi")
    s = hit.select(*key_cols, s_meta.alias("_state_meta"), F.lit(True).alias("_present"))
    j = b.join(s, key_cols, "left")
    op = (F.when(F.col("_present").isNull(), F.lit("upsert"))
          .when(F.col("_meta").isNull() | F.col("_state_meta").isNull(), F.lit("update"))
          .when(same_metadata(F.col("_meta"), F.col("_state_meta")), F.lit("skip"))
          .otherwise(F.lit("update")))
    return j.withColumn("op", op).drop("_meta", "_state_meta", "_present")


OP_ORDER = {"skip": 0, "upsert": 1, "update": 2}


def op_order(op: Column) -> Column:
    expr = None
    for name, rank in OP_ORDER.items():
        expr = F.when(op == name, F.lit(rank)) if expr is None else expr.when(op == name, F.lit(rank))
    return expr


def classified_upsert(state: DataFrame, batch: DataFrame, *, metadata_cols: Sequence[str] | None = None,
                      metadata_col: str | None = None, key_cols: Sequence[str] = KEY_COLS,
                      seq_col: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Classify, then upsert only non-skip rows.

    Metadata is one map column (``metadata_col``, which may be NULL) or the
    non-null fields of ``metadata_cols``.

    Returns ``(new_state, report)``; the report has one row per batch row with
    ``op`` and ``op_order`` (skips, then upserts, then updates; input order
    inside each), sortable by ``(op_order, seq)``.
    """
    small = is_small(batch)  # one size check serves both joins below
    labelled = classify(state, batch, metadata_cols=metadata_cols, metadata_col=metadata_col, key_cols=key_cols, batch_small=small)
    report = labelled.select(*key_cols, seq_col, "op", op_order(F.col("op")).alias("op_order"))
    changes = labelled.filter(F.col("op") != "skip").drop("op")
    new_state = upsert(state, changes, key_cols=key_cols, seq_col=seq_col, batch_small=small)
    return new_state, report


# ---------------------------------------------------------------------------
# U4: update in place
# ---------------------------------------------------------------------------

def update_in_place(state: DataFrame, changes: DataFrame, *, key_cols: Sequence[str] = KEY_COLS) -> DataFrame:
    """U4: for keys present in the state, non-null change fields replace the old ones."""
    key_cols = list(key_cols)
    fields = [c for c in changes.columns if c not in key_cols and c in state.columns]
    ch = changes.select(*key_cols, *[F.col(c).alias(f"_new_{c}") for c in fields])
    j = state.join(broadcast_if_small(ch), key_cols, "left")
    for c in fields:
        j = j.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c))).drop(f"_new_{c}")
    return j.select(*state.columns)


# ---------------------------------------------------------------------------
# Batches of 100
# ---------------------------------------------------------------------------

MAX_BATCH_SIZE = 100


def batch_counts(batch: DataFrame, *, size: int = MAX_BATCH_SIZE, group_cols: Sequence[str] = ("collection", "namespace"),
                 seq_col: str = "seq") -> DataFrame:
    """Split each (collection, namespace) in input order into blocks of ``size``.

    Returns per-block counts plus rollup totals (NULL ``batch_no`` = namespace
    total, NULL ``namespace`` = collection total, all NULL = grand total).
    """
    idx = dense_index(batch, group_cols, [seq_col], "_idx")
    blocks = idx.withColumn("batch_no", F.floor(F.col("_idx") / F.lit(size)).cast("bigint"))
    return blocks.rollup(*group_cols, "batch_no").agg(F.count(F.lit(1)).alias("n_vectors"))


# ---------------------------------------------------------------------------
# removal
# ---------------------------------------------------------------------------

def _outside(collection: str | None) -> Column:
    """Rows that a removal from ``collection`` leaves alone (None: the state holds one collection, all are in scope)."""
    return F.lit(False) if collection is None else ~F.coalesce(F.col("collection") == F.lit(collection), F.lit(False))


def remove_keys(state: DataFrame, keys: DataFrame, *, collection: str | None = None,
                key_cols: Sequence[str] = ("key",)) -> DataFrame:
    """Drop rows of ``collection`` whose key is listed; unknown keys are no-ops.

    Without ``collection`` the key columns must tell the collections apart, or the state hold one only.
    """
    key_cols = list(key_cols)
    marks = broadcast_if_small(keys.select(*[F.col(c).alias(f"_del_{c}") for c in key_cols]).distinct())
    same = ~_outside(collection)
    for c in key_cols:
        same = same & (state[c] == marks[f"_del_{c}"])
    return state.join(marks, same, "left_anti").select(*state.columns)


def remove_where(state: DataFrame, pred: Column | Mapping, *, collection: str | None = None) -> DataFrame:
    """Drop rows of ``collection`` matching the filter; a row lacking a filter field stays."""
    pred = pred if isinstance(pred, Column) else equality_filter(pred)
    return state.filter(_outside(collection) | ~F.coalesce(pred, F.lit(False)))


def remove_documents(state: DataFrame, document_ids: DataFrame, *, collection: str | None = None,
                     id_col: str = "document_id") -> DataFrame:
    """U8: drop every record of the listed documents from ``collection``."""
    ids = document_ids.select(F.col(id_col).alias("document_id"))
    return remove_keys(state, ids, collection=collection, key_cols=("document_id",))


def clear_namespace(state: DataFrame, namespace: str, *, collection: str | None) -> DataFrame:
    """Drop a namespace of ``collection``; the empty namespace means all of the collection.

    The collection must be named; None says that the state holds one collection only.
    """
    gone = F.lit(True) if namespace == "" else F.coalesce(F.col("namespace") == F.lit(namespace), F.lit(False))
    return state.filter(_outside(collection) | ~gone)


def delete(state: DataFrame, *, collection: str | None, ids: DataFrame | None = None, namespace: str | None = None,
           where: Mapping | Column | None = None, delete_all: bool = False) -> DataFrame:
    """Delete rows of ``collection`` matching ids AND namespace AND filter.

    With ``delete_all`` the namespace (or, without one, the collection) is cleared.
    A request with no ids, namespace, filter or delete_all is an error.
    """
    if ids is None and namespace is None and where is None and not delete_all:
        raise CollectionError("delete needs ids, a namespace, a filter or delete_all")
    if delete_all:
        return clear_namespace(state, namespace or "", collection=collection)
    pred = ~_outside(collection)
    if namespace is not None:
        pred = pred & (F.col("namespace") == F.lit(namespace))
    if where is not None:
        pred = pred & (where if isinstance(where, Column) else equality_filter(where))
    if ids is None:
        return state.filter(~F.coalesce(pred, F.lit(False)))
    marked = broadcast_if_small(ids.select(F.col("key").alias("_del_key")).distinct())
    return state.join(marked, (state["key"] == marked["_del_key"]) & F.coalesce(pred, F.lit(False)), "left_anti")


# ---------------------------------------------------------------------------
# Collection registry
# ---------------------------------------------------------------------------

def create_collections(registry: DataFrame, names: DataFrame, *, policy: str = "memory",
                       name_col: str = "name") -> tuple[DataFrame, DataFrame]:
    """Add collections; idempotent. Blank names are rejected.

    Returns ``(registry, rejects)``. The remote policy never creates: every
    name not already Ready is a reject (the remote index must be made elsewhere).
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    n = names.select(F.col(name_col).alias("name")).distinct()
    blank = F.coalesce(F.trim(F.col("name")), F.lit("")) == ""
    rejects = n.filter(blank).withColumn("reason", F.lit("blank name"))
    wanted = n.filter(~blank)
    if policy == "remote":
        ready = registry.filter(F.col("state") == "Ready").select("name")
        not_ready = wanted.join(ready, "name", "left_anti").withColumn("reason", F.lit("index not ready"))
        return registry, rejects.unionByName(not_ready)
    new = wanted.join(registry.select("name"), "name", "left_anti").withColumn("state", F.lit("Ready"))
    return registry.unionByName(new), rejects


def drop_collections(registry: DataFrame, names: DataFrame, *, strict: bool = True,
                     name_col: str = "name") -> DataFrame:
    """Remove collections. ``strict`` (in-memory rule) fails on a missing name."""
    n = names.select(F.col(name_col).alias("name")).distinct()
    if strict:
        # The names list is small (it is a request); counting the misses is cheap.
        missing = n.join(registry.select("name"), "name", "left_anti").count()
        if missing:
            raise CollectionError(f"{missing} of the named collections are unknown")
    return registry.join(broadcast_if_small(n), "name", "left_anti").select(*registry.columns)


def drop_records_of(state: DataFrame, names: DataFrame, *, name_col: str = "name") -> DataFrame:
    """Records of dropped collections go with them."""
    n = broadcast_if_small(names.select(F.col(name_col).alias("collection")).distinct())
    return state.join(n, "collection", "left_anti").select(*state.columns)


# ---------------------------------------------------------------------------
# reads
# ---------------------------------------------------------------------------

def list_collections(registry: DataFrame, name_col: str = "name") -> DataFrame:
    """G1: distinct names, NULL shown as ''."""
    return registry.select(F.coalesce(F.col(name_col), F.lit("")).alias("name")).distinct()


def collections_exist(registry: DataFrame, names: DataFrame, *, policy: str = "memory",
                      name_col: str = "name") -> DataFrame:
    """Per requested name, ``exists`` (remote also requires state Ready)."""
    reg = registry.groupBy("name").agg(F.max(F.col("state") == "Ready").alias("_ready"))
    n = names.select(F.col(name_col).alias("name")).distinct()
    j = n.join(reg, "name", "left")
    present = F.col("_ready").isNotNull()
    exists = present if policy == "memory" else present & F.col("_ready")
    return j.select("name", exists.alias("exists"))


def get_batch(state: DataFrame, keys: DataFrame, *, key_cols: Sequence[str] = ("key",), ord_col: str = "ord",
              include_vectors: bool = True, vector_col: str = "embedding") -> DataFrame:
    """Rows for requested keys in request order; duplicates repeat, missing keys skip.

    An inner join (not a semi-join) keeps one output row per request row.
    ``include_vectors=False`` drops the vector column before the scan.
    """
    st = state if include_vectors or vector_col not in state.columns else state.drop(vector_col)
    return keys.select(ord_col, *key_cols).join(st, list(key_cols), "inner")


def query_by_filter(state: DataFrame, where: Mapping | Column, *, top_k: int = 10, key_col: str = "key") -> DataFrame:
    """Rows matching a metadata filter, at most ``top_k`` (ordered by key)."""
    pred = where if isinstance(where, Column) else equality_filter(where)
    if top_k <= 0:
        return state.filter(F.lit(False))
    return state.filter(pred).orderBy(F.col(key_col)).limit(top_k)


def by_document(state: DataFrame, document_ids: DataFrame, *, per_document: int = 3,
                id_col: str = "document_id", key_col: str = "key") -> DataFrame:
    """Up to ``per_document`` records (lowest keys) of each requested document."""
    ids = broadcast_if_small(document_ids.select(F.col(id_col).alias("document_id")).distinct())
    rows = state.join(ids, "document_id", "left_semi")
    w = Window.partitionBy("document_id").orderBy(F.col(key_col))
    # Planned with a window group limit: each task forwards at most k rows per document.
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_document).drop("_rn")


def list_namespaces(state: DataFrame) -> DataFrame:
    """G7."""
    return state.select("collection", "namespace").distinct()


def index_stats(state: DataFrame, where: Column | Mapping | None = None, vector_col: str = "embedding") -> DataFrame:
    """Per (collection, namespace) vector counts and dimensions, with rollup totals."""
    df = state
    if where is not None:
        df = df.filter(where if isinstance(where, Column) else equality_filter(where))
    return df.rollup("collection", "namespace").agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.min(F.size(vector_col)).cast("bigint").alias("min_dim"),
        F.max(F.size(vector_col)).cast("bigint").alias("max_dim"))
