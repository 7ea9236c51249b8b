"""Similarity retrieval (N1-N10) and keyword paging.

Two execution shapes:

* ``nearest``: one query vector. The vector is a literal, the score a Catalyst
  expression, and ``orderBy(...).limit(k)`` becomes ``TakeOrderedAndProject``:
  each task keeps its own top-k and only k rows per task reach the final merge.
* ``nearest_many``: a table of query vectors. A query matrix within the broadcast
  limit travels to the records, and every Arrow batch of records is scored
  where it is read. Beyond the limit, strips of queries and strips of records
  are paired by a join and each pair is a task's work; the records are
  read once, whatever the number of queries, and no query passes the driver.
  Scores are computed in matrices of bounded size.
  Either way a batch or pair emits at most k candidates per query, so no
  (query, record) pair is ever materialised or shuffled; a window with a
  group limit picks the final k per query.

Scores are rounded to ``SCORE_DIGITS`` places and floors apply to the rounded
score, so any engine that rounds the same way cuts at the same record. Ties
break on the record key (ascending), making every ranking total.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memweave.functions import vectors as V
from memweave.functions.blocks import pair_blocks
from memweave.functions.filters import equality_filter
from memweave.functions.parallel import spread
from memweave.functions.sizing import BROADCAST_BYTES, broadcast_if_small, is_small
from memweave.session import materialize

SCORE_DIGITS = 6
POLICIES = ("memory", "remote")
# Query matrices up to this many bytes travel as one broadcast; larger query
# sets are joined with the records in blocks.
DEFAULT_QUERY_BROADCAST_BYTES = 8 << 20
# A task pairs a strip of queries with a strip of records, each of this many bytes of vectors at most.
STRIP_BYTES = 16 << 20
# Small tables are still cut into about this many strips, so that the pairs fill the cores.
MIN_STRIPS = 8
# Queries and records of one score matrix.
MATRIX_QUERIES, MATRIX_RECORDS = 256, 4096


def _floor_pred(score: Column, floor: float | None, policy: str, higher: bool) -> Column | None:
    if floor is None:
        return score.isNotNull()
    if policy == "memory":
        return score >= F.lit(floor) if higher else score <= F.lit(floor)
    if policy == "remote":
        return score > F.lit(floor) if higher else score < F.lit(floor)
    raise ValueError(f"policy must be one of {POLICIES}")


def _check_policy(policy: str) -> None:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")


def score_records(records: DataFrame, query_vector: Sequence[float] | Column, *, metric: str = "cosine",
                  vector_col: str = "embedding", score_col: str = "score") -> DataFrame:
    """Add the (rounded) similarity of every record to one query vector."""
    q = query_vector if isinstance(query_vector, Column) else V.vector_literal(query_vector)
    return records.withColumn(score_col, F.round(V.similarity(metric, F.col(vector_col), q), SCORE_DIGITS))


def nearest(records: DataFrame, query_vector: Sequence[float], *, top_k: int, min_relevance: float | None = 0.0,
            policy: str = "memory", metric: str = "cosine", namespace: str | None = None,
            where: Mapping | Column | None = None, key_col: str = "key", vector_col: str = "embedding",
            include_vectors: bool = False, include_metadata: bool = True) -> DataFrame:
    """N3-N6 for one query vector.

    ``policy='memory'``: keep ``score >= min_relevance`` (default 0, so negative
    scores drop), then the best ``top_k``. ``policy='remote'``: best ``top_k``
    then strict ``score > min_relevance``; both orders give the same rows because
    the floor is monotone in the ranking score. ``top_k <= 0`` gives no rows.
    """
    _check_policy(policy)
    higher = V.higher_is_better(metric)
    df = _narrow(records, namespace, where)
    df = score_records(df, query_vector, metric=metric, vector_col=vector_col)
    order = [F.col("score").desc_nulls_last() if higher else F.col("score").asc_nulls_last(), F.col(key_col).asc()]
    df = _project(df, vector_col, include_vectors, include_metadata, key_col)
    if top_k <= 0:
        return df.filter(F.lit(False))
    # The floor is applied after the top-k: the two commute (NULL scores sort
    # last), and a filter below the projection would compute the score twice.
    return df.orderBy(*order).limit(top_k).filter(_floor_pred(F.col("score"), min_relevance, policy, higher))


def query(records: DataFrame, *, top_k: int, vector: Sequence[float] | None = None, namespace: str | None = None,
          where: Mapping | Column | None = None, include_metadata: bool = True, key_col: str = "key") -> DataFrame:
    """Raw query. With a vector: best ``top_k`` by cosine (remote rule, no
    threshold); without one: records matching the filter, at most ``top_k``
    (ordered by key, as G5)."""
    if vector is not None:
        return nearest(records, vector, top_k=top_k, min_relevance=None, policy="remote", namespace=namespace,
                       where=where, include_metadata=include_metadata, key_col=key_col)
    from memweave.operators.collections import query_by_filter
    df = _narrow(records, namespace, None)
    out = query_by_filter(df, where if where is not None else F.lit(True), top_k=top_k, key_col=key_col)
    return _project(out, "embedding", False, include_metadata, key_col)


def _narrow(records: DataFrame, namespace: str | None, where) -> DataFrame:
    df = records
    if namespace is not None:
        df = df.filter(F.col("namespace") == F.lit(namespace))
    if where is not None:
        df = df.filter(where if isinstance(where, Column) else equality_filter(where))
    return df


def _project(df: DataFrame, vector_col: str, include_vectors: bool, include_metadata: bool, key_col: str) -> DataFrame:
    """Projection flags; Catalyst prunes dropped columns at the scan."""
    cols = df.columns
    if not include_metadata:
        keep = [c for c in cols if c in (key_col, "score", vector_col, "qid", "collection", "namespace")]
        df = df.select(*keep)
    if not include_vectors and vector_col in df.columns:
        df = df.drop(vector_col)
    return df


# ---------------------------------------------------------------------------
# many queries at once
# ---------------------------------------------------------------------------

def _batch_topk(scores: np.ndarray, keys: np.ndarray, k: int, higher: bool):
    """Exact top-k per row of ``scores`` (NaN = no score), ties on key asc.

    Returns (query_index, record_index, score) arrays. Every record that can be
    in the global top-k of a query is in its batch's top-k, so merging batch
    results later is exact.
    """
    s = scores if higher else -scores
    valid = ~np.isnan(s)
    n = s.shape[1]
    if k is None:
        qi, ni = np.nonzero(valid)
        return qi, ni, scores[qi, ni]
    if n > k and np.count_nonzero(valid) > 4 * k * len(s):
        filled = np.where(valid, s, -np.inf)
        kth = np.partition(filled, n - k, axis=1)[:, n - k]
        mask = valid & (filled >= kth[:, None])
    else:  # few scores: sorting them is cheaper
        mask = valid
    qi, ni = np.nonzero(mask)
    if qi.size == 0:
        return qi, ni, np.empty(0)
    qi, ni, sc = _first_k(qi, ni, s[qi, ni], keys, k)
    return qi, ni, (sc if higher else -sc)


def _first_k(qi: np.ndarray, ni: np.ndarray, sc: np.ndarray, keys: np.ndarray, k: int):
    """The ``k`` highest scores of every query, ties on key asc, ordered by query and rank."""
    order = np.lexsort((keys[ni], -sc, qi))
    qi, ni, sc = qi[order], ni[order], sc[order]
    starts = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]])
    lengths = np.diff(np.r_[starts, qi.size])
    keep = np.arange(qi.size) - np.repeat(starts, lengths) < k
    return qi[keep], ni[keep], sc[keep]


def _score_matrix(Q: np.ndarray, X: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        qn = np.linalg.norm(Q, axis=1)
        xn = np.linalg.norm(X, axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            S = (Q @ X.T) / np.outer(qn, xn)
        S[~np.isfinite(S)] = np.nan
        return S
    if metric == "dotproduct":
        return Q @ X.T
    if metric == "euclidean":
        sq = (Q * Q).sum(1)[:, None] + (X * X).sum(1)[None, :] - 2.0 * (Q @ X.T)
        return np.sqrt(np.maximum(sq, 0.0))
    raise ValueError(metric)


def _vectors(col: pa.Array | pa.ChunkedArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix) of the list values that have ``dim`` components, straight from the flat buffer."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    length = col.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dim)
    own = col if len(rows) == len(col) else col.take(pa.array(rows))
    return rows, own.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)


def _sortable(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Keys as an array that NumPy can order."""
    keys = col.to_numpy() if isinstance(col, pa.ChunkedArray) else col.to_numpy(zero_copy_only=False)
    return keys.astype(str) if keys.dtype == object else keys


def _best_pairs(Q: np.ndarray, X: np.ndarray, keys: np.ndarray, metric: str, k: int | None, floor: float | None, policy: str,
                query_rows: int = MATRIX_QUERIES, record_rows: int = MATRIX_RECORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, record, score) of each query's best ``k`` records above the floor, some queries at a time.

    Scores are computed in matrices of bounded size. After the first of them a query's k-th best score
    so far cuts the later ones, so that few scores are ranked.
    """
    higher = V.higher_is_better(metric)
    sign = 1.0 if higher else -1.0
    for lo in range(0, len(Q), query_rows):
        part = Q[lo:lo + query_rows]
        qi, ni, sc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        kth = np.full(len(part), -np.inf)
        for at in range(0, len(X), record_rows):
            S = np.round(_score_matrix(part, X[at:at + record_rows], metric), SCORE_DIGITS)
            if floor is not None:
                if higher:
                    S[(S <= floor) if policy == "remote" else (S < floor)] = np.nan
                else:
                    S[(S >= floor) if policy == "remote" else (S > floor)] = np.nan
            if k is not None and at:
                S[sign * S < kth[:, None]] = np.nan
            new_q, new_n, new_s = _batch_topk(S, keys[at:at + record_rows], k, higher)
            if k is None:
                yield new_q + lo, new_n + at, new_s
                continue
            if not new_q.size:
                continue
            qi, ni, sc = _first_k(np.concatenate((qi, new_q)), np.concatenate((ni, new_n + at)), np.concatenate((sc, sign * new_s)), keys, k)
            last = np.flatnonzero(np.diff(qi, append=-1))
            full = last[np.diff(last, prepend=-1) == k]
            kth[qi[full]] = sc[full]
        if qi.size:
            yield qi + lo, ni, sign * sc


def nearest_many(records: DataFrame, queries: DataFrame, *, top_k: int, min_relevance: float | None = 0.0,
                 policy: str = "memory", metric: str = "cosine", qid_col: str = "qid",
                 query_vector_col: str = "query_vector", match_cols: Sequence[str] = (),
                 key_col: str = "key", vector_col: str = "embedding", include_vectors: bool = False,
                 include_metadata: bool = True, max_broadcast_bytes: int = DEFAULT_QUERY_BROADCAST_BYTES,
                 query_block: int = 1024, record_block: int = 16_384) -> DataFrame:
    """N3/N4/N5 for a table of queries: best ``top_k`` records per query.

    ``top_k=None`` (or negative) keeps every record above the floor.

    ``queries`` has ``qid_col``, ``query_vector_col`` and optional ``match_cols``
    (e.g. ``collection``): a query only scores records with equal match values
    and a vector as long as its own; ``without_counterpart`` lists the rest.
    Output: the query id, the record columns (vector only if asked) and ``score``.

    Query tables up to ``max_broadcast_bytes`` travel to the records; larger
    ones meet them in a join of query and record strips, keyed by match
    values, vector length and strip numbers, and never pass the driver. A strip
    holds at most ``STRIP_BYTES`` of vectors and is scored in matrices of up to
    ``query_block`` x ``record_block``; with ``top_k=None`` these are the strips.
    """
    _check_policy(policy)
    metric = metric.lower()
    higher = V.higher_is_better(metric)
    match_cols = list(match_cols)
    out_cols = [c for c in records.columns if include_vectors or c != vector_col]
    if not include_metadata:  # N10: ids (and partition columns) only
        out_cols = [c for c in out_cols if c in (key_col, vector_col, "collection", "namespace", *match_cols)]
    rec_fields = {f.name: f for f in records.schema.fields}
    qid_field = queries.schema[qid_col]
    schema = T.StructType([T.StructField(qid_col, qid_field.dataType, True)]
                          + [rec_fields[c] for c in out_cols]
                          + [T.StructField("score", T.DoubleType(), True)])
    spark = records.sparkSession
    unlimited = top_k is None or top_k < 0
    if not unlimited and top_k <= 0:
        return spark.createDataFrame([], schema)

    qsel = queries.select(qid_col, query_vector_col, *match_cols).filter(F.size(query_vector_col) > 0)
    stats = qsel.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(query_vector_col)).alias("d")).first()
    n_q, dim = int(stats["n"]), int(stats["d"] or 0)
    if n_q == 0:
        return spark.createDataFrame([], schema)
    options = dict(metric=metric, k=None if unlimited else top_k, floor=min_relevance, policy=policy)
    if n_q * (dim * 8 + 64) <= max_broadcast_bytes:
        candidates = _score_broadcast(records, qsel, qid_col, query_vector_col, match_cols, key_col, vector_col, out_cols, schema, options)
        return candidates if unlimited else _merge_top(candidates, qid_col, key_col, top_k, higher)
    # records get a number, so that only keys and vectors are copied to the blocks and the rest is joined after the cut
    written = materialize(records.select(*dict.fromkeys([*out_cols, key_col, vector_col, *match_cols])).withColumn(
        "_row", F.monotonically_increasing_id()), "records")
    options |= dict(query_rows=min(query_block, MATRIX_QUERIES), record_rows=min(record_block, MATRIX_RECORDS))
    if not unlimited:  # a row is copied once for each strip of the other side
        query_block, record_block = strip_rows(n_q, dim, query_block), strip_rows(written.count(), dim, record_block)
    numbered = _score_blocks(written, qsel, qid_col, query_vector_col, match_cols, key_col, vector_col, query_block, record_block, options)
    if not unlimited:
        numbered = _merge_top(numbered, qid_col, "_key", top_k, higher)
    numbered = numbered.select(F.col(qid_col).alias("_qid"), "_row", "score")
    return numbered.join(written, "_row").select(F.col("_qid").alias(qid_col), *[F.col(f"`{c}`") for c in out_cols], "score")


def _merge_top(candidates: DataFrame, qid_col: str, key_col: str, top_k: int, higher: bool) -> DataFrame:
    order = F.col("score").desc() if higher else F.col("score").asc()
    w = Window.partitionBy(qid_col).orderBy(order, F.col(key_col).asc())
    return candidates.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= top_k).drop("_rn")


def score_pair(schema: T.StructType, options: dict):
    """Work on a block of queries (_qid, _dim, _vector) and one of records (_row, _key, _vector) of that length."""
    def work(own: pa.Table, block: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if own.num_rows and block.num_rows:
            dim = own["_dim"][0].as_py()
            found += _best_pairs(_vectors(own["_vector"], dim)[1], _vectors(block["_vector"], dim)[1], _sortable(block["_key"]), **options)
        qi, ni, sc = (np.concatenate(x) for x in zip(*found))
        cols = [own["_qid"].take(pa.array(qi)), block["_row"].take(pa.array(ni)), block["_key"].take(pa.array(ni)), pa.array(sc)]
        return pa.Table.from_arrays(cols, names=schema.names)

    return work


def strip_rows(n_rows: int, dim: int, block: int) -> int:
    """Rows of a strip: a share of the table, but no less than a block and no more than ``STRIP_BYTES`` of vectors."""
    most = max(1, STRIP_BYTES // (8 * max(dim, 1)))
    return max(block, min(most, -(-n_rows // MIN_STRIPS)))


def _score_blocks(records: DataFrame, queries: DataFrame, qid_col: str, query_vector_col: str, match_cols: list[str], key_col: str,
                  vector_col: str, query_block: int, record_block: int, options: dict) -> DataFrame:
    """(qid, _row, _key, score): the best rows of every query in every pair of blocks."""
    by = [*[f"_match{k}" for k in range(len(match_cols))], "_dim"]
    named = [F.col(f"`{c}`").alias(f"_match{k}") for k, c in enumerate(match_cols)]
    q = queries.select(*named, F.size(query_vector_col).alias("_dim"), F.col(qid_col).alias("_qid"), F.col(query_vector_col).alias("_vector"))
    r = records.select(*named, F.size(vector_col).alias("_dim"), "_row", F.col(f"`{key_col}`").alias("_key"), F.col(vector_col).alias("_vector"))
    schema = T.StructType([T.StructField(qid_col, q.schema["_qid"].dataType), T.StructField("_row", T.LongType()),
                           T.StructField("_key", r.schema["_key"].dataType), T.StructField("score", T.DoubleType())])

    return pair_blocks(q, r, by, left_hash=[F.col("_qid"), F.col("_vector")], right_hash=[F.col("_row")], left_rows=query_block,
                       right_rows=record_block, work=score_pair(schema, options), schema=schema)


def without_counterpart(records: DataFrame, queries: DataFrame, *, query_vector_col: str = "query_vector",
                        vector_col: str = "embedding", match_cols: Sequence[str] = ()) -> DataFrame:
    """Queries that no record can answer: none has equal match values and a vector of the query's length."""
    there = records.select(*match_cols, F.size(vector_col).alias("_dim")).distinct()
    wanted = queries.withColumn("_dim", F.size(query_vector_col))
    return wanted.join(broadcast_if_small(there), [*match_cols, "_dim"], "left_anti").drop("_dim")


def _score_broadcast(records: DataFrame, queries: DataFrame, qid_col: str, query_vector_col: str, match_cols: list[str], key_col: str,
                     vector_col: str, out_cols: list[str], schema: T.StructType, options: dict) -> DataFrame:
    """Candidates of each Arrow batch of records; the query table's size was checked by the caller."""
    table = queries.toArrow()
    lengths = table[query_vector_col].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    groups: dict = {}
    for row, (dim, *values) in enumerate(zip(lengths.tolist(), *[table[c].to_pylist() for c in match_cols])):
        groups.setdefault(tuple(values), {}).setdefault(dim, []).append(row)
    blocks = {m: [(dim, np.array(rows), _vectors(table[query_vector_col].combine_chunks().take(pa.array(rows)), dim)[1]) for dim, rows in own.items()]
              for m, own in groups.items()}
    bc = records.sparkSession.sparkContext.broadcast((blocks, table[qid_col].combine_chunks()))

    def score_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, qids = bc.value
        for b in batches:
            for values, rows in _match_groups(b, match_cols):
                if values not in blocks:
                    continue
                part = b if rows is None else b.take(pa.array(rows))
                keys = _sortable(part.column(key_col))
                for dim, own, Q in blocks[values]:
                    at, X = _vectors(part.column(vector_col), dim)
                    if not len(at):
                        continue
                    for qi, ni, sc in _best_pairs(Q, X, keys[at], **options):
                        take = pa.array(at[ni])
                        yield pa.RecordBatch.from_arrays([qids.take(pa.array(own[qi])), *[part.column(c).take(take) for c in out_cols], pa.array(sc)],
                                                         names=schema.names)

    used = list(dict.fromkeys([*out_cols, key_col, vector_col, *match_cols]))
    return spread(records.select(*[F.col(f"`{c}`") for c in used])).mapInArrow(score_batches, schema)


def _match_groups(b: pa.RecordBatch, match_cols: list[str]) -> Iterator[tuple[tuple, np.ndarray | None]]:
    """(match values, rows) of a batch; rows is None for the whole batch."""
    if not match_cols:
        yield (), None
        return
    code, values = np.zeros(b.num_rows, np.int64), []
    for c in match_cols:
        coded = b.column(c).dictionary_encode(null_encoding="encode")
        values.append(coded.dictionary.to_pylist())
        code = code * len(values[-1]) + coded.indices.to_numpy(zero_copy_only=False)
    for x in np.unique(code).tolist():
        rows, own = np.flatnonzero(code == x), []
        for v in reversed(values):
            x, k = divmod(x, len(v))
            own.append(v[k])
        yield tuple(reversed(own)), rows


def rank_within(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column], k: int,
                rank_col: str | None = None) -> DataFrame:
    """Top-k per group via ``row_number`` (planned as a window group limit)."""
    w = Window.partitionBy(*partition_cols).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


# ---------------------------------------------------------------------------
# Keyword paging over a text table
# ---------------------------------------------------------------------------

TERM_PATTERN = r"[\p{L}\p{N}]+"
SNIPPET_CHARS = 160


def terms(text: Column) -> Column:
    """Lower-cased letter/digit runs of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), 0)


def keyword_search(docs: DataFrame, queries: DataFrame, *, count: int, offset: int = 0,
                   doc_id_col: str = "doc_id", text_col: str = "text", qid_col: str = "qid",
                   query_col: str = "query", snippet_chars: int | None = SNIPPET_CHARS,
                   max_index_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One page of keyword hits per query.

    Score = occurrences in the document of any distinct query term. Ranked by
    score desc, then document id; the page is ranks ``offset+1 .. offset+count``.
    ``snippet_chars`` is the length of a hit's snippet (None: the whole text).
    ``1 <= count <= 10`` and ``offset >= 0`` or ``ValueError``. Document ids are
    unique; documents without an id are not searched.

    Query texts within ``max_index_bytes`` (the planner's estimate) become an
    inverted index that travels to the documents: a document is counted where
    it is read and only ``offset + count`` candidates a query and task are
    shuffled. More queries meet the counted (document, term) rows in a join.
    """
    if not 1 <= count <= 10:
        raise ValueError("count must be between 1 and 10")
    if offset < 0:
        raise ValueError("offset must be >= 0")
    docs = docs.filter(F.col(doc_id_col).isNotNull())
    qterms = queries.select(qid_col, F.explode(terms(F.col(query_col))).alias("term")).distinct()
    words = spread(docs, doc_id_col).select(doc_id_col, F.explode(terms(F.col(text_col))).alias("term"))
    small = is_small(queries, max_index_bytes)
    hits = (_indexed_hits(words, qterms, doc_id_col, qid_col, offset + count) if small
            else _joined_hits(words, qterms, doc_id_col, qid_col))
    w = Window.partitionBy(qid_col).orderBy(F.col("score").desc(), F.col(doc_id_col).asc())
    page = (hits.withColumn("rank", F.row_number().over(w))
            .filter((F.col("rank") > offset) & (F.col("rank") <= offset + count)))
    # A page has at most ten rows a query, so it is broadcast exactly where the queries were.
    snippet = F.col(text_col) if snippet_chars is None else F.substring(F.col(text_col), 1, snippet_chars)
    return (docs.select(doc_id_col, text_col).join(F.broadcast(page) if small else page, doc_id_col)
            .select(doc_id_col, qid_col, "score", "rank", snippet.alias("snippet")))


def _joined_hits(words: DataFrame, qterms: DataFrame, doc_id_col: str, qid_col: str) -> DataFrame:
    """(qid, document, score) of all pairs that share a term, by shuffles; for query sets of any size.

    A common word is joined to its queries once per document, not once per occurrence.
    """
    tf = (words.join(qterms.select("term").distinct(), "term", "left_semi")
          .groupBy(doc_id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    return tf.join(qterms, "term").groupBy(qid_col, doc_id_col).agg(F.sum("tf").alias("score"))


def _indexed_hits(words: DataFrame, qterms: DataFrame, doc_id_col: str, qid_col: str, k: int) -> DataFrame:
    """(qid, document, score): each task's best ``k`` documents of every query, without a shuffle.

    The index (term -> queries) is sorted by term and broadcast. Words of the
    vocabulary arrive document by document, as the explode left them, as term
    numbers only.
    """
    spark = words.sparkSession
    index = qterms.sort("term").toArrow()  # size-checked by the caller
    coded = index["term"].combine_chunks().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    starts = np.concatenate(([0], np.cumsum(np.bincount(coded.indices.to_numpy(), minlength=len(vocabulary)))))
    qids = index[qid_col].combine_chunks()
    asked = qids.dictionary_encode(null_encoding="encode")
    shared = spark.sparkContext.broadcast((starts, asked.indices.to_numpy().astype(np.int64), asked.dictionary))
    numbered = spark.createDataFrame([(t, i) for i, t in enumerate(vocabulary)], "term string, _term int")
    rows = words.join(F.broadcast(numbered), "term").select(doc_id_col, "_term")
    schema = T.StructType([qterms.schema[qid_col], words.schema[doc_id_col], T.StructField("score", T.LongType())])
    return rows.mapInArrow(_best_documents(shared, k, schema), schema)


#: (document, query) pairs scored at a time, besides those of one document (which the index bounds).
_PAIR_SLICE = 1 << 20


def _best_documents(shared, k: int, schema: T.StructType):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, document, term, occurrences) of whole documents: the last one of a batch waits for the next batch."""
        n_terms = len(shared.value[0]) - 1
        waiting, late_terms, late_counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            ids, term, n = b.column(0), b.column(1).to_numpy().astype(np.int64), np.ones(b.num_rows, np.int64)
            if waiting is not None:
                ids = pa.concat_arrays([pa.repeat(waiting, len(late_terms)), ids])
                term, n = np.concatenate((late_terms, term)), np.concatenate((late_counts, n))
            coded = ids.dictionary_encode()
            pair, at = np.unique(coded.indices.to_numpy().astype(np.int64) * n_terms + term, return_inverse=True)
            n = np.bincount(at, weights=n, minlength=len(pair)).astype(np.int64)
            doc, term = np.divmod(pair, n_terms)
            last = int(coded.indices[-1].as_py())
            waiting, late_terms, late_counts = coded.dictionary[last], term[doc == last], n[doc == last]
            yield coded.dictionary, doc[doc != last], term[doc != last], n[doc != last]
        if waiting is not None:
            yield pa.array([waiting.as_py()], waiting.type), np.zeros(len(late_terms), np.int64), late_terms, late_counts

    def scored(ids: pa.Array, doc: np.ndarray, term: np.ndarray, n: np.ndarray):
        """(query, document, score) of a slice of whole documents."""
        starts, asked, _ = shared.value
        width = starts[term + 1] - starts[term]
        ends = np.cumsum(width)
        place = np.repeat(starts[term] - ends + width, width) + np.arange(ends[-1])
        n_queries = int(asked.max()) + 1
        pair, at = np.unique(np.repeat(doc, width) * n_queries + asked[place], return_inverse=True)
        return pair % n_queries, pair // n_queries, np.bincount(at, weights=np.repeat(n, width)).astype(np.int64)

    def slices(doc: np.ndarray, term: np.ndarray):
        """Bounds of runs of whole documents with about ``_PAIR_SLICE`` pairs."""
        starts = shared.value[0]
        if not len(doc):
            return
        ends = np.cumsum(starts[term + 1] - starts[term])
        cuts = np.append(np.flatnonzero(np.diff(doc)) + 1, len(doc))
        lo = 0
        while lo < len(doc):
            room = np.searchsorted(ends[cuts - 1], (ends[lo - 1] if lo else 0) + _PAIR_SLICE, "right")
            hi = int(cuts[max(room - 1, np.searchsorted(cuts, lo, "right"))])
            yield lo, hi
            lo = hi

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value[2]
        q, score, held = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        floor = np.zeros(len(asked), np.int64)  # the k-th score of a query with k documents
        for ids, doc, term, n in counted(batches):
            for lo, hi in slices(doc, term):
                new_q, new_doc, new_score = scored(ids, doc[lo:hi], term[lo:hi], n[lo:hi])
                reach = new_score >= floor[new_q]
                if not reach.any():
                    continue
                found = ids.take(pa.array(new_doc[reach]))
                held = found if held is None else pa.concat_arrays([held, found])
                q, score = np.concatenate((q, new_q[reach])), np.concatenate((score, new_score[reach]))
                order = np.lexsort((_sortable(held), -score, q))
                first = np.searchsorted(q[order], q[order], "left")
                order = order[np.arange(len(order)) - first < k]
                q, score, held = q[order], score[order], held.take(pa.array(order))
                first = np.flatnonzero(np.diff(q, prepend=-1))
                full = np.diff(np.append(first, len(q))) == k
                floor[q[first[full]]] = score[first[full] + k - 1]
        if held is not None:
            yield pa.RecordBatch.from_arrays([asked.take(pa.array(q)), held, pa.array(score)], names=schema.names)

    return work


# ---------------------------------------------------------------------------
# Memory search and grounding
# ---------------------------------------------------------------------------

def search_memory(records: DataFrame, queries: DataFrame, *, embedder, filters=None, min_relevance: float = 0.0,
                  limit: int, qid_col: str = "qid", query_col: str = "query", tags_col: str = "tags",
                  key_col: str = "key", vector_col: str = "embedding") -> DataFrame:
    """Embed each query text, keep records matching any tag filter, rank by cosine.

    ``filters`` is a list of ``{tag: value or [values]}``: OR across filters,
    AND inside one. ``limit=-1`` means no limit, which has to be asked for. In-memory floor (``>=``).
    """
    from memweave.functions.filters import tag_filters

    qv = queries.select(qid_col, embedder(F.col(query_col)).alias("query_vector"))
    recs = records.filter(tag_filters(F.col(tags_col), filters or []))
    return nearest_many(recs, qv, top_k=None if limit < 0 else limit, min_relevance=min_relevance,
                        policy="memory", qid_col=qid_col, key_col=key_col, vector_col=vector_col)


def grounding(hits: DataFrame, *, token_budget: int, qid_col: str = "qid", key_col: str = "key",
              text_col: str = "text", tokens_col: str = "n_tokens") -> DataFrame:
    """Facts for an answer: best hits first while their running token sum fits the budget.

    Returns one row per query: the kept facts joined by newlines, their count
    and token total. (Answer generation itself is not part of this library.)
    Token counts are at least 0 (null: 0).

    A fact with tokens costs one at least, so a query's first ``token_budget + 1``
    of them decide the cut: a group limit keeps those in each task before the
    shuffle. Facts without tokens are groups of their own there (by key, which
    is unique within a query) and all reach the running sum.
    """
    tokens = F.coalesce(F.col(tokens_col), F.lit(0))
    order = [F.col("score").desc(), F.col(key_col).asc()]
    free = F.when(tokens <= 0, F.col(key_col).cast("string"))
    prefix = rank_within(hits.withColumn("_free", free), [qid_col, "_free"], order, token_budget + 1).drop("_free")
    w = Window.partitionBy(qid_col).orderBy(*order)
    kept = (prefix.withColumn("_run", F.sum(tokens).over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_run") <= token_budget))
    return kept.groupBy(qid_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", text_col))), lambda x: x[text_col]),
                     "\n").alias("facts"),
        F.count(F.lit(1)).alias("n_facts"), F.sum(tokens).cast("bigint").alias("n_tokens"))
