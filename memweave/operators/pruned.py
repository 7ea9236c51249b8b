"""Exact cosine search that skips blocks of records by a bound (N3, N5 over a stored index).

The index deals records to the nearest of many pivots, which are records
themselves, and keeps each block's number of rows and its radius: the largest
angle between its pivot and a member. No member of a block can be closer to a query
than the query's angle to the pivot less the radius. A search reads each query's
nearest blocks first, takes the k-th score found there as a floor, and then reads
only the blocks whose bound reaches that floor. Results equal the full scan's.
The second reading pairs strips of queries with strips of whole blocks: what is
shuffled grows with the rows and strips, not with the blocks that a query reads.

Zero vectors have no cosine and never match; vectors of another length than the
query's neither. Scores, rounding, floors and ties are those of ``search.nearest_many``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from memweave.functions.blocks import pair_blocks
from memweave.functions.parallel import spread
from memweave.functions.sizing import broadcast_if_small
from memweave.operators import search
from memweave.session import materialize

#: Scores are rounded to 6 places; a block is skipped only if its bound lies below the floor by more than this.
MARGIN = 2e-6
#: The block table travels to the queries up to this many rows (about 20 bytes each); an index with more is searched whole.
MAX_BLOCKS = 2_000_000


@dataclass
class BlockIndex:
    """Written records with their block, the block table, and the pivots (bounded by ``max_pivots``) by vector length."""

    records: DataFrame
    blocks: DataFrame
    pivots: dict[int, np.ndarray]
    match_cols: list[str]
    key_col: str
    vector_col: str


def _unit(X: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; rows without a direction become NaN."""
    with np.errstate(divide="ignore", invalid="ignore"):
        U = X / np.linalg.norm(X, axis=1, keepdims=True)
    U[~np.isfinite(U).all(axis=1)] = np.nan
    return U


def build_index(records: DataFrame, *, match_cols: Sequence[str] = (), key_col: str = "key", vector_col: str = "embedding",
                rows_per_block: int = 1024, max_pivots: int = 32_768) -> BlockIndex:
    """Deal every record to its nearest pivot of the same vector length.

    There is a pivot for every ``rows_per_block`` records, those with the
    smallest hashes of key and vector, and at most ``max_pivots``, so that the
    pivots fit a broadcast; beyond that, blocks grow and are read in parts.
    """
    match_cols = list(match_cols)
    n = records.count()
    count = max(1, min(max_pivots, -(-n // rows_per_block)))
    drawn = records.filter(F.size(vector_col) > 0).select(vector_col, F.xxhash64(key_col, vector_col).alias("_h")).orderBy("_h").limit(count).toArrow()
    column = drawn[vector_col].combine_chunks()
    pivots = {}
    for dim in sorted(set(column.value_lengths().to_pylist())):
        own = _unit(search._vectors(column, dim)[1])
        pivots[dim] = own[~np.isnan(own[:, 0])]
    bc = records.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType([*records.schema.fields, T.StructField("_block", T.IntegerType()), T.StructField("_cos", T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):  # bounds the score matrix
                b = whole.slice(lo, 1024)
                block, cos = np.full(b.num_rows, -1, np.int32), np.full(b.num_rows, np.nan)
                vectors = b.column(vector_col)
                for dim in set(vectors.value_lengths().fill_null(0).to_pylist()) - {0}:
                    at, X = search._vectors(vectors, dim)
                    U, P = _unit(X), bc.value.get(dim, np.zeros((0, dim)))
                    good = ~np.isnan(U[:, 0])
                    if len(P):
                        S = U[good] @ P.T
                        block[at[good]], cos[at[good]] = S.argmax(axis=1), S.max(axis=1)
                    else:  # no pivot of this length: one block that is never skipped
                        block[at[good]], cos[at[good]] = 0, -1.0
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(block), pa.array(cos)], names=schema.names)

    dealt = spread(records).mapInArrow(assign, schema).filter("_block >= 0").withColumn("_row", F.monotonically_increasing_id())
    written = materialize(dealt.withColumn("_dim", F.size(vector_col)), "indexed")
    blocks = materialize(written.groupBy(*match_cols, "_dim", "_block").agg(F.count("*").alias("_n"), F.min("_cos").alias("_cos")), "blocks")
    return BlockIndex(written, blocks, pivots, match_cols, key_col, vector_col)


def nearest(index: BlockIndex, queries: DataFrame, *, top_k: int, min_relevance: float | None = 0.0, policy: str = "memory",
            qid_col: str = "qid", query_vector_col: str = "query_vector", where: Column | None = None,
            query_block: int = 1024, record_block: int = 16_384) -> tuple[DataFrame, DataFrame]:
    """(hits, visits): the rows of ``nearest_many`` without vectors, and (qid, blocks, visited) of every query.

    ``where`` filters the records (N5). Query ids must be unique.
    """
    if top_k <= 0:
        raise ValueError("top_k must be positive")
    rows = index.records if where is None else index.records.filter(where)
    out = [c for c in index.records.columns if c not in (index.vector_col, "_block", "_cos", "_row", "_dim")]
    match, by = index.match_cols, [*[f"_match{k}" for k in range(len(index.match_cols))], "_dim"]
    q = queries.select(*[F.col(c).alias(f"_match{k}") for k, c in enumerate(match)], F.size(query_vector_col).alias("_dim"),
                       F.col(qid_col).alias("_qid"), F.col(query_vector_col).cast("array<double>").alias("_vector"))
    q = materialize(q.filter("_dim > 0"), "queries")
    sizes = index.blocks.groupBy(*[F.col(c).alias(f"_match{k}") for k, c in enumerate(match)], "_dim").agg(F.count("*").alias("_blocks"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"q.{c}").eqNullSafe(F.col(f"n.{c}"))
    visits = q.alias("q").join(sizes.alias("n"), same, "left").select(F.col("_qid").alias(qid_col), F.coalesce("_blocks", F.lit(0)).alias("blocks"))
    if index.blocks.count() > MAX_BLOCKS:
        found = search.nearest_many(rows, queries, top_k=top_k, min_relevance=min_relevance, policy=policy, qid_col=qid_col, query_vector_col=query_vector_col,
                                    match_cols=match, key_col=index.key_col, vector_col=index.vector_col, max_broadcast_bytes=0)
        return found.select(qid_col, *out, "score"), visits.withColumn("visited", F.col("blocks"))
    first = materialize(_nearest_blocks(index, q, by, top_k), "first")
    rows = rows.select(*[F.col(c).alias(f"_match{k}") for k, c in enumerate(match)], "_dim", "_block", "_row",
                       F.col(index.key_col).alias("_key"), F.col(index.vector_col).alias("_vector"))
    chosen = first.withColumn("_block", F.explode("_read")).drop("_read")
    hits = materialize(_score(chosen, rows, [*by, "_block"], dict(metric="cosine", k=top_k, floor=min_relevance, policy=policy), query_block, record_block), "hits")
    kth = search._merge_top(hits, "_qid", "_key", top_k, True).groupBy("_qid").agg(F.count("*").alias("_c"), F.min("score").alias("_s"))
    lowest = -2.0 if min_relevance is None else float(min_relevance)
    floors = kth.select(F.col("_qid").alias("_own"), F.when(F.col("_c") >= top_k, F.greatest("_s", F.lit(lowest))).otherwise(lowest).alias("_floor"))
    second = first.join(floors, F.col("_qid") == F.col("_own"), "left").withColumn("_floor", F.coalesce("_floor", F.lit(lowest))).drop("_own")
    second = materialize(second, "second")
    more = _score_strips(index, second, rows, by, top_k, min_relevance, policy)
    best = search._merge_top(hits.unionByName(more), "_qid", "_key", top_k, True)
    found = best.select("_qid", "_row", "score").join(index.records, "_row").select(F.col("_qid").alias(qid_col), *out, "score")
    read = _visited(index, second, by).groupBy(F.col("_qid").alias(qid_col)).agg(F.sum("_n").alias("visited"))
    return found, visits.join(read, qid_col, "left").select(qid_col, "blocks", F.coalesce("visited", F.lit(0)).alias("visited"))


def _block_table(index: BlockIndex):
    """Broadcast of the pivots and of (block, rows, cosine of the radius) by match values and vector length."""
    table = index.blocks.toArrow()  # MAX_BLOCKS rows at most
    groups: dict = {}
    for row, key in enumerate(zip(*[table[c].to_pylist() for c in index.match_cols], table["_dim"].to_pylist())):
        groups.setdefault(key, []).append(row)
    block, n, cos = (table[c].to_numpy() for c in ("_block", "_n", "_cos"))
    own = {key: (block[rows], n[rows], np.clip(cos[rows], -1, 1)) for key, rows in groups.items()}
    return index.records.sparkSession.sparkContext.broadcast((index.pivots, own))


def _cosines(V: np.ndarray, pivots: dict[int, np.ndarray], block: np.ndarray) -> np.ndarray:
    """Cosine of every query and block; 1 where no pivot has the queries' length."""
    P = pivots.get(V.shape[1], np.zeros((0, V.shape[1])))
    return np.clip(V @ P[block].T, -1, 1) if len(P) else np.ones((len(V), len(block)))


def _reaches(near: np.ndarray, cos: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Whether a block's bound, the cosine of the angle to its pivot less its radius, reaches the query's floor."""
    f = np.clip(floor - MARGIN, -1, 1)
    bound = np.outer(f, cos) - np.outer(np.sqrt(1 - f * f), np.sqrt(1 - cos * cos))  # cosine of the floor's angle and the radius
    # together half a circle and more: nothing lies beyond
    return (near >= bound - 1e-12) | (f[:, None] <= -cos[None, :])


def _nearest_blocks(index: BlockIndex, q: DataFrame, by: list[str], top_k: int) -> DataFrame:
    """Queries with a direction, and in ``_read`` the nearest blocks until they hold ``top_k`` rows."""
    bc = _block_table(index)
    schema = T.StructType([*[q.schema[c] for c in [*by, "_qid", "_vector"]], T.StructField("_read", T.ArrayType(T.IntegerType()))])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, blocks = bc.value
        for whole in batches:
            for key, own in search._match_groups(whole, by):
                if key not in blocks:
                    continue
                block, n, cos = blocks[key]
                m = min(top_k, len(block))  # a block holds a row at least
                for lo in range(0, len(own), 256):  # bounds the matrix of cosines
                    b = whole.take(pa.array(own[lo:lo + 256]))
                    V = _unit(search._vectors(b.column("_vector"), key[-1])[1])
                    good = np.flatnonzero(~np.isnan(V[:, 0]))  # a query without direction has no score
                    if not len(good):
                        continue
                    near = _cosines(V[good], pivots, block)
                    order = np.argpartition(-near, m - 1, axis=1)[:, :m]
                    order = np.take_along_axis(order, np.argsort(-np.take_along_axis(near, order, axis=1), axis=1, kind="stable"), axis=1)
                    before = np.cumsum(n[order], axis=1) - n[order]
                    read = before < top_k
                    ends = np.concatenate(([0], np.cumsum(read.sum(axis=1))))
                    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(block[order[read]]))
                    yield pa.RecordBatch.from_arrays([*[b.column(c).take(pa.array(good)) for c in [*by, "_qid", "_vector"]], lists], names=schema.names)

    return spread(q.select(*by, "_qid", "_vector")).mapInArrow(choose, schema)


def _unread(b: pa.Table | pa.RecordBatch, block: np.ndarray) -> np.ndarray:
    """Mask of query and block (ascending numbers), False for the blocks a query has read."""
    read = b.column("_read")
    read = read.combine_chunks() if isinstance(read, pa.ChunkedArray) else read
    of, which = np.repeat(np.arange(len(read)), read.value_lengths().to_numpy()), read.flatten().to_numpy()
    at = np.minimum(np.searchsorted(block, which), len(block) - 1)
    mask = np.ones((len(read), len(block)), bool)
    mask[of[block[at] == which], at[block[at] == which]] = False
    return mask


def _visited(index: BlockIndex, second: DataFrame, by: list[str]) -> DataFrame:
    """(_qid, _n): the blocks that a query reads, those it began with included."""
    bc = _block_table(index)
    schema = T.StructType([second.schema["_qid"], T.StructField("_n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, blocks = bc.value
        for whole in batches:
            for key, own in search._match_groups(whole, by):
                block, _, cos = blocks[key]
                order = np.argsort(block)
                block, cos = block[order], cos[order]
                for lo in range(0, len(own), 256):
                    b = whole.take(pa.array(own[lo:lo + 256]))
                    V = _unit(search._vectors(b.column("_vector"), key[-1])[1])
                    more = _reaches(_cosines(V, pivots, block), cos, b.column("_floor").to_numpy()) & _unread(b, block)
                    n = more.sum(axis=1) + b.column("_read").value_lengths().to_numpy()
                    yield pa.RecordBatch.from_arrays([b.column("_qid"), pa.array(n.astype(np.int64))], names=schema.names)

    return spread(second.select(*by, "_qid", "_vector", "_read", "_floor")).mapInArrow(count, schema)


#: Candidates of a strip pair that are held before they are cut to each query's best.
_HELD = 1 << 20


def _score_strips(index: BlockIndex, second: DataFrame, rows: DataFrame, by: list[str], top_k: int, min_relevance: float | None, policy: str) -> DataFrame:
    """(_qid, _row, _key, score): the best rows of the other blocks whose bound reaches the query's floor.

    Strips of queries meet strips of records, so a row travels once for each strip of the other side, however
    many blocks a query reads; which of the strip's blocks it reads is decided where they have met.
    """
    n_q, n_r = second.count(), rows.count()
    dim = second.agg(F.max("_dim")).first()[0] or 1
    named = [*index.match_cols, "_dim", "_block"]
    blocks = index.blocks.select(*[F.col(c).alias(f"_own{k}") for k, c in enumerate(named)], "_n", F.col("_cos").alias("_radius"))
    same = F.lit(True)
    for k, c in enumerate([*by, "_block"]):
        same = same & F.col(c).eqNullSafe(F.col(f"_own{k}"))
    # a block stays whole, unless it is larger than a strip should be
    dealt = rows.join(broadcast_if_small(blocks), same).select(*rows.columns, "_radius", F.when(F.col("_n") > 4096, F.col("_row")).alias("_part"))
    schema = T.StructType([second.schema["_qid"], T.StructField("_row", T.LongType()),
                           T.StructField("_key", rows.schema["_key"].dataType), T.StructField("score", T.DoubleType())])
    pivots = index.records.sparkSession.sparkContext.broadcast(index.pivots)

    def work(own: pa.Table, part: pa.Table) -> pa.Table:
        held = _Held(own.num_rows, top_k)
        if own.num_rows and part.num_rows:
            _read_blocks(own, part, pivots.value, held, min_relevance, policy)
            qi, ni, sc = held.best()
        else:
            qi, ni, sc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.Table.from_arrays([own["_qid"].take(pa.array(qi)), part["_row"].take(pa.array(ni)), part["_key"].take(pa.array(ni)), pa.array(sc)], names=schema.names)

    return pair_blocks(second, dealt, by, left_hash=[F.col("_qid"), F.col("_vector")], right_hash=[F.col("_block"), F.col("_part")],
                       left_rows=search.strip_rows(n_q, dim, 1), right_rows=search.strip_rows(n_r, dim, 1), work=work, schema=schema)


class _Held:
    """Candidates (query, record, score) of a strip pair; cut to each query's best ``k`` when they become many."""

    def __init__(self, n_queries: int, k: int):
        self.k, self.parts, self.n = k, [], 0
        self.kth = np.full(n_queries, -np.inf)
        self.keys = None

    def add(self, qi: np.ndarray, ni: np.ndarray, sc: np.ndarray) -> None:
        self.parts.append((qi, ni, sc))
        self.n += len(qi)
        if self.n > 2 * _HELD + 2 * self.k * len(self.kth):
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        qi, ni, sc = (np.concatenate([z, *x]) for z, x in zip((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), zip(*self.parts) if self.parts else ((), (), ())))
        if len(qi):
            qi, ni, sc = search._first_k(qi, ni, sc, self.keys, self.k)
            last = np.flatnonzero(np.diff(qi, append=-1))
            full = last[np.diff(last, prepend=-1) == self.k]
            self.kth[qi[full]] = sc[full]
        self.parts, self.n = [(qi, ni, sc)], len(qi)
        return qi, ni, sc


def _read_blocks(own: pa.Table, part: pa.Table, pivots: dict[int, np.ndarray], held: _Held, min_relevance: float | None, policy: str) -> None:
    """Score each block of the strip against the queries whose floor its bound reaches."""
    dim = own["_dim"][0].as_py()
    part_block = part["_block"].to_numpy()
    order = np.argsort(part_block, kind="stable")
    block, starts = np.unique(part_block[order], return_index=True)
    ends = np.append(starts[1:], len(order))
    cos = np.clip(part["_radius"].to_numpy()[order[starts]], -1, 1)
    Q, X = search._vectors(own["_vector"], dim)[1], search._vectors(part["_vector"], dim)[1][order]
    qn, xn = np.linalg.norm(Q, axis=1), np.linalg.norm(X, axis=1)
    U, floor, held.keys = _unit(Q), own["_floor"].to_numpy(), search._sortable(part["_key"])
    first = 0
    while first < len(block):  # blocks with a few thousand rows, or one larger block
        last = max(first + 1, min(first + 256, int(np.searchsorted(ends, starts[first] + search.MATRIX_RECORDS, "right"))))
        here = slice(first, last)
        mask = np.empty((len(U), last - first), bool, order="F")
        for lo in range(0, len(U), 4096):  # bounds the cosines
            some = slice(lo, lo + 4096)
            mask[some] = _reaches(_cosines(U[some], pivots, block[here]), cos[here], np.maximum(floor[some], held.kth[some])) & _unread(own.slice(lo, 4096), block[here])
        size = ends[here] - starts[here]
        if 3 * (mask.sum(axis=0) * size).sum() > len(U) * size.sum():  # most are read: all queries and blocks at once
            passes = [(np.arange(len(U)), starts[first], ends[last - 1], np.repeat(np.arange(last - first), size))]
        else:
            passes = [(np.flatnonzero(mask[:, k]), starts[first + k], ends[first + k], None) for k in np.flatnonzero(mask.any(axis=0))]
        for asked, start, end, of in passes:
            for lo in range(0, len(asked), search.MATRIX_QUERIES):
                some = asked[lo:lo + search.MATRIX_QUERIES]
                for at in range(start, end, search.MATRIX_RECORDS):
                    to = min(at + search.MATRIX_RECORDS, end)
                    S = np.round((Q[some] @ X[at:to].T) / np.outer(qn[some], xn[at:to]), search.SCORE_DIGITS)
                    good = S >= np.maximum(floor[some], held.kth[some])[:, None]
                    if of is not None:
                        good &= mask[np.ix_(some, of[at - start:to - start])]
                    if min_relevance is not None and policy == "remote":
                        good &= S > min_relevance
                    qi, ni = np.nonzero(good)
                    if len(qi):
                        held.add(some[qi], order[at + ni], S[qi, ni])
        first = last


def _score(chosen: DataFrame, rows: DataFrame, by: list[str], options: dict, query_block: int, record_block: int) -> DataFrame:
    schema = T.StructType([T.StructField("_qid", chosen.schema["_qid"].dataType), T.StructField("_row", T.LongType()),
                           T.StructField("_key", rows.schema["_key"].dataType), T.StructField("score", T.DoubleType())])
    return pair_blocks(chosen, rows, by, left_hash=[F.col("_qid")], right_hash=[F.col("_row")], left_rows=query_block, right_rows=record_block,
                       work=search.score_pair(schema, options), schema=schema)
