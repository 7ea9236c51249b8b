"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Vectors become integers (``floor(scale * x)``); a score is an integer inner
product, higher scores come first and ties go to the smaller id. An anchor's
positives are its best rows of the same label; for each of them a window of
scores, ``low_percent`` to ``high_percent`` percent of the positive's score,
asks for the best rows of other labels inside it.

A search takes a block of anchors and a block of candidates. Each dimension has
a list of the candidates sorted by their value there. An anchor walks all lists
at once, from the high end where its own component is positive and from the low
end where it is negative; a candidate met in any list gets its exact score by
random access. The anchor's product with the values at the current depth bounds
every candidate not met yet, and the walk ends once this threshold lies strictly
below each window's k-th score (or below the window itself): strictly, so
that no tie is lost.

Scale: positives are searched per label, negatives over all rows, both in
blocks of bounded size dealt by a hash of the id, so a label or a vector
shared by a third of the rows makes more blocks, not a larger one. Each pair of
blocks gives at most k rows for each window, which a limited window merges.

Edge cases: rows with a null id, label or vector, or with a null or non-finite
component take no part. Vectors of different lengths never meet. Rows that share
an id count as one, the smallest (label, vector) stands for them. Anchors
without positives, or with an empty window, return nothing; an empty vector
scores 0. Scores must fit 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from memweave.functions.sizing import broadcast_if_small
from memweave.session import materialize

#: Rows of a block of candidates and of a block of anchors; these bound a task's memory and change no result.
CANDIDATES, ANCHORS = 8192, 1024
#: Entries of each list read before the threshold is first compared.
FIRST_DEPTH = 32

MADE = "anchor long, wanted long, id long, score long"


class SortedLists:
    """Candidates of one block with their sorted lists, best value first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.labels = ids[by_id], vectors[by_id], labels[by_id]
        rows, dims = vectors.shape
        self.order = np.argsort(-self.vectors, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.vectors, self.order, axis=0)
        # doubles hold these products exactly and are far quicker than 64-bit integers
        self.peak = int(np.abs(vectors).max()) if vectors.size else 0
        self.exact = self.vectors.astype(np.float64) if self.peak * self.peak * max(dims, 1) < 2**53 else None

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.exact is not None and self.peak * int(np.abs(anchor).max(initial=0)) * max(len(anchor), 1) < 2**53:
            return (self.exact[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def threshold(self, anchor: np.ndarray, up: np.ndarray, down: np.ndarray, depth: int) -> int:
        """Bound on the score of every candidate that lies at ``depth`` or deeper in all lists walked."""
        last = len(self.ids) - 1
        return int(self.values[depth, up] @ anchor[up]) + int(self.values[last - depth, down] @ anchor[down])

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]],
               k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the best ``k`` allowed candidates in each window of scores (low, high); None is open."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, score = np.zeros(n, bool), np.zeros(n, np.int64)
        found = [np.zeros(0, np.int64) for _ in windows]
        going = [w for w, (low, high) in enumerate(windows) if low is None or high is None or low <= high]
        depth = 0
        while going and depth < n:
            bound = self.threshold(anchor, up, down, depth)
            going = [w for w in going if (windows[w][0] is None or bound >= windows[w][0])
                     and (len(found[w]) < k or bound >= score[found[w][-1]])]
            if not going:
                break
            to = min(n, max(FIRST_DEPTH, 2 * depth)) if len(up) + len(down) else n
            new = np.zeros(n, bool)
            new[self.order[depth:to, up].ravel()] = True
            new[self.order[n - to:n - depth, down].ravel()] = True
            if not len(up) + len(down):
                new[:] = True
            rows = np.flatnonzero(new & ~met)
            score[rows] = self.scores(rows, anchor)
            met[rows] = True
            depth = to
            seen = np.flatnonzero(met & allowed)
            for w in going:
                found[w] = self._best(seen, score, *windows[w], k)
        return [(self.ids[f], score[f]) for f in found]

    @staticmethod
    def _best(rows: np.ndarray, score: np.ndarray, low: int | None, high: int | None, k: int) -> np.ndarray:
        if low is not None:
            rows = rows[score[rows] >= low]
        if high is not None:
            rows = rows[score[rows] <= high]
        if len(rows) > k:
            own = score[rows]
            rows = rows[own >= np.partition(own, len(own) - k)[len(own) - k]]
        # rows lie in id order, so a stable sort by score leaves ties to the smaller id
        return rows[np.argsort(-score[rows], kind="stable")][:k]


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in col.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(col), -1)


def _search_pair(k: int, same_label: bool):
    def work(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if anchors.num_rows and rows.num_rows:
            lists = SortedLists(rows["id"].to_numpy(), _matrix(rows["vector"]), rows["label"].to_numpy())
            vectors = _matrix(anchors["vector"])
            for at, (own, label, asked) in enumerate(zip(anchors["id"].to_pylist(), anchors["label"].to_numpy(), anchors["windows"].to_pylist())):
                allowed = lists.ids != own if same_label else lists.labels != label
                hits = lists.search(vectors[at], allowed, [(w["low"], w["high"]) for w in asked], k)
                for w, (ids, scores) in zip(asked, hits):
                    for col, x in zip(out, ([own] * len(ids), [w["wanted"]] * len(ids), ids, scores)):
                        col.extend(x)
        cols = [pa.array(c, pa.int64()) for c in out]
        return pa.Table.from_arrays(cols, names=["anchor", "wanted", "id", "score"])

    return work


def _best_rows(rows: DataFrame, anchors: DataFrame, by: list[str], k: int, same_label: bool, candidates: int, block: int) -> DataFrame:
    """The best ``k`` rows of every window of every anchor, searched in pairs of blocks within equal ``by`` columns."""
    asked = anchors.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(block)).alias("ablocks"))
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(candidates)).alias("blocks")).join(asked, by)
    sizes = broadcast_if_small(materialize(sizes, "blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    left = anchors.join(sizes, by).withColumn("ablock", own("ablocks")).withColumn("block", every("blocks"))
    right = rows.join(sizes, by).withColumn("block", own("blocks")).withColumn("ablock", every("ablocks"))
    keys = [*by, "ablock", "block"]
    # both sides stem from one table, so their columns get identities of their own
    cols = [F.col(c).alias(c) for c in dict.fromkeys([*keys, "id", "label", "vector"])]
    found = left.select(*cols, "windows").groupBy(*keys).cogroup(right.select(*cols).groupBy(*keys)).applyInArrow(_search_pair(k, same_label), MADE)
    order = Window.partitionBy("anchor", "wanted").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, is_anchor: Column, scale: int = 256) -> DataFrame:
    """(id, label, anchor, dims, vector) of the rows that take part, one for each id."""
    x = F.col(f"`{vector_col}`")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"), x.alias("raw"),
                     F.coalesce(is_anchor, F.lit(False)).alias("anchor"), odd.alias("odd"))
    rows = rows.filter("id is not null and label is not null and raw is not null and not odd")
    one = rows.groupBy("id").agg(F.min(F.struct("label", F.transform("raw", lambda v: F.floor(v.cast("double") * scale)).alias("vector"), "anchor")).alias("r"))
    return one.select("id", "r.label", "r.anchor", F.size("r.vector").alias("dims"), "r.vector")


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95, scale: int = 256,
         candidates: int = CANDIDATES, block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``is_anchor`` marks."""
    rows = materialize(integer_vectors(df, id_col, vector_col, label_col, is_anchor, scale), "vectors")
    open_window = F.array(F.struct(F.lit(0).cast("long").alias("wanted"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high")))
    anchors = rows.filter("anchor")
    best = _best_rows(rows, anchors.withColumn("windows", open_window), ["dims", "label"], positives, True, candidates, block)
    best = materialize(best.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def share(percent: int, rounding: str) -> Column:
        """percent * score / 100 in whole numbers; decimals keep all digits."""
        return F.expr(f"cast({rounding}({percent} * cast(positive_score as decimal(20, 0)) / 100) as bigint)")

    window = F.struct(F.col("positive_score").alias("wanted"), share(low_percent, "ceil").alias("low"), share(high_percent, "floor").alias("high"))
    asked = best.groupBy("anchor_id").agg(F.collect_set(window).alias("windows"))
    asked = anchors.join(asked, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    worst = _best_rows(rows, asked, ["dims"], negatives, False, candidates, block)
    return worst.join(best, (F.col("anchor") == F.col("anchor_id")) & (F.col("wanted") == F.col("positive_score"))).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
