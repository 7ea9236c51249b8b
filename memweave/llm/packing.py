"""Packing into optimal length buckets.

The global histogram of token counts (exact below 1024, 128 cells for each
doubling above, so at most a few thousand cells whatever the input) goes to a
dynamic program that chooses ``buckets`` upper bounds with the least padding
when every document is padded to its bucket's bound. Inside a bucket the
documents, ordered by (token count, id), are cut into batches of
``token_budget // bound`` documents (one at least).

Edge cases: a null text counts 0 tokens and lies in the first bucket; a
document above the budget is a batch of its own; ties and repeated rows get
consecutive places; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from memweave.functions.ordering import dense_index
from memweave.session import materialize

EXACT, PER_DOUBLING = 1024, 128


def word_count(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def cell(n: Column) -> Column:
    """Least token count of the histogram cell that holds ``n``."""
    doubling = F.floor(F.log2(n.cast("double"))) - F.lit(int(np.log2(PER_DOUBLING)))
    width = F.pow(F.lit(2.0), doubling)
    return F.when(n < EXACT, n).otherwise((F.floor(n / width) * width).cast("bigint"))


def histogram(lengths: DataFrame, n_tokens: str = "n_tokens") -> list[tuple[int, int, int]]:
    """(longest, documents, tokens) of every cell in ascending order; bounded by the number of cells."""
    cells = lengths.groupBy(cell(F.col(n_tokens)).alias("cell")).agg(F.max(n_tokens).alias("longest"), F.count(F.lit(1)).alias("n"),
                                                                    F.sum(n_tokens).alias("tokens"))
    return [(r["longest"], r["n"], r["tokens"]) for r in sorted(cells.collect(), key=lambda r: r["cell"])]


def best_bounds(cells: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of cells with the least total padding."""
    if not cells:
        return []
    longest = np.array([c[0] for c in cells], float)
    docs = np.concatenate([[0.0], np.cumsum([c[1] for c in cells], dtype=float)])
    tokens = np.concatenate([[0.0], np.cumsum([c[2] for c in cells], dtype=float)])
    n = len(cells)
    buckets = min(buckets, n)
    # padding of the cells a..b-1 in one bucket: longest[b-1] * documents - tokens
    best = np.concatenate([[0.0], longest * docs[1:] - tokens[1:]])
    choice = []
    for _ in range(1, buckets):
        new, cut = best.copy(), np.full(n + 1, -1)
        for b in range(1, n + 1):
            total = best[:b] + longest[b - 1] * (docs[b] - docs[:b]) - (tokens[b] - tokens[:b])
            a = int(np.argmin(total))
            if total[a] < new[b]:
                new[b], cut[b] = total[a], a
        best = new
        choice.append(cut)
    bounds, end = [], n
    for cut in reversed(choice):
        if end and cut[end] >= 0:
            bounds.append(int(longest[end - 1]))
            end = int(cut[end])
    if end:
        bounds.append(int(longest[end - 1]))
    return sorted(set(bounds))


def pack(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", *, buckets: int = 16, token_budget: int = 65_536,
         n_tokens: Column | None = None) -> DataFrame:
    """(id, n_tokens, bucket, bucket_len, batch, place): one row per document.

    ``n_tokens`` counts a document's tokens (default: words). ``batch`` numbers
    the batches of a bucket and ``place`` the documents of a batch, from 0.
    """
    count = word_count(text_col) if n_tokens is None else n_tokens
    lengths = materialize(docs.select(F.col(f"`{id_col}`").alias(id_col), count.alias("n_tokens")), "lengths")
    bounds = best_bounds(histogram(lengths), buckets)
    if not bounds:
        return lengths.select(id_col, "n_tokens", F.lit(0).alias("bucket"), F.lit(0).cast("bigint").alias("bucket_len"),
                              F.lit(0).cast("bigint").alias("batch"), F.lit(0).cast("bigint").alias("place"))
    bucket, bound = F.lit(len(bounds) - 1), F.lit(bounds[-1])
    for k in range(len(bounds) - 2, -1, -1):
        inside = F.col("n_tokens") <= bounds[k]
        bucket, bound = F.when(inside, k).otherwise(bucket), F.when(inside, bounds[k]).otherwise(bound)
    placed = dense_index(lengths.withColumn("bucket", bucket).withColumn("bucket_len", bound.cast("bigint")), ["bucket"], ["n_tokens", id_col], "_i")
    size = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("bigint")
    return placed.select(id_col, "n_tokens", "bucket", "bucket_len", F.floor(F.col("_i") / size).cast("bigint").alias("batch"),
                         (F.col("_i") % size).cast("bigint").alias("place"))
