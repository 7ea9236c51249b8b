"""Vector column expressions.

All folds run in double precision. A zero vector or vectors of different
length give NULL instead of NaN or an error, so a later ``score >= floor``
filter drops them (Spark orders NaN above every number).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "dotproduct", "euclidean")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def same_length(a, b) -> Column:
    a, b = _col(a), _col(b)
    return F.size(a) == F.size(b)


def dot(a, b) -> Column:
    a, b = _col(a), _col(b)
    prod = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(same_length(a, b), _sum(prod))


def norm(a) -> Column:
    a = _col(a)
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL for a zero vector or unequal lengths."""
    a, b = _col(a), _col(b)
    return F.when(same_length(a, b), F.try_divide(dot(a, b), norm(a) * norm(b)))


def euclidean(a, b) -> Column:
    a, b = _col(a), _col(b)
    diff = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.when(same_length(a, b), F.sqrt(_sum(diff)))


def similarity(metric: str, a, b) -> Column:
    metric = metric.lower()
    if metric == "cosine":
        return cosine(a, b)
    if metric == "dotproduct":
        return dot(a, b)
    if metric == "euclidean":
        return euclidean(a, b)
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")


def higher_is_better(metric: str) -> bool:
    return metric.lower() != "euclidean"


def vector_literal(values) -> Column:
    """A query vector as a typed literal (one vector, size bounded by its dimension)."""
    return F.array(*[F.lit(float(v)).cast("double") for v in values])
