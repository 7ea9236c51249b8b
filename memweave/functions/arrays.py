"""Array helpers for per-row Catalyst programs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once per row and bind it to ``fn``'s argument.

    An expression referenced inside a higher-order function's lambda is
    re-evaluated for every element; binding it to a lambda variable through a
    one-element ``transform`` evaluates it once.
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


def empty(element_type: str) -> Column:
    return F.array().cast(f"array<{element_type}>")


def sum_ints(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0), lambda a, x: a + x)
