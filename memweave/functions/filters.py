"""Metadata and tag predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def equality_filter(filt: Mapping) -> Column:
    """AND of ``field = value`` (a list value means any of them).

    A row lacking the field (NULL) does not match; callers that delete by a
    filter wrap it in ``coalesce(pred, false)`` so such rows stay.
    """
    if not filt:
        return F.lit(True)
    pred = None
    for field, value in filt.items():
        c = F.col(field)
        term = c.isin(list(value)) if isinstance(value, (list, tuple, set)) else c == F.lit(value)
        pred = term if pred is None else pred & term
    return pred


def tag_has(tags: Column | str, key: str, value: str) -> Column:
    """The record carries tag ``key:value`` (tags are MAP<STRING, ARRAY<STRING>>)."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(F.array_contains(F.element_at(tags, F.lit(key)), F.lit(value)), F.lit(False))


def tag_filters(tags: Column | str, filters: Sequence[Mapping[str, str | Sequence[str]]]) -> Column:
    """OR across filters, AND inside one filter; an empty list matches everything."""
    if not filters:
        return F.lit(True)
    any_pred = None
    for filt in filters:
        all_pred = F.lit(True)
        for key, value in filt.items():
            values = [value] if isinstance(value, str) else list(value)
            one = None
            for v in values:
                t = tag_has(tags, key, v)
                one = t if one is None else one | t
            all_pred = all_pred & one
        any_pred = all_pred if any_pred is None else any_pred | all_pred
    return any_pred


def flatten_tags(tags: Column | str) -> Column:
    """Tags as sorted ``key:value`` strings (the form used for filtering)."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    pairs = F.flatten(F.transform(F.map_entries(tags),
                                  lambda e: F.transform(e["value"], lambda v: F.concat(e["key"], F.lit(":"), v))))
    return F.array_sort(pairs)
