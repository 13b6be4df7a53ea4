"""Referential operators.

All are semi / anti joins: Catalyst plans NOT EXISTS / EXISTS this way and
AQE turns them into broadcast joins when the parent side is measured small,
or splits a skewed child key of a sort-merge join at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellus.functions.scalars import parse_ts


def _cond(child: DataFrame, parent: DataFrame, child_key, parent_key):
    ck = [child_key] if isinstance(child_key, str) else list(child_key)
    pk = [parent_key] if isinstance(parent_key, str) else list(parent_key)
    cond = None
    for a, b in zip(ck, pk):
        e = child[a] == parent[b]
        cond = e if cond is None else (cond & e)
    return cond


def orphans(child: DataFrame, parent: DataFrame, child_key, parent_key) -> DataFrame:
    """Child rows without a parent. A NULL child key has no parent and
    is an orphan (NOT EXISTS semantics, M3)."""
    return child.join(parent, _cond(child, parent, child_key, parent_key), "left_anti")


def with_parent(child: DataFrame, parent: DataFrame, child_key, parent_key) -> DataFrame:
    """J13 accepted side / J14 CASCADE: child rows whose parent exists."""
    return child.join(parent, _cond(child, parent, child_key, parent_key), "left_semi")


def with_all_parents(child: DataFrame,
                     parents: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Drop a child row when *any* parent is missing; the
    chain of semi joins equals ``NOT (NOT EXISTS a OR NOT EXISTS b)``."""
    out = child
    for parent, ck, pk in parents:
        out = with_parent(out, parent, ck, pk)
    return out


def restrict(candidates: DataFrame, child: DataFrame, parent_key, child_key) -> DataFrame:
    """J14 RESTRICT: of the parent rows proposed for deletion, those that
    may go (no child references them)."""
    cond = _cond(candidates, child, parent_key, child_key)
    return candidates.join(child, cond, "left_anti")


def before_first_child(parent: DataFrame, child: DataFrame, *, parent_key: str,
                       parent_ts: str, child_key: str, child_ts: str,
                       child_ts_is_text: bool = True) -> DataFrame:
    """Parents whose ``parent_ts`` is earlier than the earliest child
    time. Parents without children, or whose children have no parsable time,
    are not failing (the scalar subquery yields NULL).

    The child side is pre-aggregated to one row per key (partial hash
    aggregate) before the join, so the join sees one row per parent key.
    """
    ts = parse_ts(F.col(child_ts)) if child_ts_is_text else F.col(child_ts).cast("timestamp")
    first = (child.groupBy(F.col(child_key).alias("_k"))
                  .agg(F.min(ts).alias("_first")))
    p = parent.filter(F.col(parent_ts).isNotNull())
    j = p.join(first, p[parent_key] == first["_k"], "inner")
    return (j.filter(F.col(parent_ts).cast("timestamp") < F.col("_first"))
             .drop("_k", "_first"))
