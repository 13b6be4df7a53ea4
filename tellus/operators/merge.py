"""Upsert / merge on plain files.

``merge(target, source, keys)`` touches only the keys present in the
source (the delta): target rows with other keys pass through an anti join
against the delta's keys, which come out of an aggregate and are therefore
measured by AQE - broadcast when small, sort-merge otherwise - so a large
target is neither sorted nor regrouped by a small delta. Idempotent:
``merge(merge(t, s), s) == merge(t, s)``. ``sinks.merge_table`` is the same
on a published table, of which it rewrites the touched buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellus.operators.dedup import earliest, latest


def without_keys(df: DataFrame, keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key (compared null-safely, like grouping) is not
    among the keys of ``keyed``."""
    k = keyed.select(*[F.col(c).alias(f"_mk{i}") for i, c in enumerate(keys)])
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(k[f"_mk{i}"]) for i, c in enumerate(keys)])
    return df.join(k, cond, "left_anti")


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
          on_match: str = "update", order_by: Sequence[str] = ()) -> DataFrame:
    """Merge ``source`` into ``target`` by ``keys`` (target keys unique).

    ``on_match="update"``: last writer wins (``ON CONFLICT DO UPDATE``); among
    several source rows with one key the greatest by ``order_by`` wins.
    ``on_match="ignore"``: first writer wins (``ON CONFLICT DO NOTHING``);
    target rows are never changed and among source rows the smallest by
    ``order_by`` is inserted when its key is new.
    """
    if on_match not in ("update", "ignore"):
        raise ValueError("on_match must be 'update' or 'ignore'")
    cols = target.columns
    src = source.select(*cols)
    order = list(order_by)
    if on_match == "update":
        win = latest(src, keys, order, nulls_first=False)
        return without_keys(target, win, keys).unionByName(win)
    first = earliest(src, keys, order, nulls_last=True)
    return target.unionByName(without_keys(first, target, keys))
