"""Deterministic deduplication.

"Keep the latest row per key" is ``row_number() = 1``. Spark limits each
group inside every map task before the shuffle (a group limit), so a key
holding a large share of the rows sends one row per task and never lands
whole in one task; columns that nobody reads afterwards are pruned. Ties are
broken by a hash of the whole row, so only identical rows can tie and the
survivor is the same after a recomputation; a caller whose order is total
passes ``total=True`` and spares reading the other columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellus.functions.predicates import any_null, col


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _first(df: DataFrame, keys: Sequence[str], order: list[Column], total: bool) -> DataFrame:
    if not total:
        order = [*order, row_hash(df)]
    n = "_nth"
    while n in df.columns:
        n = "_" + n
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(n, F.row_number().over(w)).filter(F.col(n) == 1).drop(n)


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence,
           nulls_first: bool = True, total: bool = False) -> DataFrame:
    """One row per ``keys``: the greatest by ``order_by`` (all descending).

    ``nulls_first=True`` reproduces ``ORDER BY x DESC`` of PostgreSQL, where
    a NULL ordering value ranks first. NULL keys form one group (M1).
    """
    order = [col(c).desc_nulls_first() if nulls_first else col(c).desc_nulls_last() for c in order_by]
    return _first(df, keys, order, total)


def earliest(df: DataFrame, keys: Sequence[str], order_by: Sequence,
             nulls_last: bool = True, total: bool = False) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_by`` (all ascending,
    NULL last)."""
    order = [col(c).asc_nulls_last() if nulls_last else col(c).asc_nulls_first() for c in order_by]
    return _first(df, keys, order, total)


def dedup_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence | None = None,
               null_safe: Sequence[str] = ()) -> DataFrame:
    """Exact-duplicate removal with SQL ``=`` semantics.

    A row whose key is NULL in a column compared with ``=`` never equals
    another row, so it is always kept. Columns listed in ``null_safe`` are
    compared with IS NOT DISTINCT FROM (NULLs group together). Among true
    duplicates the greatest by ``order_by`` (the "last physical row") stays;
    without ``order_by`` the rows must be identical on all columns.
    """
    strict = [k for k in keys if k not in set(null_safe)]
    if strict:
        has_null = any_null(*strict)
        kept_nulls = df.filter(has_null)
        rest = df.filter(~has_null)
    else:
        kept_nulls, rest = None, df
    if order_by:
        deduped = latest(rest, keys, order_by)
    else:
        deduped = rest.dropDuplicates(list(keys))
    return deduped if kept_nulls is None else deduped.unionByName(kept_nulls)


def distinct_rows(df: DataFrame) -> DataFrame:
    """D3: full-row dedup (hash aggregate with a partial phase)."""
    return df.distinct()


def split_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence,
                 nulls_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(winners, losers)`` of ``latest``; together they are exactly ``df``.

    Identical rows are counted first (a partial aggregate), so a tie is one
    row with a count: the winner keeps one copy and all other copies lose.
    The join that tells them apart is on the key and the row's hash, which
    spreads a hot key by its contents; all columns are compared.
    """
    names = {c: f"_w{i}" for i, c in enumerate(df.columns)}
    copies = "_copies"
    while copies in df.columns:
        copies = "_" + copies
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(copies))
    g = g.select(*df.columns, copies)
    win = latest(g, keys, order_by, nulls_first).drop(copies)
    mark = win.select(row_hash(win).alias("_wh"), *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    same = reduce(lambda x, y: x & y, [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in names.items()])
    tagged = g.withColumn("_gh", row_hash(df))
    lost = tagged.join(mark, (F.col("_gh") == F.col("_wh")) & same, "left")
    lost = lost.withColumn(copies, F.col(copies) - F.when(F.col("_wh").isNotNull(), 1).otherwise(0))
    lost = lost.filter(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return win, lost.select(*df.columns)


def losers(df: DataFrame, keys: Sequence[str], order_by: Sequence,
           nulls_first: bool = True) -> DataFrame:
    """Rows that ``latest`` drops (for quarantine or change counts), copies
    of a winner included."""
    return split_latest(df, keys, order_by, nulls_first)[1]
