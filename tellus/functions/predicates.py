"""Row predicates (F1-F12, X1-X6) as boolean Columns.

Three-valued logic is kept on purpose: a predicate over a NULL input yields
NULL, which ``filter`` treats as false and ``count_if`` does not count
(same as the SQL the controls were written in). Wrap in
``F.coalesce(p, F.lit(False))`` where a definite answer is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col", "all_not_null", "any_null", "not_blank", "is_blank", "url_ok",
    "url_bad", "in_set", "not_in_set", "in_range", "out_of_range",
    "null_or_range", "min_size", "is_open", "in_bbox", "is_true", "URL_PATTERN",
]

# Fixed value: the URL shape the clean tables accept.
URL_PATTERN = r"^https?://"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_not_null(*cols) -> Column:
    """Every listed column is present."""
    out = None
    for c in cols:
        p = col(c).isNotNull()
        out = p if out is None else (out & p)
    return out


def any_null(*cols) -> Column:
    out = None
    for c in cols:
        p = col(c).isNull()
        out = p if out is None else (out | p)
    return out


def not_blank(c) -> Column:
    """Non-empty after trimming spaces (tabs are not spaces)."""
    return F.length(F.trim(col(c))) > 0


def is_blank(c) -> Column:
    """NULL or only spaces."""
    return col(c).isNull() | (F.trim(col(c)) == F.lit(""))


def url_ok(c, pattern: str = URL_PATTERN) -> Column:
    """F3 / X3."""
    return col(c).rlike(pattern)


def url_bad(c, pattern: str = URL_PATTERN) -> Column:
    """Present but not a web URL."""
    return col(c).isNotNull() & ~col(c).rlike(pattern)


def in_set(c, values) -> Column:
    """F4 / X4."""
    return col(c).isin(list(values))


def not_in_set(c, values) -> Column:
    """Present and outside the set (NULL is not failing)."""
    return col(c).isNotNull() & ~col(c).isin(list(values))


def in_range(c, lo, hi) -> Column:
    """Inclusive bounds."""
    return col(c).between(lo, hi)


def out_of_range(c, lo=None, hi=None) -> Column:
    """Present and strictly outside [lo, hi]."""
    conds = []
    if lo is not None:
        conds.append(col(c) < lo)
    if hi is not None:
        conds.append(col(c) > hi)
    bad = conds[0]
    for x in conds[1:]:
        bad = bad | x
    return col(c).isNotNull() & bad


def null_or_range(c, lo, hi) -> Column:
    """missing is allowed, otherwise inclusive range."""
    return col(c).isNull() | col(c).between(lo, hi)


def min_size(arr, n: int) -> Column:
    """array has at least n items (NULL array -> NULL -> dropped)."""
    return F.size(col(arr)) >= n


def is_open(closed) -> Column:
    """open status is the absence of a closing time."""
    return col(closed).isNull()


def in_bbox(lon, lat, min_lon, min_lat, max_lon, max_lat) -> Column:
    """bounding-box filter (pushes down to Parquet as two ranges)."""
    return col(lon).between(min_lon, max_lon) & col(lat).between(min_lat, max_lat)


def is_true(c) -> Column:
    return col(c) == F.lit(True)
