"""Scalar projections (P1-P18) as Column expressions - no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellus.functions.predicates import URL_PATTERN, col

__all__ = [
    "EARTH_RADIUS_KM", "haversine_km", "band_label", "day_of",
    "epoch_seconds", "seconds_between", "parse_ts",
    "epoch_ms_to_ts", "json_double_array", "json_array_item", "canonical_json",
    "int_to_bool", "title_or_id", "add_https", "fail_rate", "exact_ratio", "typed_null",
    "element_or_null",
]

# Fixed value: mean Earth radius used by the distance (km).
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km. asin of a value > 1 yields NaN,
    and NaN never passes a ``<=`` threshold."""
    la1, la2 = F.radians(col(lat1)), F.radians(col(lat2))
    dlat = F.radians(col(lat2) - col(lat1))
    dlon = F.radians(col(lon2) - col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius) * 2 * F.asin(F.sqrt(a))


def band_label(c) -> Column:
    """``'4 - 5'`` style integer band of a number."""
    lo = F.floor(col(c))
    return F.concat_ws(" - ", lo.cast("string"), (lo + 1).cast("string"))


def day_of(c) -> Column:
    """Calendar day (session time zone, UTC)."""
    return F.to_date(F.date_trunc("day", col(c).cast("timestamp")))


def epoch_seconds(c) -> Column:
    """Whole seconds since the epoch (sub-seconds truncated, M12)."""
    return F.unix_timestamp(col(c).cast("timestamp"))


def seconds_between(t1, t2) -> Column:
    """Signed whole seconds t2 - t1."""
    return epoch_seconds(t2) - epoch_seconds(t1)


def parse_ts(c) -> Column:
    """Text -> timestamp, unparsable -> NULL (ANSI-safe)."""
    return F.try_to_timestamp(col(c))


def epoch_ms_to_ts(c) -> Column:
    """P5: epoch milliseconds -> timestamp, milliseconds kept."""
    return F.timestamp_millis(col(c))


def json_double_array(c) -> Column:
    """JSON text -> array<double>; nested arrays / garbage -> NULL."""
    return F.from_json(col(c), "array<double>")


def json_array_item(c, i: int) -> Column:
    """I-th item of a JSON number array, NULL when absent."""
    return F.get(json_double_array(c), F.lit(i))


def element_or_null(arr, i: int) -> Column:
    """Guarded array element (never throws under ANSI)."""
    return F.get(col(arr), F.lit(i))


def canonical_json(c) -> Column:
    """M6: one canonical text for JSON values (``-118.30`` == ``-118.3``)."""
    return F.try_parse_json(col(c)).cast("string")


def int_to_bool(c, default=None) -> Column:
    """0/1 -> boolean; ``default`` replaces NULL when given."""
    b = col(c).cast("boolean")
    return b if default is None else F.coalesce(b, F.lit(default))


def title_or_id(title, id_) -> Column:
    """Trimmed title, falling back to the id when missing or blank."""
    return F.coalesce(F.nullif(F.trim(col(title)), F.lit("")), col(id_))


def add_https(c, pattern: str = URL_PATTERN) -> Column:
    """Prefix ``https://`` to a present value that is not a web
    URL but starts with a letter or digit; everything else unchanged."""
    fix = (col(c).isNotNull() & ~col(c).rlike(pattern)
           & col(c).rlike("^[a-zA-Z0-9]"))
    return F.when(fix, F.concat(F.lit("https://"), col(c))).otherwise(col(c))


def exact_ratio(num, den, scale: int = 4) -> Column:
    """num / den rounded HALF_UP at ``scale`` on the exact rational value
    (decimal arithmetic, like SQL NUMERIC), returned as double; NULL when
    ``den`` is 0."""
    q = col(num).cast("decimal(20,0)") / F.nullif(col(den), F.lit(0)).cast("decimal(20,0)")
    return F.round(q, scale).cast("double")


def fail_rate(failing, total) -> Column:
    """0 when there are no rows, else failing/total rounded to 4."""
    return F.coalesce(exact_ratio(failing, total, 4), F.lit(0.0))


def typed_null(dtype: str) -> Column:
    """P3."""
    return F.lit(None).cast(dtype)
