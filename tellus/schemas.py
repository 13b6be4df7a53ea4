"""Explicit schemas (no inference anywhere).

Feed records are read with fixed StructTypes; staging tables are fully
nullable and carry ``_ingested_at``; clean tables use the same column
names with the constraints expressed in ``tellus.operators.validate``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B, TS = (T.StringType(), T.DoubleType(), T.LongType(),
                     T.IntegerType(), T.BooleanType(), T.TimestampType())


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


# --- feed records (one JSON document per line in the lake) -----------------

EVENT_RECORD = T.StructType([
    _f("id", S), _f("title", S), _f("description", S), _f("link", S),
    _f("closed", S),
    _f("categories", T.ArrayType(T.StructType([_f("id", S), _f("title", S)]))),
    _f("sources", T.ArrayType(T.StructType([_f("id", S), _f("url", S)]))),
    # coordinates stays raw JSON text (a Point array or nested Polygon)
    _f("geometry", T.ArrayType(T.StructType([
        _f("date", S), _f("type", S), _f("coordinates", S)]))),
])

QUAKE_RECORD = T.StructType([
    _f("id", S),
    _f("properties", T.StructType([
        _f("mag", D), _f("magType", S), _f("place", S), _f("time", L),
        _f("tsunami", I), _f("sig", I), _f("url", S)])),
    _f("geometry", T.StructType([
        _f("type", S), _f("coordinates", T.ArrayType(D))])),
])

CATEGORY_RECORD = T.StructType([_f("id", S), _f("title", S), _f("description", S)])
# reference-data sources may carry the address under "url" or "source"
SOURCE_RECORD = T.StructType([_f("id", S), _f("url", S), _f("source", S)])

# --- relational tables ------------------------------------------------------

EVENT = T.StructType([_f("id", S), _f("title", S), _f("description", S),
                      _f("link", S), _f("closed", TS)])
CATEGORY = T.StructType([_f("id", S), _f("title", S), _f("description", S)])
SOURCE = T.StructType([_f("id", S), _f("url", S)])
# staging keeps geometry.date as text; clean tables hold a timestamp
GEOMETRY_STAGING = T.StructType([_f("event_id", S), _f("date", S), _f("type", S),
                                 _f("coordinates", S)])
GEOMETRY = T.StructType([_f("event_id", S), _f("date", TS), _f("type", S),
                         _f("coordinates", S)])
EVENT_CATEGORY = T.StructType([_f("event_id", S), _f("category_id", S)])
EVENT_SOURCE = T.StructType([_f("event_id", S), _f("source_id", S)])
EARTHQUAKE = T.StructType([
    _f("id", S), _f("time", TS), _f("magnitude", D), _f("mag_type", S),
    _f("place", S), _f("longitude", D), _f("latitude", D), _f("depth_km", D),
    _f("tsunami", B), _f("significance", I), _f("url", S)])
EVENT_EARTHQUAKE = T.StructType([_f("event_id", S), _f("earthquake_id", S),
                                 _f("distance_km", D), _f("delay_hours", D)])

TABLES = {
    "event": EVENT, "category": CATEGORY, "source": SOURCE,
    "geometry": GEOMETRY, "event_category": EVENT_CATEGORY,
    "event_source": EVENT_SOURCE, "earthquake": EARTHQUAKE,
    "event_earthquake": EVENT_EARTHQUAKE,
}

INGESTED_AT = "_ingested_at"


def staging_schema(name: str) -> T.StructType:
    """Staging variant: geometry.date as text, plus ``_ingested_at``."""
    base = GEOMETRY_STAGING if name == "geometry" else TABLES[name]
    return T.StructType(list(base.fields) + [_f(INGESTED_AT, TS)])


# --- quality report -------------------------------------------------------

REPORT = T.StructType([
    _f("run_id", S), _f("run_at", TS), _f("phase", S), _f("control_id", S),
    _f("dimension", S), _f("severity", S), _f("table_name", S),
    _f("total_rows", L), _f("failing_rows", L), _f("fail_rate", D),
    _f("details", S)])
