"""Relational tables (S11) and the shipped seed rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellus import schemas as SC
from tellus.operators.merge import merge


def _ts(s):
    return dt.datetime.fromisoformat(s.replace("Z", "+00:00")).replace(tzinfo=None) if s else None


# The seed rows shipped with the reference schema.
SEED = {
    "category": [
        ("wildfires", "Wildfires", "Feux de forêt et de végétation."),
        ("severeStorms", "Severe Storms", "Tempêtes, cyclones et systèmes orageux."),
        ("volcanoes", "Volcanoes", "Activité et éruptions volcaniques."),
    ],
    "source": [
        ("InciWeb", "https://inciweb.wildfire.gov"),
        ("GDACS", "https://www.gdacs.org"),
        ("SIVOLC", "https://volcano.si.edu"),
    ],
    "event": [
        ("TEST_0001", "Wildfire - Los Angeles County, California", None,
         "https://eonet.gsfc.nasa.gov/api/v3/events/TEST_0001", None),
        ("TEST_0002", "Tropical Storm - Gulf of Mexico", None,
         "https://eonet.gsfc.nasa.gov/api/v3/events/TEST_0002", _ts("2026-09-20T00:00:00Z")),
        ("TEST_0003", "Volcano - Kilauea, Hawaii", None,
         "https://eonet.gsfc.nasa.gov/api/v3/events/TEST_0003", None),
    ],
    "event_category": [("TEST_0001", "wildfires"), ("TEST_0002", "severeStorms"),
                       ("TEST_0003", "volcanoes"), ("TEST_0001", "severeStorms")],
    "event_source": [("TEST_0001", "InciWeb"), ("TEST_0002", "GDACS"),
                     ("TEST_0003", "SIVOLC"), ("TEST_0002", "InciWeb")],
    "geometry": [
        ("TEST_0001", _ts("2026-09-18T18:00:00Z"), "Point", "[-118.24, 34.05]"),
        ("TEST_0001", _ts("2026-09-19T18:00:00Z"), "Point", "[-118.30, 34.10]"),
        ("TEST_0002", _ts("2026-09-17T12:00:00Z"), "Point", "[-90.00, 25.00]"),
        ("TEST_0003", _ts("2026-09-15T06:00:00Z"), "Point", "[-155.28, 19.42]"),
    ],
}

SEED_KEYS = {"category": ["id"], "source": ["id"], "event": ["id"],
             "event_category": ["event_id", "category_id"],
             "event_source": ["event_id", "source_id"],
             "geometry": ["event_id", "date", "coordinates"]}


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    return {n: spark.createDataFrame(rows, SC.TABLES[n]) for n, rows in SEED.items()}


def seed_load(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Idempotent seed (insert, existing keys untouched)."""
    seed = seed_tables(spark)
    out = dict(tables)
    for n, df in seed.items():
        if n in tables:
            out[n] = merge(tables[n].select(*df.columns), df, SEED_KEYS[n], on_match="ignore")
        else:
            out[n] = df
    return out
