"""Hazard staging fixture: the shipped seed rows plus one fault per rule."""

import datetime as dt

from tellus import schemas as SC

T0 = dt.datetime(2026, 9, 21, 0, 0, 0)
T1 = dt.datetime(2026, 9, 21, 1, 0, 0)
T2 = dt.datetime(2026, 9, 21, 2, 0, 0)
AS_OF = dt.datetime(2026, 9, 25, 0, 0, 0)


def ts(s):
    return dt.datetime.fromisoformat(s)


LINK = "https://eonet.gsfc.nasa.gov/api/v3/events/"

EVENT = [  # id, title, description, link, closed, _ingested_at
    ("TEST_0001", "Wildfire - Los Angeles County, California", None, LINK + "TEST_0001", None, T0),
    ("TEST_0002", "Tropical Storm - Gulf of Mexico", None, LINK + "TEST_0002", ts("2026-09-20 00:00:00"), T0),
    ("TEST_0003", "Volcano - Kilauea, Hawaii", None, LINK + "TEST_0003", None, T0),
    ("E_NULLTITLE", None, "d", "https://x.org/4", None, T0),
    ("E_BLANK", "   ", "d", "https://x.org/5", None, T0),
    ("E_TAB", "\t", "d", "https://x.org/6", None, T0),
    ("E_NOLINK", "No link", "d", None, None, T0),
    ("E_BADLINK", "  Bad link ", "d", "example.com/x", None, T0),
    ("E_DUP", "Dup v1", "d", "https://x.org/9", None, T0),
    ("E_DUP", "Dup v2", "d", "https://x.org/9", None, T1),
    ("E_EARLY", "Closed early", "d", "https://x.org/11", ts("2026-09-10 00:00:00"), T0),
    ("E_FUTURE", "Closes later", "d", "https://x.org/12", ts("2026-09-28 00:00:00"), T0),
    ("E_TWODAYS", "Closes in 2 days", "d", "ftp://z", ts("2026-09-27 00:00:00"), T0),
    (None, "No id 1", "d", "https://x.org/13", None, T0),
    (None, "No id 2", "d", "https://x.org/14", None, T1),
]

CATEGORY = [  # id, title, description, _ingested_at
    ("wildfires", "Wildfires", "Feux", T0),
    ("severeStorms", "Severe Storms", "Tempetes", T0),
    ("volcanoes", "Volcanoes", "Volcans", T0),
    ("wildfires", "Wildfires", None, T1),
    ("c_blank", " ", None, T0),
    ("c_null", None, None, T0),
]

SOURCE = [  # id, url, _ingested_at
    ("InciWeb", "https://inciweb.wildfire.gov", T0),
    ("GDACS", "https://www.gdacs.org", T0),
    ("SIVOLC", "https://volcano.si.edu", T0),
    ("InciWeb", "https://inciweb.wildfire.gov", T1),
    ("s_noscheme", "example.com/x", T0),
    ("s_ftp", "ftp://z", T0),
    ("s_slashes", "//b", T0),
]

GEOMETRY = [  # event_id, date (text), type, coordinates (text), _ingested_at, _pos
    ("TEST_0001", "2026-09-18T18:00:00Z", "Point", "[-118.24, 34.05]", T0, 1),
    ("TEST_0001", "2026-09-19T18:00:00Z", "Point", "[-118.30, 34.10]", T0, 2),
    ("TEST_0001", "2026-09-19T18:00:00Z", "Point", "[-118.3, 34.1]", T1, 3),
    ("TEST_0002", "2026-09-17T12:00:00Z", "Point", "[-90.00, 25.00]", T0, 4),
    ("TEST_0003", "2026-09-15T06:00:00Z", "Point", "[-155.28, 19.42]", T0, 5),
    ("E_EARLY", "2026-09-15T00:00:00Z", "Point", "[10, 10]", T0, 6),
    ("E_EARLY", "not a date", "Point", "[11, 11]", T0, 7),
    ("E_FUTURE", "2026-09-20T00:00:00Z", "Polygon", "[[[0,0],[1,0],[1,1],[0,0]]]", T0, 8),
    ("E_FUTURE", "2026-09-21T00:00:00Z", "LineString", "[[0,0],[1,1]]", T0, 9),
    ("E_FUTURE", "2026-09-22T00:00:00Z", None, "[1, 2]", T0, 10),
    ("E_TAB", "2026-09-22T00:00:00Z", "Point", "[1]", T0, 11),
    ("E_TAB", "2026-09-22T01:00:00Z", "Point", "[1, 2, 3]", T0, 12),
    ("E_TAB", "2026-09-22T02:00:00Z", "Point", '{"a": 1}', T0, 13),
    ("E_TAB", "2026-09-22T03:00:00Z", "Point", None, T0, 14),
    ("GHOST", "2026-09-22T03:00:00Z", "Point", "[5, 5]", T0, 15),
    ("E_TAB", None, "Point", "[7, 7]", T0, 16),
    ("E_TAB", None, "Point", "[7, 7]", T1, 17),
]

EVENT_CATEGORY = [  # event_id, category_id, _ingested_at
    ("TEST_0001", "wildfires", T0), ("TEST_0002", "severeStorms", T0),
    ("TEST_0003", "volcanoes", T0), ("TEST_0001", "severeStorms", T0),
    ("TEST_0001", "wildfires", T1), ("GHOST", "wildfires", T0),
    ("TEST_0003", "nope", T0), (None, "volcanoes", T0), ("TEST_0002", None, T0),
]

EVENT_SOURCE = [  # event_id, source_id, _ingested_at
    ("TEST_0001", "InciWeb", T0), ("TEST_0002", "GDACS", T0), ("TEST_0003", "SIVOLC", T0),
    ("TEST_0002", "InciWeb", T0), ("TEST_0002", "InciWeb", T1), ("GHOST", "GDACS", T0),
    ("TEST_0001", "nope", T0),
]

EARTHQUAKE = [  # id, time, magnitude, mag_type, place, lon, lat, depth, tsunami, sig, url, _ingested_at
    ("us7000pn9k", ts("2026-09-15 06:12:00"), 5.40, "mww", "120 km SSW of Kokopo, Papua New Guinea",
     152.064, -4.367, 35.0, False, 449, "https://earthquake.usgs.gov/x", T0),
    ("q_lon", ts("2026-09-15 07:00:00"), 4.6, "mb", "p", 181.0, 0.0, 10.0, False, 1, None, T0),
    ("q_lat", ts("2026-09-15 08:00:00"), 4.6, "mb", "p", 0.0, -91.0, 10.0, False, 1, None, T0),
    ("q_mag_hi", ts("2026-09-15 09:00:00"), 11.0, "mb", "p", 1.0, 1.0, 10.0, False, 1, None, T0),
    ("q_mag_lo", ts("2026-09-15 10:00:00"), -2.0, "mb", "p", 1.0, 1.0, 10.0, False, 1, None, T0),
    ("q_mag_null", ts("2026-09-15 11:00:00"), None, None, None, 1.0, 1.0, None, False, 1, None, T0),
    ("q_depth", ts("2026-09-15 12:00:00"), 4.7, "mb", " ", 2.0, 2.0, -1.0, False, 1, None, T0),
    ("q_tsu5", ts("2026-09-15 13:00:00"), 5.0, "mb", "p", 3.0, 3.0, 10.0, True, 1, None, T0),
    ("q_tsunull", ts("2026-09-15 14:00:00"), None, "mb", "p", 3.5, 3.5, 10.0, True, 1, None, T0),
    ("q_old", ts("2025-01-01 00:00:00"), 4.8, "mb", "p", 4.0, 4.0, 10.0, False, 1, None, T0),
    ("q_future", ts("2026-09-30 00:00:00"), 4.8, "mb", "p", 5.0, 5.0, 10.0, None, 1, None, T0),
    ("q_nocoord", ts("2026-09-15 15:00:00"), 4.8, "mb", "p", None, 6.0, 10.0, False, 1, None, T0),
    ("q_dup", ts("2026-09-16 00:00:00"), 4.9, "mb", "first", 7.0, 7.0, 10.0, False, 1, None, T0),
    ("q_dup", ts("2026-09-16 00:00:00"), 4.9, "mb", "second", 7.0, 7.0, 10.0, False, 1, None, T1),
    ("q_fuzzy", ts("2026-09-16 00:00:20"), 4.92, "mb", "near", 7.02, 7.01, 10.0, False, 1, None, T0),
    ("q_edge", ts("2026-09-16 01:00:00"), 4.5, "mb", "edge", 180.0, 90.0, 0.0, False, 1, None, T0),
]


def _sch(name, extra=()):
    from pyspark.sql import types as T
    s = SC.staging_schema(name)
    return T.StructType(list(s.fields) + [T.StructField(n, t) for n, t in extra])


def staging(spark):
    from pyspark.sql import types as T
    return {
        "event": spark.createDataFrame(EVENT, _sch("event")),
        "category": spark.createDataFrame(CATEGORY, _sch("category")),
        "source": spark.createDataFrame(SOURCE, _sch("source")),
        "geometry": spark.createDataFrame(GEOMETRY, _sch("geometry", [("_pos", T.IntegerType())])),
        "event_category": spark.createDataFrame(EVENT_CATEGORY, _sch("event_category")),
        "event_source": spark.createDataFrame(EVENT_SOURCE, _sch("event_source")),
        "earthquake": spark.createDataFrame(EARTHQUAKE, _sch("earthquake")),
    }


def duck(con):
    """Register the same rows as DuckDB tables (insertion order = row order)."""
    import pandas as pd
    cols = {
        "event": ["id", "title", "description", "link", "closed", "_ingested_at"],
        "category": ["id", "title", "description", "_ingested_at"],
        "source": ["id", "url", "_ingested_at"],
        "geometry": ["event_id", "date", "type", "coordinates", "_ingested_at", "_pos"],
        "event_category": ["event_id", "category_id", "_ingested_at"],
        "event_source": ["event_id", "source_id", "_ingested_at"],
        "earthquake": ["id", "time", "magnitude", "mag_type", "place", "longitude", "latitude",
                       "depth_km", "tsunami", "significance", "url", "_ingested_at"],
    }
    data = {"event": EVENT, "category": CATEGORY, "source": SOURCE, "geometry": GEOMETRY,
            "event_category": EVENT_CATEGORY, "event_source": EVENT_SOURCE, "earthquake": EARTHQUAKE}
    for n, rows in data.items():
        df = pd.DataFrame(rows, columns=cols[n])
        con.register(f"_{n}", df)
        con.execute(f"CREATE TABLE {n} AS SELECT * FROM _{n}")
    con.execute("ALTER TABLE earthquake ALTER magnitude TYPE DOUBLE")
    con.execute("ALTER TABLE earthquake ALTER depth_km TYPE DOUBLE")
