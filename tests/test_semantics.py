"""Null, order and rounding rules and replayability."""

import datetime as dt

from tellus.operators.match import match_pairs
from tellus.plans import marts as Q


def test_m5_null_order_like_postgres(spark):
    df = spark.createDataFrame([("a", 5.0, True), ("b", None, True), ("c", 7.0, True), ("d", 9.0, False)],
                               "place string, magnitude double, tsunami boolean").selectExpr(
        "place", "magnitude", "CAST(NULL AS TIMESTAMP) AS time", "0.0 AS latitude", "0.0 AS longitude", "tsunami")
    got = [r.place for r in Q.flagged_sorted(df).collect()]
    assert got == ["b", "c", "a"]  # DESC puts NULL first
    m = spark.createDataFrame([("e", "q", None, 1.0), ("e", "q2", 3.0, 1.0), ("e", "q3", 1.0, 1.0)],
                              "event_id string, earthquake_id string, distance_km double, delay_hours double")
    ev = spark.createDataFrame([("e", "t")], "id string, title string")
    qk = spark.createDataFrame([(x, "p", 5.0, None) for x in ("q", "q2", "q3")],
                               "id string, place string, magnitude double, time timestamp")
    got = [r.distance_km for r in Q.match_details(m, ev, qk).collect()]
    assert got == [1.0, 3.0, None]  # ASC puts NULL last


def test_m13_threshold_on_unrounded_distance(spark):
    base = dt.datetime(2026, 9, 1)
    schema = "id string, ts timestamp, lon double, lat double"
    # 0.0449661 degrees of latitude is about 5.00004 km: rounds to 5.0 but exceeds 5 km
    L = spark.createDataFrame([("e", base, 0.0, 0.0)], schema)
    R = spark.createDataFrame([("far", base, 0.0, 0.0449661), ("near", base, 0.0, 0.0449)], schema)
    got = {r.earthquake_id: r.distance_km for r in match_pairs(L, R, max_km=5.0, max_hours=1.0).collect()}
    assert set(got) == {"near"} and got["near"] == 4.99
