import datetime as dt

import numpy as np
import pytest

from tellus.operators.match import match_pairs, spacetime_candidates

BASE = dt.datetime(2026, 9, 1)


def _brute(left, right, max_km, max_h):
    out = set()
    for lid, lt, llon, llat in left:
        for rid, rt, rlon, rlat in right:
            d = int(rt.timestamp()) - int(lt.timestamp())
            if abs(d / 3600.0) > max_h:
                continue
            la1, la2 = np.radians(llat), np.radians(rlat)
            a = (np.sin(np.radians(rlat - llat) / 2) ** 2
                 + np.cos(la1) * np.cos(la2) * np.sin(np.radians(rlon - llon) / 2) ** 2)
            dist = 6371.0 * 2 * np.arcsin(np.sqrt(a))
            if dist <= max_km:
                out.add((lid, rid, d))
    return out


def _points(rng, n, prefix):
    pts = []
    for i in range(n):
        lon = float(rng.uniform(-180, 180))
        lat = float(rng.uniform(-90, 90))
        if i % 10 == 0:
            lat = float(rng.choice([90.0, -90.0, 89.5, -89.7]))
        if i % 10 == 1:
            lon = float(rng.choice([180.0, -180.0, 179.9, -179.8]))
        t = BASE + dt.timedelta(seconds=int(rng.integers(0, 40 * 24 * 3600)))
        pts.append((f"{prefix}{i}", t, lon, lat))
    # exact 168 h apart, same place; and 168 h + 1 s
    pts.append((f"{prefix}x", BASE, 10.0, 10.0))
    return pts


@pytest.mark.parametrize("seed,max_km,max_h", [(1, 500.0, 168.0), (2, 2000.0, 48.0), (3, 50.0, 500.0)])
def test_bucketed_equals_brute_force(spark, seed, max_km, max_h):
    rng = np.random.default_rng(seed)
    left = _points(rng, 300, "e")
    right = _points(rng, 400, "q")
    right.append(("qexact", BASE + dt.timedelta(hours=max_h), 10.0, 10.0))
    right.append(("qlate", BASE + dt.timedelta(hours=max_h, seconds=1), 10.0, 10.0))
    schema = "id string, ts timestamp, lon double, lat double"
    L, R = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    for side in ("right", "left"):
        got = spacetime_candidates(L, R, max_km=max_km, max_hours=max_h, space_side=side)
        rows = [(r.l_id, r.r_id, r.delay_seconds) for r in got.collect()]
        assert len(rows) == len(set(rows)), "a pair met more than once"
        assert set(rows) == _brute(left, right, max_km, max_h)
    ids = {(r.l_id, r.r_id) for r in got.collect()}
    assert ("ex", "qexact") in ids and ("ex", "qlate") not in ids


def test_match_one_row_per_pair_nearest_point(spark):
    schema = "id string, ts timestamp, lon double, lat double"
    L = spark.createDataFrame([("E1", BASE, 0.0, 0.0), ("E1", BASE, 0.0, 1.0),
                               ("E1", BASE + dt.timedelta(hours=1), 0.0, 1.0)], schema)
    R = spark.createDataFrame([("Q1", BASE + dt.timedelta(hours=2), 0.0, 1.0)], schema)
    r = match_pairs(L, R).collect()
    assert len(r) == 1
    assert r[0].distance_km == 0.0 and r[0].delay_hours == 1.0 and r[0].delay_seconds == 3600
