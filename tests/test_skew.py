"""A third of all rows on one key / one cell: results stay exact and the
hot group is split or pre-aggregated, never handled as one unit."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellus.operators import dedup as D
from tellus.operators.match import _cells, _salted, spacetime_candidates
from tellus.operators.merge import merge
from tellus.plans.audit import orphan_counts

BASE = dt.datetime(2026, 9, 1)
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _pts(rng, n, prefix):
    out = []
    for i in range(n):
        hot = i % 3 == 0  # a third of the points in one tiny region and hour
        lon = float(rng.uniform(10, 10.01)) if hot else float(rng.uniform(-180, 180))
        lat = float(rng.uniform(45, 45.01)) if hot else float(rng.uniform(-80, 80))
        t = BASE + dt.timedelta(seconds=int(rng.integers(0, (1 if hot else 60) * 3600)))
        out.append((i, t, lon, lat))
    return out


def _brute_np(left, right, max_km, max_h):
    lt = np.array([int(p[1].timestamp()) for p in left]); rt = np.array([int(p[1].timestamp()) for p in right])
    la, lo = np.radians([p[3] for p in left]), np.radians([p[2] for p in left])
    ra, ro = np.radians([p[3] for p in right]), np.radians([p[2] for p in right])
    d = rt[None, :] - lt[:, None]
    a = (np.sin((ra[None, :] - la[:, None]) / 2) ** 2
         + np.cos(la)[:, None] * np.cos(ra)[None, :] * np.sin((ro[None, :] - lo[:, None]) / 2) ** 2)
    dist = 6371.0 * 2 * np.arcsin(np.sqrt(a))
    i, j = np.nonzero((np.abs(d / 3600.0) <= max_h) & (dist <= max_km))
    return set(zip(i.tolist(), j.tolist()))


def test_match_hot_cell_skew_join(spark, skew_conf):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rng = np.random.default_rng(3)
        left, right = _pts(rng, 1500, "e"), _pts(rng, 1500, "q")
        schema = "id long, ts timestamp, lon double, lat double"
        L, R = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
        df = spacetime_candidates(L, R, max_km=300.0, max_hours=24.0)
        rows = [(r.l_id, r.r_id) for r in df.collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == _brute_np(left, right, 300.0, 24.0)
        final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "SortMergeJoin(skew=true)" in final  # AQE split the hot cell
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("n_left, n_right", [(1500, 300), (300, 1500), (1200, 1200)])
def test_a_swarm_on_either_side_is_cut_into_a_grid(spark, n_left, n_right):
    rng = np.random.default_rng(5)
    schema = "id long, ts timestamp, lon double, lat double"
    left, right = _pts(rng, n_left, "e"), _pts(rng, n_right, "q")
    L, R = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    expect = _brute_np(left, right, 300.0, 24.0)
    for side in ("left", "right"):
        rows = [(r.l_id, r.r_id) for r in spacetime_candidates(
            L, R, max_km=300.0, max_hours=24.0, space_side=side, hot_rows=50).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == expect


def test_the_fields_of_a_grid_are_bounded(spark):
    keys = ["_tb"]
    sp = spark.range(100_000).select(F.lit(7).alias("_tb"), F.col("id").alias("l_id"))
    tp = spark.range(60_000).select(F.lit(7).alias("_tb"), F.col("id").alias("r_id"))
    s, t, by = _salted(sp, tp, keys, _cells(sp, keys, "_ns", {}), _cells(tp, keys, "_nt", {}), 5000)
    fields = [df.groupBy(*by).count() for df in (s, t)]
    assert [f.count() for f in fields] == [20 * 12, 20 * 12]
    assert max(f.agg(F.max("count")).first()[0] for f in fields) < 5500
    # each pair meets in exactly one field
    assert s.filter("l_id = 3").join(t.filter("r_id = 4"), by).count() == 1


def test_hot_key_aggregates(spark, skew_conf):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("o"))
    win = D.latest(df, ["k"], ["o"])
    assert win.count() == n - n // 3 + 1
    assert win.filter("k = -1").first().o == n - 3
    parent = spark.range(0, n, 2).select(F.col("id").alias("k"))
    c = orphan_counts(df, parent, "k", "k").first()
    odd_non_hot = sum(1 for i in range(n) if i % 3 != 0 and i % 2 == 1)
    assert (c.total_rows, c.failing_rows) == (n, n // 3 + odd_non_hot)
    m = merge(df.filter("o < 100"), df, ["k"], on_match="update", order_by=["o"])
    assert m.filter("k = -1").first().o == n - 3 and m.count() == win.count()
