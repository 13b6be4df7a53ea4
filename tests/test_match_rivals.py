"""One row per pair without a shuffle of pairs: points of one id are held
against each other where they meet; ids with several right points or with
very many left points are grouped as before, and labels come along."""

import datetime as dt

import numpy as np
import pytest

from tellus.operators.match import match_pairs, spacetime_candidates
from tellus.plans import marts as Q

BASE = dt.datetime(2026, 9, 1)
SCHEMA = "id long, ts timestamp, lon double, lat double"


def _points(rng, n, ids):
    return [(None if i % 50 == 0 else int(rng.integers(0, ids)), BASE + dt.timedelta(hours=int(rng.integers(0, 200))),
             float(rng.integers(0, 8)), float(rng.integers(0, 8))) for i in range(n)]


def _best(left, right, max_km, max_hours):
    out = {}
    for r in spacetime_candidates(left, right, max_km=max_km, max_hours=max_hours).collect():
        v = (r.distance_km, abs(r.delay_seconds), r.delay_seconds)
        out[r.l_id, r.r_id] = min(out.get((r.l_id, r.r_id), v), v)
    return {(*k, v[0], v[2]) for k, v in out.items()}


def _most_shuffled(node) -> int:
    """Rows of the largest shuffle of a plan that has run."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _most_shuffled(node.executedPlan())
    inner = [node.plan()] if name.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    own = node.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
    return max([own, *map(_most_shuffled, inner)])


@pytest.mark.parametrize("l_ids, r_ids, rivals", [(12, 10_000, 1000), (12, 10_000, 3), (12, 30, 1000), (10_000, 10_000, 1000)])
def test_one_row_per_pair_equals_the_best_candidate(spark, l_ids, r_ids, rivals):
    rng = np.random.default_rng(l_ids + r_ids + rivals)
    left, right = _points(rng, 150, l_ids), _points(rng, 80, r_ids)
    left += left[:20]  # repeated rows
    L, R = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = match_pairs(L, R, max_km=300.0, max_hours=24.0, round_output=False, rivals=rivals).collect()
    rows = [(r.event_id, r.earthquake_id, r.distance_km, r.delay_seconds) for r in got]
    assert len(rows) == len(set(rows)) and set(rows) == _best(L, R, 300.0, 24.0)


def test_pairs_are_not_grouped_where_ids_meet_in_one_task(spark):
    # two near points of each left id, all in one place
    left = [(i // 2, BASE + dt.timedelta(minutes=i), 10.0, 45.0) for i in range(300)]
    right = [(i, BASE, 10.0, 45.0) for i in range(300)]
    df = match_pairs(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), max_km=100.0, max_hours=24.0)
    assert len(df.collect()) == 150 * 300
    assert 0 < _most_shuffled(df._jdf.queryExecution().executedPlan()) < 150 * 300


def test_labels_are_those_of_a_join_by_id(spark):
    rng = np.random.default_rng(8)
    left, right = _points(rng, 60, 40), _points(rng, 60, 10_000)
    L, R = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    # ids without labels, with one row and with two
    ev = spark.createDataFrame([(i, f"e{i}.{k}") for i in range(40) for k in range(i % 3)] + [(None, "none")], "id long, title string")
    qk = spark.createDataFrame([(r[0], f"p{n}", 5.0, BASE) for n, r in enumerate(right) if n % 4] + [(right[1][0], "again", 6.0, BASE)],
                               "id long, place string, magnitude double, time timestamp")

    def match(left=None, right=None):
        return match_pairs(L, R, max_km=300.0, max_hours=24.0, left_labels=left, right_labels=right)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(Q.match_details(match, ev, qk)) == rows(Q.match_details(match(), ev, qk))
    assert rows(Q.match_triples(match, qk)) == rows(Q.match_triples(match(), qk))


def test_no_join_of_cells_leaves_the_generated_code(spark):
    # a join whose condition holds a lambda does; pairs near the threshold and points without a place are as before
    rng = np.random.default_rng(4)
    left, right = _points(rng, 120, 60), _points(rng, 60, 10_000)
    left += [(500, BASE, float("nan"), 3.0), (501, BASE, 3.0, float("nan")), (502, BASE, 3.0, 95.0), (502, BASE, 4.0, 85.0)]
    right += [(20_000, BASE, 3.0, 3.0), (20_001, BASE, 183.0, 86.0), (20_002, BASE, float("nan"), float("nan"))]
    L, R = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = match_pairs(L, R, max_km=300.0, max_hours=24.0, round_output=False, partitions=5)
        joins = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin [_cx" in line and "_row" in line]
        assert len(joins) > 2 and all("*(" in line.split("SortMergeJoin")[0] for line in joins)
        assert {(r.event_id, r.earthquake_id, r.distance_km, r.delay_seconds) for r in df.collect()} == _best(L, R, 300.0, 24.0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
