"""Nothing is lost, nothing runs while a plan is built, and feeds may be
missing, tied, broken or skewed."""

import datetime as dt
import json
import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tellus import catalog, schemas as SC, session
from tellus.jobs import main
from tellus.operators import match as M
from tellus.operators import validate as V
from tellus.plans import clean_load as PL
from tellus.plans import rules, upsert as UP
from tellus.sources import feeds as FD
from tellus.sources import sinks as K
from tellus.streaming import lake as LK

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]), st.sampled_from(["x", None])), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS, order=st.sampled_from([(), ("o",)]))
def test_accepted_and_rejected_are_the_input(spark, rows, order):
    df = spark.createDataFrame(rows, "k string, o int, v string").coalesce(2)
    good, bad = V.validate(df, [V.Rule("small", F.col("o") < 2)], key=["k"], key_order=order)
    got = [tuple(map(str, r)) for r in good.collect()] + [tuple(map(str, (r.k, r.o, r.v))) for r in bad.collect()]
    assert sorted(got) == sorted(tuple(map(str, r)) for r in rows)
    keys = [r.k for r in good.collect()]
    assert len(keys) == len(set(keys))


def test_every_table_has_rules(spark):
    for name in SC.TABLES:
        assert rules.table_rules(name)
    bad = spark.createDataFrame([("r", "never", "C01")], "run_id string, phase string, control_id string")
    assert V.validate(bad, rules.table_rules("report"))[1].first().reasons == ["one_of:phase"]


def _lake(base, source, records, hour="05", name="a"):
    path = f"{base}/source={source}/year=2026/month=09/day=21/hour={hour}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.jsonl", "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def _event(i, **kw):
    return {"id": i, "title": "t", "link": "https://x/" + i, "categories": [{"id": "c", "title": "C"}], "sources": [{"id": "s", "url": "https://s"}],
            "geometry": [{"date": "2026-09-20T00:00:00Z", "type": "Point", "coordinates": [1.0, 2.0]}]} | kw


def _quake(i):
    return {"id": i, "properties": {"mag": 5.0, "time": 1790000000000}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0, 3.0]}}


def test_missing_feed_leaves_empty_tables_and_the_audit_runs(spark, tmp_dir):
    both, one = f"{tmp_dir}/both", f"{tmp_dir}/one"
    _lake(both, "eonet", [_event("e1"), "{broken", _event("e2", geometry=[{"date": "2026-09-20T00:00:00Z", "type": "Point", "coordinates": [1, 2, 3]}])])
    _lake(both, "usgs", [_quake("q1")])
    _lake(one, "eonet", [_event("e3")])
    out, report = f"{tmp_dir}/out", f"{tmp_dir}/report"
    for run, lake, quakes in ((1, one, 0), (2, both, 1), (3, one, 0)):
        main(["clean-load", "--lake", lake, "--out", out], spark)
        assert K.read_snapshot(spark, f"{out}/public", "earthquake").count() == quakes
        assert K.read_snapshot(spark, f"{out}/public", "event_earthquake").count() >= 0
        main(["audit", "--tables", out, "--report", report, "--as-of", "2026-09-25 00:00:00"], spark)
        per = {(r.run_id, r.phase): r["count"] for r in spark.read.parquet(report).groupBy("run_id", "phase").count().collect()}
        assert len(per) == 2 * run and set(per.values()) == {32}
        if quakes:
            assert [r.line for r in K.read_snapshot(spark, f"{out}/quarantine", "line").collect()] == ["{broken"]
            bad = {(r.table_name, *r.reasons) for r in K.read_snapshot(spark, f"{out}/quarantine", "row").collect()}
            assert bad == {("geometry", "geometry_shape")}


def test_readiness_gate(spark, tmp_dir):
    _lake(f"{tmp_dir}/lake", "eonet", [_event("e1")])
    with pytest.raises(SystemExit):
        main(["clean-load", "--lake", f"{tmp_dir}/lake", "--out", f"{tmp_dir}/out", "--require-both"], spark)


def test_compaction_does_not_change_the_latest_row(spark, tmp_dir):
    lake = f"{tmp_dir}/lake"
    _lake(lake, "eonet", [_event("e1", title="old")], hour="05", name="z")
    _lake(lake, "eonet", [_event("e1", title="new")], hour="06", name="a")
    LK.compact(spark, lake, f"{tmp_dir}/packed", 2)
    for base in (lake, f"{tmp_dir}/packed"):
        t = PL.run(FD.read_lake(spark, base, "eonet", SC.EVENT_RECORD), None)
        assert [r.title for r in t["event"].collect()] == ["new"]
        assert not {"_raw", "_file"} & set(t["staging.geometry"].columns)


def test_hot_cell_with_the_shipped_settings(spark):
    """A third of the points in one cell and hour, cut into salts by counts."""
    r = np.random.default_rng(5)
    base = dt.datetime(2026, 9, 1)

    def pts(n):
        hot = np.arange(n) % 3 == 0
        lon = np.where(hot, r.uniform(10, 10.01, n), r.uniform(-180, 180, n))
        lat = np.where(hot, r.uniform(45, 45.01, n), r.uniform(-80, 80, n))
        return [(i, base + dt.timedelta(minutes=int(m)), float(a), float(b)) for i, (m, a, b) in enumerate(zip(r.integers(0, 60, n), lon, lat))]
    schema = "id long, ts timestamp, lon double, lat double"
    left, right = spark.createDataFrame(pts(900), schema), spark.createDataFrame(pts(900), schema)
    plain = M.spacetime_candidates(left, right, max_km=300.0, max_hours=24.0)
    cut = M.spacetime_candidates(left, right, max_km=300.0, max_hours=24.0, hot_rows=20)
    a, b = ([(x.l_id, x.r_id) for x in d.collect()] for d in (plain, cut))
    assert len(a) == len(set(a)) and sorted(a) == sorted(b) and len(a) >= 300 * 300
    j = M.time_band_join(left, right, max_hours=0.5, hot_rows=10)
    k = M.time_band_join(left, right, max_hours=0.5)
    assert sorted((x.l_id, x.r_id) for x in j.collect()) == sorted((x.l_id, x.r_id) for x in k.collect())


def test_upsert_follows_the_worker_on_blanks(spark):
    good = {"geometry": []}
    recs = [("empty url", _event("e1", sources=[{"id": "s1", "url": ""}], **good), True),
            ("empty category title", _event("e2", categories=[{"id": "c2", "title": ""}], **good), True),
            ("category title of spaces", _event("e3", categories=[{"id": "c3", "title": "  "}], **good), False),
            ("title of spaces", _event("e4", title="   ", **good), False),
            ("long id", _event("e" * 51, **good), False), ("long category", _event("e6", categories=[{"id": "c6", "title": "x" * 101}], **good), False),
            ("bad url", _event("e7", sources=[{"id": "s7", "url": "ftp://x"}], **good), False)]
    df = spark.createDataFrame([(json.dumps(r), i) for i, (_, r, _) in enumerate(recs)], "_raw string, _seq int")
    from tellus.sources.tables import seed_tables
    tables, counts = UP.sync(seed_tables(spark), FD.parse_records(df, SC.EVENT_RECORD))
    assert tuple(counts.first()) == (2, 5)
    ids = {r.id for r in tables["event"].collect()}
    assert {"e1", "e2"} <= ids and not {"e3", "e4", "e6", "e7"} & ids
    assert {r.id: r.title for r in tables["category"].collect()}["c2"] == "c2"
    assert "s1" not in {r.id for r in tables["source"].collect()}


def test_sync_job(spark, tmp_dir):
    lake, out = f"{tmp_dir}/lake", f"{tmp_dir}/out"
    _lake(lake, "eonet", [_event("e1")])
    main(["clean-load", "--lake", lake, "--out", out], spark)
    _lake(f"{tmp_dir}/more", "eonet", [_event("e1", title="changed"), _event("e2")])
    main(["sync", "--lake", f"{tmp_dir}/more", "--tables", out], spark)
    assert {r.id: r.title for r in K.read_snapshot(spark, f"{out}/public", "event").collect()} == {"e1": "changed", "e2": "t"}


def test_ingest_has_several_writers_and_survives_a_restart(spark, tmp_dir):
    src, lake, ck = f"{tmp_dir}/in", f"{tmp_dir}/lake", f"{tmp_dir}/ck"
    os.makedirs(src)

    def drop(name, n):
        with open(f"{src}/{name}.json", "w") as f:
            for i in range(n):
                f.write(json.dumps({"topic": "usgs.earthquakes", "key": str(i), "value": f"{name}-{i}"}) + "\n")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else Spark joins the writers of so small a batch
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        for name, n in (("a", 300), ("b", 300)):
            drop(name, n)
            LK.ingest(LK.file_stream(spark, src), lake, ck, available_now=True).awaitTermination(120)
    finally:
        spark.conf.set(key, before)
    v = LK.volumes(spark, lake).first()
    assert (v.source, v.lines) == ("usgs", 600) and v.objects >= 4
    LK.ingest(LK.file_stream(spark, src), lake, ck, available_now=True).awaitTermination(120)
    assert LK.volumes(spark, lake).first().lines == 600  # nothing is read twice


# queries that write a lake, a stream or a report table as a step of their own
WRITERS = {"t01_lake_volumes", "t03_stream_match", "t06_stream_dedup", "q22_raw_vs_clean", "c32_audit_after"}


@pytest.mark.parametrize("name", ["q07_daily_counts", "j03_spacetime_match", "x01_validate_rejected", "k04_staging_counts", "j03_clean_load_match",
                                  "k05_rejected", "e05_upsert_counts", "c32_audit_before", "r23_repair_changes", "q21_trace_record"])
def test_building_a_plan_runs_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    group = f"plan-{name}"
    f = catalog.queries()[name]
    d = "/root/testdata/sf0.001"
    for t in ("events", "orders", "lineitem", "part", "supplier", "customer"):
        spark.read.parquet(f"{d}/{t}.parquet").schema  # footers
    spark.sparkContext.setJobGroup(group, group)
    try:
        f(spark, d)
        # reading a footer for a schema is a job of one task; nothing else may run
        jobs = tracker.getJobIdsForGroup(group)
        tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)]
        assert all(n <= 1 for n in tasks) and len(tasks) == len(jobs)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_cluster_needs_a_shared_folder():
    class Conf(dict):
        def get(self, k, d=None):
            return super().get(k, d)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
