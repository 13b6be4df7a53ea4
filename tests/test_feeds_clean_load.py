import json
import os

from pyspark.sql import functions as F

from tellus import schemas as SC
from tellus.plans import clean_load as PL
from tellus.sources import feeds as FD
from tellus.streaming import lake as LK

EV1 = {"id": "EONET_1", "title": " Wildfire A ", "description": None, "link": "https://e.org/1",
       "closed": None,
       "categories": [{"id": "wildfires", "title": "Wildfires"}],
       "sources": [{"id": "InciWeb", "url": "https://inciweb.wildfire.gov"}, {"id": "Bad", "url": "ftp://x"}],
       "geometry": [{"date": "2026-09-18T18:00:00Z", "type": "Point", "coordinates": [-118.30, 34.10]},
                    {"date": "2026-09-18T18:00:00Z", "type": "Point", "coordinates": [-118.3, 34.1]},
                    {"date": "2026-09-19T18:00:00Z", "type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 0]]]}]}
EV2 = {"id": "EONET_2", "title": "   ", "link": "https://e.org/2", "categories": [], "sources": [],
       "geometry": []}
EV3 = {"id": "EONET_3", "title": "Storm", "link": "https://e.org/3", "closed": "garbage",
       "categories": [{"id": "severeStorms", "title": None}], "sources": None,
       "geometry": [{"date": "bad", "type": "Point", "coordinates": [1, 2]}]}
Q1 = {"id": "us1", "properties": {"mag": 5.4, "magType": "mww", "place": "near", "time": 1789452000000,
                                  "tsunami": 1, "sig": 449, "url": "https://usgs.gov/us1"},
      "geometry": {"type": "Point", "coordinates": [-118.0, 34.0, 10.0]}}
Q2 = {"id": "us2", "properties": {"mag": 11.0, "time": 1789452000000}, "geometry": {"coordinates": [0, 0]}}
Q3 = {"id": "", "properties": {"mag": 4.6, "time": 1789452000000}, "geometry": {"coordinates": [0, 0]}}
Q4 = {"id": "us4", "properties": {"mag": "not-a-number", "time": 1789452000000, "url": "nope"},
      "geometry": {"coordinates": [1, 1]}}


def _write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for x in lines:
            f.write(x + "\n")


def test_envelope_unnest_keeps_raw_text(spark):
    env = json.dumps({"events": [EV1, EV2]})
    qenv = json.dumps({"features": [Q1, Q3]})
    df = spark.createDataFrame([(env,)], "value string")
    out = FD.unnest_envelope(df, "events").collect()
    assert [r.key for r in out] == ["EONET_1", "EONET_2"]
    assert json.loads(out[0].value) == EV1
    q = FD.unnest_envelope(spark.createDataFrame([(qenv,)], "value string"), "features",
                           require_key=True).collect()
    assert [r.key for r in q] == ["us1"]


def test_reference_rows_fallback(spark):
    env = json.dumps({"sources": [{"id": "A", "url": "https://a"}, {"id": "B", "url": "", "source": "https://b"},
                                  {"id": "C"}]})
    rows = FD.reference_rows(spark.createDataFrame([(env,)], "value string"), "sources").collect()
    assert [(r.id, r.url) for r in rows] == [("A", "https://a"), ("B", "https://b")]


def test_lake_roundtrip_and_clean_load(spark, tmp_dir):
    base = os.path.join(tmp_dir, "lake")
    _write_lines(f"{base}/source=eonet/year=2026/month=09/day=21/hour=10/a.jsonl",
                 [json.dumps(EV1), json.dumps(EV2), "{not json", json.dumps(EV3)])
    _write_lines(f"{base}/source=eonet/year=2026/month=09/day=21/hour=11/b.jsonl", [json.dumps(EV1)])
    _write_lines(f"{base}/source=usgs/year=2026/month=09/day=21/hour=10/c.jsonl",
                 [json.dumps(q) for q in (Q1, Q2, Q3, Q4)])
    ev = FD.read_lake(spark, base, "eonet", SC.EVENT_RECORD)
    qk = FD.read_lake(spark, base, "usgs", SC.QUAKE_RECORD)
    assert ev.count() == 5 and ev.filter("_corrupt").count() == 1
    assert FD.read_lake(spark, base, "eonet", SC.EVENT_RECORD, hours=("2026-09-21 11", "2026-09-21 11")).count() == 1
    assert FD.is_ready(ev, qk)
    missing = FD.read_lake(spark, os.path.join(tmp_dir, "nope"), "eonet", SC.EVENT_RECORD)
    assert missing.count() == 0 and not FD.is_ready(missing)

    out = PL.run(ev, qk)
    assert out["staging.event"].count() == 5
    assert out["staging.geometry"].count() == 7
    assert out["staging.earthquake"].count() == 4
    e = {r.id: r for r in out["event"].collect()}
    assert set(e) == {"EONET_1", "EONET_3"} and e["EONET_1"].title == "Wildfire A"
    assert e["EONET_3"].closed is None
    assert [r.id for r in out["source"].collect()] == ["InciWeb"]
    assert {(r.id, r.title) for r in out["category"].collect()} == {("wildfires", "Wildfires"),
                                                                  ("severeStorms", "severeStorms")}
    g = out["geometry"].collect()
    assert len(g) == 2  # -118.30 and -118.3 are one point; bad date dropped
    q = {r.id: r for r in out["earthquake"].collect()}
    assert set(q) == {"", "us1", "us4"}  # only NULL ids are gated here; the collector drops ""
    assert q["us1"].tsunami is True and q["us4"].tsunami is False and q["us4"].url is None
    assert q["us4"].magnitude is None
    m = out["event_earthquake"].collect()
    assert [(r.event_id, r.earthquake_id) for r in m] == [("EONET_1", "us1")]
    assert m[0].delay_hours == round((1789452000 - 1789754400) / 3600.0, 2)


def test_stream_to_lake_and_volumes(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "inbox")
    msgs = [{"topic": "eonet.events", "key": "E1", "value": json.dumps(EV1)},
            {"topic": "usgs.earthquakes", "key": "us1", "value": json.dumps(Q1)},
            {"topic": "other.topic", "key": "x", "value": "{broken"}]
    _write_lines(os.path.join(inbox, "m1.json"), [json.dumps(m) for m in msgs])
    _write_lines(os.path.join(inbox, "m2.json"), [json.dumps(msgs[0])])
    lake, ck = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "ck")
    q = LK.ingest(LK.file_stream(spark, inbox), lake, ck, available_now=True,
                  flush_time=F.lit("2026-09-21 10:30:00").cast("timestamp"))
    q.awaitTermination(120)
    vol = {r.source: (r.objects, r.lines) for r in LK.volumes(spark, lake).collect()}
    assert vol == {"eonet": (2, 2), "usgs": (1, 1), "other_topic": (1, 1)}
    assert os.path.isdir(os.path.join(lake, "source=eonet", "year=2026", "month=09", "day=21", "hour=10"))
    ev = FD.read_lake(spark, lake, "eonet", SC.EVENT_RECORD)
    assert ev.count() == 2 and ev.select("id").distinct().count() == 1
    # replay after restart: nothing new is written
    q2 = LK.ingest(LK.file_stream(spark, inbox), lake, ck, available_now=True)
    q2.awaitTermination(120)
    assert LK.volumes(spark, lake).agg(F.sum("lines")).first()[0] == 4


def test_stream_dedup_within_watermark(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "recs")
    rows = [{"id": f"e{i % 50}", "ts": "2026-09-21T00:00:00Z"} for i in range(200)]
    _write_lines(os.path.join(inbox, "a.json"), [json.dumps(r) for r in rows])
    s = spark.readStream.schema("id string, ts timestamp").json(inbox)
    d = LK.dedup_stream(s, ["id"], "ts", "1 hour")
    q = (d.writeStream.format("memory").queryName("dedup_t6").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.table("dedup_t6").count() == 50


def test_route(spark):
    df = spark.createDataFrame([("eonet.events",), ("a.b.c",)], "topic string")
    assert [r[0] for r in df.select(LK.route(F.col("topic"))).collect()] == ["eonet", "a_b_c"]


def test_jobs_clean_load_audit_report(spark, tmp_dir, capsys):
    from tellus import jobs
    base = os.path.join(tmp_dir, "lake")
    _write_lines(f"{base}/source=eonet/year=2026/month=09/day=21/hour=10/a.jsonl",
                 [json.dumps(EV1), json.dumps(EV2), json.dumps(EV3)])
    _write_lines(f"{base}/source=usgs/year=2026/month=09/day=21/hour=10/c.jsonl",
                 [json.dumps(q) for q in (Q1, Q2, Q4)])
    out = os.path.join(tmp_dir, "tables")
    jobs.main(["clean-load", "--lake", base, "--out", out], spark=spark)
    from tellus.sources.sinks import read_snapshot
    assert read_snapshot(spark, out + "/public", "event_earthquake").count() == 1
    assert read_snapshot(spark, out + "/staging", "event").count() == 3
    rep = os.path.join(tmp_dir, "report")
    jobs.main(["audit", "--tables", out, "--report", rep, "--with-public",
               "--as-of", "2026-09-25 00:00:00"], spark=spark)
    assert spark.read.parquet(rep).count() == 96
    jobs.main(["report", "--report", rep], spark=spark)
    assert "completeness" in capsys.readouterr().out


def test_clean_load_replay_is_identical(spark, tmp_dir):
    base = os.path.join(tmp_dir, "lake")
    _write_lines(f"{base}/source=eonet/year=2026/month=09/day=21/hour=10/a.jsonl",
                 [json.dumps(EV1), json.dumps(EV1), json.dumps(EV3)])
    _write_lines(f"{base}/source=usgs/year=2026/month=09/day=21/hour=10/c.jsonl",
                 [json.dumps(Q1), json.dumps(Q4), json.dumps(Q1)])
    runs = []
    for _ in range(2):
        ev = FD.read_lake(spark, base, "eonet", SC.EVENT_RECORD)
        qk = FD.read_lake(spark, base, "usgs", SC.QUAKE_RECORD)
        t = PL.run(ev, qk)
        runs.append({n: sorted(map(tuple, df.drop(*[c for c in df.columns if c.startswith("_")]).collect()),
                               key=repr) for n, df in t.items()})
    assert runs[0] == runs[1]
