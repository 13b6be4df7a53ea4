"""Order of arrival, quarantine on the stream, versions, incremental loads
and the streaming match of one row per pair."""

import datetime as dt
import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellus import schemas as SC
from tellus.jobs import main
from tellus.operators.match import match_pairs
from tellus.plans import clean_load as PL
from tellus.plans import incremental as INC
from tellus.sources import feeds as FD
from tellus.sources import sinks as K
from tellus.streaming import lake as LK
from tellus.streaming.match import stream_best

def _hour():
    return F.lit("2026-09-21 10:30:00").cast("timestamp")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _messages(spark, d, n, start=0):
    """Messages in an order that their names and values don't show."""
    rows = spark.range(start, start + n).select(
        F.when(F.col("id") % 3 == 0, "usgs.earthquakes").otherwise("eonet.events").alias("topic"), (F.col("id") % 5).cast("string").alias("key"),
        F.concat(F.lit('{"id": "'), F.sha1(F.col("id").cast("string")), F.lit('"}')).alias("value"), F.col("id").alias("offset"))
    rows.repartition(6).write.mode("append").parquet(d)
    return spark.readStream.schema("topic string, key string, value string, offset long").parquet(d)


def _in_order(spark, lake, source, expect):
    lines = FD.lake_lines(spark, lake, source=source).orderBy("_seq")
    import hashlib
    assert [r.value for r in lines.collect()] == ['{"id": "' + hashlib.sha1(str(i).encode()).hexdigest() + '"}' for i in expect]


def test_lake_keeps_the_order_of_arrival(spark, tmp_dir):
    lake, ck, inbox, packed = (f"{tmp_dir}/{x}" for x in ("lake", "ck", "in", "packed"))
    for start, writers in ((1000, 4), (0, None)):  # the later run has the lower numbers
        s = _messages(spark, inbox, 1000, start)
        LK.ingest(s, lake, ck, available_now=True, flush_time=_hour(), order=["offset"], writers=writers or 1, rows_per_file=70).awaitTermination(120)
    sent = [*range(1000, 2000), *range(1000)]
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "2k"):  # files are read whole, or in several blocks
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            _in_order(spark, lake, "usgs", [i for i in sent if i % 3 == 0])
            _in_order(spark, lake, "eonet", [i for i in sent if i % 3])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert len(glob.glob(f"{lake}/source=eonet/*/*/*/*/batch=*/part-*")) > 20
    for files in (1, 3):
        LK.compact(spark, lake, packed + str(files), files)
        _in_order(spark, packed + str(files), "eonet", [i for i in sent if i % 3])
        assert len(glob.glob(f"{packed}{files}/source=eonet/*/*/*/*/batch=-1/part-*")) <= files
    # what lands in a compacted hour later comes after it
    s = _messages(spark, f"{inbox}2", 50, 5000)
    LK.ingest(s, packed + "3", ck + "2", available_now=True, flush_time=_hour(), order=["offset"]).awaitTermination(120)
    _in_order(spark, packed + "3", "usgs", [i for i in sent + list(range(5000, 5050)) if i % 3 == 0])


def test_other_writers_files_are_ordered_by_name_and_line(spark, tmp_dir):
    d = f"{tmp_dir}/lake/source=eonet/year=2026/month=09/day=21/hour=07"
    os.makedirs(d)
    for name, titles in (("events-20260921T071000.jsonl", ["c", "d"]), ("events-20260921T070500.jsonl", ["a", "b"])):
        with open(f"{d}/{name}", "w") as f:
            f.writelines(json.dumps({"id": "e1", "title": t, "link": "https://x/y"}) + "\n" for t in titles)
    feed = FD.read_lake(spark, f"{tmp_dir}/lake", "eonet", SC.EVENT_RECORD)
    assert [r.title for r in feed.orderBy("_seq").collect()] == ["a", "b", "c", "d"]
    assert [r.title for r in PL.run(feed, None)["event"].collect()] == ["d"]
    LK.compact(spark, f"{tmp_dir}/lake", f"{tmp_dir}/packed")
    assert [r.title for r in PL.run(FD.read_lake(spark, f"{tmp_dir}/packed", "eonet", SC.EVENT_RECORD), None)["event"].collect()] == ["d"]
    with pytest.raises(FileNotFoundError):
        LK.compact(spark, f"{tmp_dir}/nowhere", f"{tmp_dir}/p2")


def test_a_batch_tried_again_replaces_its_own_files(spark, tmp_dir):
    """The commit of the last batch is lost, as after a crash behind the writes."""
    lake, ck, inbox, bad = (f"{tmp_dir}/{x}" for x in ("lake", "ck", "in", "bad"))
    os.makedirs(inbox)
    with open(f"{inbox}/a.json", "w") as f:
        for i, v in enumerate(['{"id": 1}', "{broken", None, '{"a":\n 2}', "[1]", '"text"', " {\"b\": 3}"]):
            f.write(json.dumps({"topic": "t", "key": str(i), "value": v}) + "\n")

    def run():
        LK.ingest(LK.file_stream(spark, inbox), lake, ck, available_now=True, routes={}, quarantine=bad).awaitTermination(120)
        lines = sorted(r.value for r in FD.lake_lines(spark, lake).collect())
        return lines, sorted((r.key, r.value) for r in spark.read.parquet(bad).collect())
    first = run()
    assert first == ([' {"b": 3}', '{"a":  2}', '{"id": 1}'], [("1", "{broken"), ("2", None), ("4", "[1]"), ("5", '"text"')])
    os.remove(f"{ck}/commits/0")
    for crc in glob.glob(f"{ck}/commits/.0*"):
        os.remove(crc)
    assert run() == first
    assert len(glob.glob(f"{lake}/source=t/*/*/*/*/batch=*")) == 1


def test_versions_change_all_tables_at_once(spark, tmp_dir):
    def rows(*x):
        return spark.createDataFrame([(i,) for i in x], "x int")

    def seen(v):
        return {n: sorted(r.x for r in v.read(n).collect()) for n in v.paths}
    assert K.pin(spark, tmp_dir).version == 0 and "a" not in K.pin(spark, tmp_dir)
    K.publish_tables({"a": rows(1), "p/b": rows(1, 2)}, tmp_dir, load="7")
    old = K.pin(spark, tmp_dir)
    K.publish_tables({"a": rows(3)}, tmp_dir)
    new = K.pin(spark, tmp_dir)
    assert (old.version, new.version, new.load) == (1, 2, "7")
    assert seen(old) == {"a": [1], "p/b": [1, 2]} and seen(new) == {"a": [3], "p/b": [1, 2]}
    broken = rows(5).select(F.when(F.col("x") > 0, F.raise_error(F.lit("stop"))).otherwise(F.col("x")).alias("x"))
    with pytest.raises(PySparkException):
        K.publish_tables({"a": rows(9), "p/b": broken}, tmp_dir)
    assert seen(K.pin(spark, tmp_dir)) == seen(new) and seen(K.pin(spark, tmp_dir, 1)) == seen(old)
    assert sorted(r.x for r in K.read_snapshot(spark, f"{tmp_dir}/p", "b").collect()) == [1, 2]
    with pytest.raises(FileNotFoundError):
        K.read_snapshot(spark, tmp_dir, "c")


# --------------------------------------------------------- incremental load

def _event(i, title="t", lon=10.0, cats=("c1",), srcs=("s1",), date="2026-09-20T00:00:00Z", link="https://x/y"):
    return {"id": i, "title": title, "link": link, "categories": [{"id": c, "title": f"{c} {title}"} for c in cats],
            "sources": [{"id": s, "url": f"https://{s}/{title.strip()}"} for s in srcs],
            "geometry": [{"date": date, "type": "Point", "coordinates": [lon, 0.0]}, {"date": date, "type": "Point", "coordinates": [lon + 1, 0.0]}]}


def _quake(i, lon=10.0, mag=5.0, ms=1789862400000):
    return {"id": i, "properties": {"mag": mag, "time": ms, "tsunami": 0, "place": "p"}, "geometry": {"type": "Point", "coordinates": [lon, 0.5, 10.0]}}


def _land(lake, batch, source, records):
    d = f"{lake}/source={source}/year=2026/month=09/day=21/hour=10/batch={batch}"
    os.makedirs(d)
    with open(f"{d}/part-00000-x.c000.txt", "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)


LOADS = [
    {"eonet": [_event("e1"), _event("e2", lon=12.0, cats=("c2",)), _event("e3", lon=100.0), _event("e1", title="again"), "{broken", _event(None), _event("e9", title=" ")],
     "usgs": [_quake("q1"), _quake("q2", lon=100.2), _quake("q3", mag=50.0)]},
    # e1 moves away from its quake, e2 loses its category, a dimension gets a title that is too long, q2 moves, q4 is new
    {"eonet": [_event("e1", lon=50.0), _event("e2", lon=12.0, cats=("c3",), srcs=("s2",)), _event("e4", cats=("c1",), title="x" * 150), _event("e5", lon=50.5)],
     "usgs": [_quake("q2", lon=11.0), _quake("q4", lon=50.1), "[]"]},
    {"usgs": [_quake("q1", lon=-60.0), _quake("q5", lon=100.0)]},
    # a record that no longer passes the gates leaves the one before it in place
    {"eonet": [_event("e3", title="  "), _event("e5", link="ftp://x"), _event("e6", lon=-60.0), _event("e6" * 30)]},
]


def _sorted_rows(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def test_increments_equal_a_full_rebuild(spark, tmp_dir):
    lake, tables, ledger = f"{tmp_dir}/lake", f"{tmp_dir}/tables", f"{tmp_dir}/ledger"
    for n, load in enumerate(LOADS):
        for source, records in load.items():
            _land(lake, n, source, records)
        main(["load", "--lake", lake, "--tables", tables, "--ledger", ledger], spark)
        v = K.pin(spark, tables)
        assert v.version == n + 1
        if n == 1:  # the batch is published, but its commit is lost: nothing is applied twice
            for f in glob.glob(f"{ledger}/commits/*1") + glob.glob(f"{ledger}/commits/.1*"):
                os.remove(f)
            assert INC.load(spark, lake, tables, ledger).version == v.version
        if n in (1, 3):
            ev, qk = (FD.read_lake(spark, lake, s, schema) for s, schema in (("eonet", SC.EVENT_RECORD), ("usgs", SC.QUAKE_RECORD)))
            full = PL.run(ev, qk)
            for name in SC.TABLES:
                assert _sorted_rows(v.read(f"public/{name}")) == _sorted_rows(full[name]), name
            # as many rejected rows by table as the full load has for the latest records
            assert {r.line for r in v.read("quarantine/line").collect()} == ({"{broken", "[]"})
    pairs = {(r.event_id, r.earthquake_id) for r in v.read("public/event_earthquake").collect()}
    assert {("e1", "q4"), ("e2", "q2"), ("e3", "q5"), ("e6", "q1")} <= pairs and ("e1", "q1") not in pairs
    assert INC.load(spark, lake, tables, ledger).version == 4  # nothing new, no new version


# ------------------------------------------------- one row per pair, streaming

def test_stream_best_holds_a_pair_until_no_point_can_change_it(spark, tmp_dir):
    base = dt.datetime(2026, 9, 1)
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.TimestampType()),
                           T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
    end = base + dt.timedelta(days=400)

    def rows(*r):
        return [(i, base + dt.timedelta(hours=h), lon, 0.0) for i, h, lon in r]
    lefts = [rows(("a", 0, 0.5), ("a", 1, 0.3), ("b", 0, 10.0)), rows(("a", 5, 0.1), ("b", 30, 10.2)),
             rows(("a", 2, 0.1), ("b", 1, 10.1)),  # late, but within the delay
             [("-", end, 0.0, 90.0)], [], rows(("a", 3, 0.0))]  # too late: the pair is out
    rights = [rows(("q", 3, 0.0)), rows(("r", 20, 10.0), ("q", 3, 0.0)), [], [("-", end, 0.0, -90.0)], [], []]

    def stream(name, batches):
        d = f"{tmp_dir}/{name}"
        for n, b in enumerate(batches):
            os.makedirs(f"{d}/n={n}")
            with open(f"{d}/n={n}/p.json", "w") as f:
                f.writelines(json.dumps({"id": i, "ts": t.isoformat(), "lon": x, "lat": y}) + "\n" for i, t, x, y in b)
            t0 = 1_700_000_000 + n
            os.utime(f"{d}/n={n}/p.json", (t0, t0))
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{d}/n=*")
    out = f"{tmp_dir}/out"
    m = stream_best(stream("l", lefts), stream("r", rights), max_km=200.0, max_hours=48.0, delay="10 days")
    m.writeStream.format("parquet").option("checkpointLocation", out + "-ck").trigger(availableNow=True).start(out).awaitTermination(300)
    got = sorted((r.l_id, r.r_id, round(r.distance_km, 6), r.delay_seconds) for r in spark.read.parquet(out).collect())
    left = spark.createDataFrame([r for b in lefts[:3] for r in b], schema)
    right = spark.createDataFrame(rights[0] + rights[1][:1], schema)
    expect = match_pairs(left, right, max_km=200.0, max_hours=48.0, round_output=False)
    assert got == sorted((r.event_id, r.earthquake_id, round(r.distance_km, 6), r.delay_seconds) for r in expect.collect())
    assert len(got) == 2 and got[0][3] == 3600


# ------------------------------------------------------------ optional parts

@pytest.mark.parametrize("module", ["tiktoken", "public_tokenizers", "corpus_pipeline", "tellus.llm"])
def test_the_engine_is_registered_without_optional_modules(module):
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql(); " \
           "assert 'q07_daily_counts' in q and 'q07_daily_counts' in o and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
