"""What one task or one pass is given does not grow with the input."""

import glob
import os

from pyspark.sql import functions as F

from tellus import catalog_evidence as CE
from tellus.plans.upsert import sync
from tellus.sources.tables import seed_tables
from tellus.streaming import lake as LK
from tests.test_upsert import BAD_GEO, BAD_SRC, GOOD, UPDATED, _recs


def test_compacted_files_are_bounded_by_rows(spark, tmp_path):
    lake, packed = str(tmp_path / "lake"), str(tmp_path / "packed")
    hour = [F.lit(x).alias(c) for c, x in (("source", "eonet"), ("year", 2026), ("month", "01"), ("day", "01"), ("hour", "05"))]
    lines = spark.range(0, 300, 1, 10).select(F.format_string("%03d", "id").alias("value"), *hour)
    lines.write.partitionBy(*LK.PARTS).text(lake)
    LK.compact(spark, lake, packed, 1, rows_per_file=70)
    files = sorted(glob.glob(packed + "/**/part-*", recursive=True))
    rows = [open(f).read().split() for f in files]
    assert len(files) >= 4 and max(map(len, rows)) <= 90  # whole files of 30 lines are dealt
    assert [x for r in rows for x in r] == [f"{i:03d}" for i in range(300)]


def test_a_batch_gets_more_writers_where_it_is_large(spark, tmp_path):
    box, lake = str(tmp_path / "box"), str(tmp_path / "lake")
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else Spark joins the writers of so small a batch
    m = spark.range(0, 300, 1, 1).select(F.lit("eonet.events").alias("topic"), F.lit("k").alias("key"),
                                         F.format_string('{"id": "%03d"}', "id").alias("value"), F.col("id").alias("offset"))
    m.write.parquet(box)
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        s = spark.readStream.schema(m.schema).parquet(box)
        LK.ingest(s, lake, str(tmp_path / "ck"), available_now=True, order=["offset"], writers=1, rows_per_file=50).awaitTermination(120)
    finally:
        spark.conf.set(key, old)
    tasks = {os.path.basename(f).split("-")[1] for f in glob.glob(lake + "/**/part-*", recursive=True)}
    assert len(tasks) >= 5  # one writer cut its rows into files before
    assert spark.read.text(lake).count() == 300


def test_lake_rows_of_one_split_are_dealt_out_before_the_write(spark, tmp_path, monkeypatch):
    lake, d = str(tmp_path / "lake"), str(tmp_path / "d")
    spark.range(2000).selectExpr("id AS o_orderkey", "IF(id % 10 = 0, 'P', 'O') AS o_orderstatus").coalesce(1).write.parquet(d + "/orders.parquet")
    spark.range(2000).selectExpr("id AS l_orderkey", "1 AS l_linenumber").coalesce(1).write.parquet(d + "/lineitem.parquet")
    monkeypatch.setattr(CE, "scratch_path", lambda *_: lake)
    size = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k) for k in size}
    for k, v in size.items():
        spark.conf.set(k, v)
    try:
        got = {r.feed: (r.lines, r.broken, r.ids) for r in CE.s07_lake_scans(spark, d).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {"eonet": (2000, 200, 1800), "usgs": (2000, 0, 2000), "absent": (0, 0, 0)}
    assert len(glob.glob(lake + "/source=usgs/**/part-*", recursive=True)) > 1


def test_a_sync_parses_its_records_once(spark):
    recs = _recs(spark, [GOOD, BAD_GEO, BAD_SRC, UPDATED])
    plain, counts = sync(seed_tables(spark), recs)
    once, counts1 = sync(seed_tables(spark), recs, checkpoint=True)
    assert counts1.collect() == counts.collect()
    for n, df in plain.items():
        assert sorted(map(repr, once[n].collect())) == sorted(map(repr, df.collect()))
    plan = once["event_source"]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "from_json" not in plan and "jsontostructs" not in plan
