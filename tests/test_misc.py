import os

from pyspark.sql import functions as F

from tellus.operators import aggregates as A
from tellus.operators import validate as V
from tellus.streaming import lake as LK


def test_compact_keeps_every_line(spark, tmp_dir):
    lake = os.path.join(tmp_dir, "lake")
    rows = spark.range(0, 2000).select(
        F.col("id").cast("string").alias("value"),
        F.when(F.col("id") % 2 == 0, "eonet").otherwise("usgs").alias("source"),
        F.lit("2026").alias("year"), F.lit("09").alias("month"), F.lit("21").alias("day"),
        (F.col("id") % 3).cast("string").alias("hour"))
    rows.repartition(20).write.partitionBy(*LK.PARTS).text(lake)
    out = os.path.join(tmp_dir, "compact")
    LK.compact(spark, lake, out, files_per_partition=2)
    before = {(r.source, r.lines) for r in LK.volumes(spark, lake).collect()}
    after = LK.volumes(spark, out).collect()
    assert {(r.source, r.lines) for r in after} == before
    assert sum(r.objects for r in after) <= 2 * 3 * 2


def test_decimal_and_length_rules(spark):
    df = spark.createDataFrame([(12.345, "abc"), (123456.7, "abcdef"), (None, None)], "m double, t string")
    ok, bad = V.validate(df, [V.fits_decimal("m", 4, 2), V.max_length("t", 5)])
    assert ok.count() == 2
    assert [sorted(r.reasons) for r in bad.collect()] == [["decimal:m", "max_length:t"]]


def test_small_aggregates(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", None)], "k string, v double")
    assert A.count_rows(df).first().n == 3
    assert A.max_of(df, "v", "mx").first().mx == 3.0
    assert {(r.k, r.n) for r in A.count_by(df, ["k"]).collect()} == {("x", 2), ("y", 1)}
    c = {r.name: (r.total_rows, r.failing_rows) for r in
         A.conditional_counts(df, {"null_v": F.col("v").isNull(), "big": F.col("v") > 2}).collect()}
    assert c == {"null_v": (3, 1), "big": (3, 1)}


def test_sources_and_sinks_helpers(spark, tmp_dir):
    import json

    from tellus.sources import feeds as FD
    from tellus.sources import sinks as K
    from tellus.sources import tables as TB

    d = os.path.join(tmp_dir, "env")
    os.makedirs(d)
    for i in range(3):
        with open(os.path.join(d, f"page{i}.json"), "w") as f:
            json.dump({"events": [{"id": f"E{i}a"}, {"id": f"E{i}b"}]}, f, indent=2)
    env = FD.read_envelopes(spark, d)
    assert env.count() == 3
    assert FD.unnest_envelope(env, "events").count() == 6

    paths = K.write_tables({"event": TB.seed_tables(spark)["event"]}, tmp_dir + "/snap")
    assert set(paths) == {"event"}
    assert spark.read.parquet(paths["event"]).count() == 3
