"""The merge by file: equal to the merge of whole tables, and only touched
buckets are rewritten."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tellus.operators.merge import merge
from tellus.sources import sinks as K

SCHEMA = "k string, n long, v string"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _target(spark, n=400):
    rows = [(f"k{i}", i, "old") for i in range(n)] + [(None, -1, "old")]
    return spark.createDataFrame(rows, SCHEMA)


def _changed(old, new):
    return {b for b in old.folders.keys() | new.folders.keys() if old.folders.get(b) != new.folders.get(b)}


@pytest.mark.parametrize("how", ["update", "ignore"])
def test_equals_the_merge_of_whole_tables(spark, tmp_dir, how):
    t = _target(spark)
    # held, new and null keys, several versions of one, identical rows
    d = spark.createDataFrame([("k7", 1, "a"), ("k7", 2, "b"), ("new", 5, "c"), ("new", 5, "c"), (None, 3, "d")], SCHEMA)
    v1 = K.publish_tables({"t": K.Change(t, ["k"], buckets=64), "other": t}, tmp_dir)
    v2 = K.merge_table(spark, tmp_dir, "t", d, ["k"], on_match=how, order_by=["n"], load="2")
    expect = _rows(merge(t, d, ["k"], on_match=how, order_by=["n"]))
    assert _rows(v2.read("t")) == expect == _rows(K.pin(spark, tmp_dir).read("t"))
    assert len(_changed(v1.buckets["t"], v2.buckets["t"])) <= (3 if how == "update" else 1)
    # the version before, and the table beside it, are as they were
    assert _rows(K.pin(spark, tmp_dir, 1).read("t")) == _rows(t) == _rows(v2.read("other"))
    again = K.merge_table(spark, tmp_dir, "t", d, ["k"], on_match=how, order_by=["n"])
    assert _rows(again.read("t")) == expect and again.load == "2"
    if how == "ignore":
        assert again.buckets["t"].folders == v2.buckets["t"].folders


def test_keys_of_another_type_find_their_bucket(spark, tmp_dir):
    K.publish_tables({"t": K.Change(spark.range(100).select("id", F.lit("old").alias("v")), ["id"], buckets=16)}, tmp_dir)
    d = spark.createDataFrame([(5, "new")], "id int, v string").select("v", "id")
    rows = dict(map(tuple, K.merge_table(spark, tmp_dir, "t", d, ["id"]).read("t").collect()))
    assert len(rows) == 100 and [k for k, x in rows.items() if x == "new"] == [5]


def test_changes_without_unique_keys_and_retraction(spark, tmp_dir):
    rows = spark.range(300).select((F.col("id") % 30).alias("id"), F.col("id").alias("x"))
    v1 = K.publish_tables({"t": K.Change(rows, ["id"], buckets=8)}, tmp_dir)
    gone = spark.createDataFrame([(3,), (4,), (999,)], "id long")
    new = spark.createDataFrame([(3, -1), (3, -2), (77, -3)], "id long, x long")
    v2 = K.publish_tables({"t": K.Change(new, ["id"], gone)}, tmp_dir)
    assert _rows(v2.read("t")) == _rows(rows.filter("id NOT IN (3, 4)").unionByName(new))
    everything = rows.select("id").unionByName(new.select("id"))
    v3 = K.publish_tables({"t": K.Change(new.limit(0), ["id"], everything)}, tmp_dir)
    assert v3.buckets["t"].folders == {} and v3.read("t").columns == ["id", "x"] and v3.read("t").count() == 0
    assert _rows(K.publish_tables({"t": K.Change(new, ["id"])}, tmp_dir).read("t")) == _rows(new)
    assert _rows(v1.read("t")) == _rows(rows)
    with pytest.raises(ValueError):
        K.publish_tables({"t": K.Change(new, ["x"])}, tmp_dir)


def test_empty_deltas_empty_tables_and_a_clashing_column(spark, tmp_dir):
    t = spark.createDataFrame([(1, 9), (2, 8)], "id int, _bucket int")
    v0 = K.publish_tables({"t": K.Change(t.limit(0), ["id"])}, tmp_dir)
    assert v0.read("t").count() == 0
    v1 = K.merge_table(spark, tmp_dir, "t", t, ["id"])
    assert _rows(v1.read("t")) == [(1, 9), (2, 8)]
    v2 = K.merge_table(spark, tmp_dir, "t", t.limit(0), ["id"])
    assert v2.buckets["t"].folders == v1.buckets["t"].folders and v2.version == 3


def test_a_table_of_one_folder_is_dealt_out_once(spark, tmp_dir):
    t = _target(spark, 50)
    K.publish_tables({"t": t}, tmp_dir)
    d = spark.createDataFrame([("k1", 0, "x"), ("z", 1, "y")], SCHEMA)
    v = K.merge_table(spark, tmp_dir, "t", d, ["k"], buckets=8)
    assert "t" not in v.paths and _rows(v.read("t")) == _rows(merge(t, d, ["k"]))
    v = K.publish_tables({"t": t}, tmp_dir)  # and written whole again
    assert "t" not in v.buckets and _rows(K.pin(spark, tmp_dir).read("t")) == _rows(t)


def test_a_failed_change_leaves_the_version_before(spark, tmp_dir):
    t = _target(spark, 50)
    K.publish_tables({"t": K.Change(t, ["k"], buckets=8)}, tmp_dir)
    d = t.limit(3).withColumn("v", F.when(F.col("n") >= 0, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        K.merge_table(spark, tmp_dir, "t", d, ["k"])
    assert K.pin(spark, tmp_dir).version == 1 and _rows(K.pin(spark, tmp_dir).read("t")) == _rows(t)
