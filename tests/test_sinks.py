from tellus.sources import sinks as K


def test_snapshot_pointer_swap(spark, tmp_dir):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(3,)], "x int")
    p1 = K.write_snapshot(a, tmp_dir, "t")
    assert sorted(r.x for r in K.read_snapshot(spark, tmp_dir, "t").collect()) == [1, 2]
    p2 = K.write_snapshot(b, tmp_dir, "t")
    assert p1 != p2
    assert [r.x for r in K.read_snapshot(spark, tmp_dir, "t").collect()] == [3]
    # the previous snapshot stays readable until cleaned up
    assert spark.read.parquet(p1).count() == 2


def test_append_report_and_materialize(spark, tmp_dir):
    r = spark.createDataFrame([("r1", "C01", 1), ("r2", "C01", 2)], "run_id string, control_id string, failing_rows int")
    K.append_report(r, tmp_dir + "/report")
    K.append_report(r.filter("run_id = 'r2'"), tmp_dir + "/report")
    assert spark.read.parquet(tmp_dir + "/report").count() == 3
    m = K.materialize(spark, r, "m")
    assert m.count() == 2 and "InMemoryRelation" not in m._jdf.queryExecution().toString()
