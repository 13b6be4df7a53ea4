import datetime as dt

from pyspark.sql import functions as F

from tellus.operators import dedup as D

T1, T2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


def test_latest_desc_nulls_first(spark):
    df = spark.createDataFrame([("a", T1, 1), ("a", T2, 2), ("a", None, 3), ("b", T1, 4),
                                ("b", T2, 5), (None, T1, 6), (None, T2, 7)],
                               "id string, ts timestamp, n int")
    got = {r.id: r.n for r in D.latest(df, ["id"], ["ts", "n"]).collect()}
    # NULL ordering value ranks first (PostgreSQL DESC); NULL keys form one group
    assert got == {"a": 3, "b": 5, None: 7}


def test_earliest(spark):
    df = spark.createDataFrame([("a", 3.0, 1), ("a", 1.0, 2), ("a", None, 3)], "id string, d double, n int")
    assert D.earliest(df, ["id"], ["d"]).first().n == 2


def test_dedup_keys_null_keys_kept(spark):
    df = spark.createDataFrame([("e1", "c1", 1), ("e1", "c1", 2), ("e1", None, 3), ("e1", None, 4),
                                (None, "c1", 5), (None, "c1", 6)], "e string, c string, pos int")
    got = sorted(r.pos for r in D.dedup_keys(df, ["e", "c"], order_by=["pos"]).collect())
    assert got == [2, 3, 4, 5, 6]


def test_dedup_keys_null_safe_column(spark):
    df = spark.createDataFrame([("e1", None, "[1,2]", 1), ("e1", None, "[1,2]", 2),
                                ("e1", "d", None, 3), ("e1", "d", None, 4)],
                               "e string, d string, c string, pos int")
    got = sorted(r.pos for r in D.dedup_keys(df, ["e", "d", "c"], order_by=["pos"],
                                             null_safe=["d"]).collect())
    assert got == [2, 3, 4]


def test_losers_complement(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    win = D.latest(df, ["k"], ["o"])
    los = D.losers(df, ["k"], ["o"])
    assert win.count() == 7 and los.count() == 993
    assert win.join(los, ["k", "o"]).count() == 0


def test_latest_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(0, 10000).select((F.col("id") % 1).alias("k"), F.col("id").alias("o"), F.lit("x").alias("unused"))
    out = D.latest(df, ["k"], ["o"], total=True).select("k", "o")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert out.first().o == 9999


def test_latest_reads_only_the_needed_columns(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = D.latest(d, ["event_id"], ["ts", "user_id"], total=True).groupBy("ts").count()
    schema = [x for x in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]][0].split(">")[0]
    assert "props" not in schema and "value" not in schema


def test_split_latest_loses_no_row(spark):
    rows = [("a", 1, None), ("a", 1, None), ("a", 1, "x"), ("a", None, "y"), (None, 1, "z"), (None, 1, "z"), ("b", 2, "w")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    for order in (["o"], [], ["o", "v"], [F.col("o")]):
        win, lose = D.split_latest(df, ["k"], order)
        key = lambda r: tuple(map(str, r))
        assert sorted([*map(key, win.collect()), *map(key, lose.collect())]) == sorted(map(key, rows))
        assert sorted(str(r.k) for r in win.collect()) == ["None", "a", "b"]
