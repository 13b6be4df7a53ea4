from tellus.functions import predicates as P
from tellus.functions import scalars as S


def test_trim_keeps_tabs_and_blank(spark):
    df = spark.createDataFrame([("  a ",), ("\t",), ("   ",), (None,)], "t string")
    r = df.select(P.not_blank("t").alias("nb"), P.is_blank("t").alias("b")).collect()
    assert [x.nb for x in r] == [True, True, False, None]
    assert [x.b for x in r] == [False, False, True, True]


def test_add_https_rules(spark):
    df = spark.createDataFrame([("example.com/x",), ("ftp://z",), ("//b",), ("http://ok",),
                                ("https://ok",), (None,)], "u string")
    got = [r[0] for r in df.select(S.add_https("u")).collect()]
    assert got == ["https://example.com/x", "https://ftp://z", "//b", "http://ok", "https://ok", None]


def test_url_bad_null_is_not_failing(spark):
    df = spark.createDataFrame([("ftp://z",), (None,), ("https://a",)], "u string")
    assert [r[0] for r in df.select(P.url_bad("u")).collect()] == [True, False, False]


def test_band_label_and_day(spark):
    df = spark.createDataFrame([(4.5,), (-0.5,), (10.0,)], "m double")
    assert [r[0] for r in df.select(S.band_label("m")).collect()] == ["4 - 5", "-1 - 0", "10 - 11"]


def test_json_items_and_canonical(spark):
    df = spark.createDataFrame([("[-118.30, 34.10]",), ("[[1,2],[3,4]]",), ("garbage",),
                                ("[1]",), ('{"a":1}',)], "c string")
    r = df.select(S.json_array_item("c", 0).alias("x"), S.json_array_item("c", 1).alias("y"),
                  S.canonical_json("c").alias("k")).collect()
    assert (r[0].x, r[0].y) == (-118.3, 34.1)
    assert r[1].x is None and r[2].x is None
    assert r[3].x == 1.0 and r[3].y is None
    assert r[0].k == "[-118.3,34.1]"
    assert r[2].k is None


def test_parse_ts_never_throws(spark):
    df = spark.createDataFrame([("2026-09-18T18:00:00Z",), ("not a date",), (None,)], "d string")
    r = [x[0] for x in df.select(S.parse_ts("d")).collect()]
    assert r[0] is not None and r[1] is None and r[2] is None


def test_haversine_known_distance(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (89.9, 0.0, 89.9, 180.0)],
                               "a double, b double, c double, d double")
    r = [x[0] for x in df.select(S.haversine_km("a", "b", "c", "d")).collect()]
    assert abs(r[0] - 111.19) < 0.01
    assert abs(r[1] - 22.24) < 0.01


def test_fail_rate(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (2, 2)], "f long, t long")
    assert [r[0] for r in df.select(S.fail_rate("f", "t")).collect()] == [0.0, 0.3333, 1.0]
