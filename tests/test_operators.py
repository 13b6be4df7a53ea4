from pyspark.sql import functions as F

from tellus.operators import merge as MG
from tellus.operators import referential as RF
from tellus.operators import validate as V
from tellus.sources.tables import SEED, seed_load, seed_tables


def test_merge_update_ignore_idempotent(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    s = spark.createDataFrame([("b", 20), ("c", 30), ("c", 31)], "id string, v int")
    up = MG.merge(t, s, ["id"], on_match="update", order_by=["v"])
    assert sorted(map(tuple, up.collect())) == [("a", 1), ("b", 20), ("c", 31)]
    ig = MG.merge(t, s, ["id"], on_match="ignore", order_by=["v"])
    assert sorted(map(tuple, ig.collect())) == [("a", 1), ("b", 2), ("c", 30)]
    assert sorted(map(tuple, MG.merge(up, s, ["id"], order_by=["v"]).collect())) == sorted(map(tuple, up.collect()))


def test_seed_load_idempotent(spark):
    once = seed_load(spark, seed_tables(spark))
    twice = seed_load(spark, once)
    for n in SEED:
        assert once[n].count() == len(SEED[n]) == twice[n].count()


def test_validate_rules_pk_fk(spark):
    parent = spark.createDataFrame([("E1",), ("E2",)], "id string")
    df = spark.createDataFrame([
        ("E1", "Point", "[-118.3, 34.1]", "https://a", 1),
        ("E1", "Point", "[-118.3, 34.1]", "https://a", 2),
        ("E2", "Point", "[1, 2, 3]", "https://b", 3),
        ("E3", "Polygon", "[[[0,0]]]", "ftp://c", 4),
        ("E2", "Point", "[181, 0]", "https://d", 5),
        (None, "LineString", None, None, 6),
    ], "event_id string, type string, coordinates string, url string, pos int")
    rules = [*V.not_null("event_id", "coordinates"), V.one_of("type", ["Point", "Polygon"]),
             V.point_geometry(), V.url("url")]
    ok, bad = V.validate(df, rules, key=["event_id", "coordinates"], key_order=["pos"],
                         parents=[("event", parent, "event_id", "id")])
    assert sorted(r.pos for r in ok.collect()) == [2]
    reasons = {r.pos: sorted(r.reasons) for r in bad.collect()}
    assert reasons[1] == ["duplicate_key"]
    assert reasons[3] == ["geometry_shape"]
    assert reasons[4] == ["missing_parent:event", "url:url"]
    assert reasons[5] == ["geometry_shape"]
    assert reasons[6] == ["not_null:coordinates", "not_null:event_id", "one_of:type"]
    counts = V.load_counts(ok, bad).first()
    assert (counts.processed, counts.failed) == (1, 5)


def test_referential(spark):
    ev = spark.createDataFrame([("E1",), ("E2",)], "id string")
    cat = spark.createDataFrame([("c1",)], "id string")
    link = spark.createDataFrame([("E1", "c1"), ("E3", "c1"), ("E1", "c9"), (None, "c1")],
                                 "event_id string, category_id string")
    assert RF.orphans(link, ev, "event_id", "id").count() == 2
    kept = RF.with_all_parents(link, [(ev, "event_id", "id"), (cat, "category_id", "id")])
    assert [tuple(r) for r in kept.collect()] == [("E1", "c1")]
    assert [r.id for r in RF.restrict(ev, link, "id", "event_id").collect()] == ["E2"]
    g = spark.createDataFrame([("E1", "2026-09-15T00:00:00Z"), ("E1", "bad")], "event_id string, date string")
    e = spark.createDataFrame([("E1", "2026-09-10 00:00:00"), ("E2", "2026-09-10 00:00:00")],
                              "id string, closed string").withColumn("closed", F.col("closed").cast("timestamp"))
    bad = RF.before_first_child(e, g, parent_key="id", parent_ts="closed", child_key="event_id", child_ts="date")
    assert [r.id for r in bad.collect()] == ["E1"]
