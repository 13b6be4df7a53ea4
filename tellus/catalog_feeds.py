"""Feed-side queries over the driver tables: nested JSON records are built
from ``orders`` (hazard events) and ``lineitem`` (quakes), wrapped in feed
envelopes, and go through the same unnest -> parse -> stage -> clean ->
match path as the lake (S1, S2, P1-P11, F1-F8, D1-D3, K4, K5, J3).

The oracle SQL states the same results directly from the source columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellus import schemas as SC
from tellus.catalog import register, table
from tellus.operators.partitioning import spread
from tellus.plans import clean_load as PL
from tellus.plans import upsert as UP
from tellus.sources.tables import seed_tables
from tellus.sources import feeds as FD

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _e(sql):
    return F.expr(sql)


def event_envelopes(spark: SparkSession, d: str, partitions: int | None = None) -> DataFrame:
    """One ``{"events": [record]}`` envelope per order. ``partitions`` spreads
    the orders before they are made into text (see ``spread``)."""
    o = spread(table(spark, d, "orders"), partitions)
    rec = F.struct(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id"),
        _e("CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL "
           "ELSE concat(' ', o_orderpriority, ' ') END").alias("title"),
        F.col("o_orderstatus").alias("description"),
        _e("CASE WHEN o_orderpriority = '2-HIGH' THEN concat('example.org/o/', o_orderkey) "
           "ELSE concat('https://example.org/o/', o_orderkey) END").alias("link"),
        _e(f"CASE WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, \"{_ISO}\") END").alias("closed"),
        F.array(F.struct(F.col("o_orderpriority").alias("id"),
                         F.col("o_orderpriority").alias("title"))).alias("categories"),
        F.array(F.struct(F.col("o_orderstatus").alias("id"),
                         _e("CASE WHEN o_orderstatus = 'P' THEN 'ftp://src/P' "
                            "ELSE concat('https://src.example/', o_orderstatus) END").alias("url")))
         .alias("sources"),
        F.array(F.struct(F.date_format("o_orderdate", _ISO).alias("date"),
                         _e("CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Polygon' ELSE 'Point' END").alias("type"),
                         _e("CASE WHEN o_orderpriority = '3-MEDIUM' THEN '[[[0, 0], [1, 0], [0, 0]]]' "
                            "ELSE concat('[', o_custkey * 7 % 360 - 180, ', ', o_custkey * 13 % 180 - 90, ']') END")
                         .alias("coordinates"))).alias("geometry"))
    return o.select(F.to_json(F.struct(F.array(rec).alias("events"))).alias("value"),
                    F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
                    F.lit("orders").alias("_seq"))


def quake_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """One ``{"features": [record]}`` envelope per line item."""
    li = table(spark, d, "lineitem")
    rec = F.struct(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.struct((F.col("l_quantity") / 5.0).alias("mag"), F.col("l_returnflag").alias("magType"),
                 F.col("l_linestatus").alias("place"),
                 F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("time"),
                 _e("CASE WHEN l_discount > 0.08 THEN 1 ELSE 0 END").alias("tsunami"),
                 F.col("l_partkey").cast("int").alias("sig"),
                 _e("CASE WHEN l_tax > 0.07 THEN 'nope' ELSE concat('https://q.example/', l_orderkey) END")
                 .alias("url")).alias("properties"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(_e("CASE WHEN l_quantity = 50 THEN 181.0 ELSE CAST(l_partkey * 7 % 360 - 180 AS DOUBLE) END"),
                         _e("CAST(l_partkey * 13 % 180 - 90 AS DOUBLE)"),
                         (F.col("l_tax") * 100).alias("d")).alias("coordinates")).alias("geometry"))
    tie = F.concat(F.lpad(F.col("l_partkey").cast("string"), 12, "0"), F.lit("-"),
                   F.lpad(F.col("l_suppkey").cast("string"), 12, "0"))
    return li.select(F.to_json(F.struct(F.array(rec).alias("features"))).alias("value"),
                     F.col("l_shipdate").cast("timestamp").alias("_ingested_at"), tie.alias("_seq"))


def _records(env: DataFrame, field: str, schema) -> DataFrame:
    """S1/S2 unnest, then parse with the fixed schema; ordering metadata kept."""
    arr = F.from_json(F.col("value"), f"struct<{field}: array<string>>")
    recs = env.select(F.explode(arr[field]).alias("_raw"), "_ingested_at", "_seq")
    return FD.parse_records(recs, schema, partitions=int(env.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def loaded(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    ev = _records(event_envelopes(spark, d), "events", SC.EVENT_RECORD)
    qk = _records(quake_envelopes(spark, d), "features", SC.QUAKE_RECORD)
    return PL.run(ev, qk, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


_EV_SQL = """
ev AS (
  SELECT 'O' || o_orderkey AS id, trim(' ' || o_orderpriority || ' ', ' ') AS title,
         o_orderstatus AS description, 'https://example.org/o/' || o_orderkey AS link,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed,
         o_orderpriority, o_orderstatus, o_orderdate, o_custkey
  FROM orders
  WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') AND o_orderpriority <> '2-HIGH')"""

_Q_SQL = """
q0 AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, l_shipdate AS time, l_quantity / 5.0 AS magnitude,
         l_returnflag AS mag_type, l_linestatus AS place,
         CASE WHEN l_quantity = 50 THEN 181.0 ELSE CAST(l_partkey * 7 % 360 - 180 AS DOUBLE) END AS longitude,
         CAST(l_partkey * 13 % 180 - 90 AS DOUBLE) AS latitude, l_tax * 100 AS depth_km,
         l_discount > 0.08 AS tsunami, CAST(l_partkey AS INTEGER) AS significance,
         CASE WHEN l_tax > 0.07 THEN NULL ELSE 'https://q.example/' || l_orderkey END AS url,
         l_shipdate AS _ingested_at, lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '-' ||
         lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS _file
  FROM lineitem),
q AS (SELECT * FROM q0 WHERE longitude BETWEEN -180 AND 180 AND latitude BETWEEN -90 AND 90
        AND (magnitude IS NULL OR magnitude BETWEEN -1 AND 10)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY _ingested_at DESC, _file DESC) = 1)"""


@register("s01_envelope_unnest", """
SELECT 'O' || o_orderkey AS key, o_orderpriority AS category_id, o_orderstatus AS source_id
FROM orders""")
def s01_envelope_unnest(spark, d):
    """Envelope -> (key, raw record text); the record is then read back
    with the fixed schema (P1 struct fields, P2 unnest)."""
    kv = FD.unnest_envelope(event_envelopes(spark, d), "events")
    rec = kv.select("key", F.from_json("value", SC.EVENT_RECORD).alias("r"))
    return rec.select("key", F.col("r.categories")[0]["id"].alias("category_id"),
                      F.col("r.sources")[0]["id"].alias("source_id"))


@register("s02_feature_unnest", """
SELECT l_orderkey || '-' || l_linenumber AS key, l_quantity / 5.0 AS mag,
       CASE WHEN l_quantity = 50 THEN 181.0 ELSE CAST(l_partkey * 7 % 360 - 180 AS DOUBLE) END AS lon,
       l_tax * 100 AS depth
FROM lineitem""")
def s02_feature_unnest(spark, d):
    """S2 + P6: quake features unnested, guarded array elements."""
    kv = FD.unnest_envelope(quake_envelopes(spark, d), "features", require_key=True)
    r = kv.select("key", F.from_json("value", SC.QUAKE_RECORD).alias("r"))
    c = F.col("r.geometry.coordinates")
    return r.select("key", F.col("r.properties.mag").alias("mag"), F.get(c, F.lit(0)).alias("lon"),
                    F.get(c, F.lit(2)).alias("depth"))


@register("k04_staging_counts", """
SELECT 'event' AS table_name, COUNT(*) AS row_count FROM orders
UNION ALL SELECT 'category', COUNT(*) FROM orders
UNION ALL SELECT 'source', COUNT(*) FROM orders
UNION ALL SELECT 'geometry', COUNT(*) FROM orders
UNION ALL SELECT 'event_category', COUNT(*) FROM orders
UNION ALL SELECT 'event_source', COUNT(*) FROM orders
UNION ALL SELECT 'earthquake', COUNT(*) FROM lineitem""")
def k04_staging_counts(spark, d):
    """K4: raw staging tables hold every record, before any filter."""
    t = loaded(spark, d)
    out = None
    for n in ("event", "category", "source", "geometry", "event_category", "event_source", "earthquake"):
        one = t[f"staging.{n}"].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


@register("k05_clean_event", "WITH " + _EV_SQL + """
SELECT id, title, description, link, closed FROM ev""")
def k05_clean_event(spark, d):
    """K5 event: required fields, trimmed non-blank title, web link,
    parsed closing time, one row per id."""
    return loaded(spark, d)["event"]


@register("k05_clean_dimensions", "WITH " + _EV_SQL + """
SELECT DISTINCT 'category' AS kind, o_orderpriority AS id, o_orderpriority AS title FROM ev
UNION ALL
SELECT DISTINCT 'source', o_orderstatus, 'https://src.example/' || o_orderstatus FROM ev
WHERE o_orderstatus <> 'P'""")
def k05_clean_dimensions(spark, d):
    t = loaded(spark, d)
    return (t["category"].select(F.lit("category").alias("kind"), "id", "title")
            .unionByName(t["source"].select(F.lit("source").alias("kind"), "id", F.col("url").alias("title"))))


@register("k05_clean_links", "WITH " + _EV_SQL + """
SELECT 'category' AS kind, id AS event_id, o_orderpriority AS ref_id FROM ev
UNION ALL SELECT 'source', id, o_orderstatus FROM ev WHERE o_orderstatus <> 'P'""")
def k05_clean_links(spark, d):
    t = loaded(spark, d)
    return (t["event_category"].select(F.lit("category").alias("kind"), "event_id",
                                       F.col("category_id").alias("ref_id"))
            .unionByName(t["event_source"].select(F.lit("source").alias("kind"), "event_id",
                                                  F.col("source_id").alias("ref_id"))))


@register("k05_clean_geometry", "WITH " + _EV_SQL + """
SELECT id AS event_id, o_orderdate AS date,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Polygon' ELSE 'Point' END AS type,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN '[[[0, 0], [1, 0], [0, 0]]]'
            ELSE '[' || (o_custkey * 7 % 360 - 180) || ', ' || (o_custkey * 13 % 180 - 90) || ']' END AS coordinates
FROM ev""")
def k05_clean_geometry(spark, d):
    g = loaded(spark, d)["geometry"]
    return g.select("event_id", F.col("date").cast("timestamp_ntz").alias("date"), "type", "coordinates")


@register("k05_clean_earthquake", "WITH " + _Q_SQL + """
SELECT id, time, magnitude, mag_type, place, longitude, latitude, depth_km, tsunami, significance, url
FROM q""")
def k05_clean_earthquake(spark, d):
    """K5 quake: coordinate gates, magnitude range, invalid url nulled,
    tsunami 0/1 -> boolean, latest record per id."""
    q = loaded(spark, d)["earthquake"]
    return q.withColumn("time", F.col("time").cast("timestamp_ntz"))


def faulty_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Event envelopes whose rows pass the cleaning steps but break the
    constraints of the clean tables, by column values."""
    o = table(spark, d, "orders")
    rec = F.struct(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id"),
        _e("CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN repeat('long ', 60) "
           "WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderpriority END").alias("title"),
        F.col("o_orderstatus").alias("description"),
        F.concat(F.lit("https://example.org/o/"), F.col("o_orderkey").cast("string")).alias("link"),
        F.lit(None).cast("string").alias("closed"),
        F.array(F.struct(F.col("o_orderpriority").alias("id"),
                         _e("repeat(o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' THEN 20 ELSE 1 END)").alias("title"))).alias("categories"),
        F.array(F.struct(F.col("o_orderstatus").alias("id"), F.concat(F.lit("https://src.example/"), "o_orderstatus").alias("url"))).alias("sources"),
        F.array(F.struct(F.date_format("o_orderdate", _ISO).alias("date"), F.lit("Point").alias("type"),
                         _e("CASE o_orderpriority WHEN '2-HIGH' THEN '[1, 2, 3]' WHEN '3-MEDIUM' THEN '[999, 1]' ELSE '[1, 2]' END")
                         .alias("coordinates"))).alias("geometry"))
    return o.select(F.to_json(F.struct(F.array(rec).alias("events"))).alias("value"),
                    F.col("o_orderdate").cast("timestamp").alias("_ingested_at"), F.lit("orders").alias("_seq"))


@register("k05_rejected", """
WITH ev AS (SELECT *, o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AS long_title FROM orders
            WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus <> 'F'))
SELECT 'event' AS table_name, 'max_length:title' AS reason, COUNT(*) AS n FROM ev WHERE long_title HAVING COUNT(*) > 0
UNION ALL SELECT 'category', 'max_length:title', 1 FROM ev WHERE o_orderpriority = '1-URGENT' HAVING COUNT(*) > 0
UNION ALL SELECT 'geometry', 'geometry_shape', COUNT(*) FROM ev WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM') HAVING COUNT(*) > 0
UNION ALL SELECT 'geometry', 'missing_parent:event', COUNT(*) FROM ev WHERE long_title HAVING COUNT(*) > 0
UNION ALL SELECT 'event_category', 'missing_parent:event', COUNT(*) FROM ev WHERE long_title HAVING COUNT(*) > 0
UNION ALL SELECT 'event_category', 'missing_parent:category', COUNT(*) FROM ev WHERE o_orderpriority = '1-URGENT' HAVING COUNT(*) > 0
UNION ALL SELECT 'event_source', 'missing_parent:event', COUNT(*) FROM ev WHERE long_title HAVING COUNT(*) > 0
UNION ALL SELECT 'earthquake', 'decimal:depth_km', COUNT(*) FROM lineitem WHERE l_tax > 0.07 HAVING COUNT(*) > 0
UNION ALL SELECT 'earthquake', 'max_length:mag_type', COUNT(*) FROM lineitem WHERE l_returnflag = 'R' HAVING COUNT(*) > 0""")
def k05_rejected(spark, d):
    """Clean rows that break a constraint go to the quarantine
    with their reasons: long titles, Points of three items or out of bounds,
    numbers that don't fit, and the children of rejected parents."""
    ev = _records(faulty_envelopes(spark, d), "events", SC.EVENT_RECORD)
    li = table(spark, d, "lineitem")
    rec = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
                   F.struct(F.lit(1.0).alias("mag"), _e("repeat(l_returnflag, CASE WHEN l_returnflag = 'R' THEN 21 ELSE 1 END)").alias("magType"),
                            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("time")).alias("properties"),
                   F.struct(F.array(F.lit(1.0), F.lit(2.0), _e("CASE WHEN l_tax > 0.07 THEN 123456.0D ELSE 1.0D END")).alias("coordinates")).alias("geometry"))
    env = li.select(F.to_json(F.struct(F.array(rec).alias("features"))).alias("value"),
                    F.col("l_shipdate").cast("timestamp").alias("_ingested_at"), F.lit("lineitem").alias("_seq"))
    t = PL.run(ev, _records(env, "features", SC.QUAKE_RECORD))
    bad = t["quarantine.row"].select("table_name", F.explode("reasons").alias("reason"))
    return bad.groupBy("table_name", "reason").agg(F.count("*").alias("n"))


@register("j03_clean_load_match", "WITH " + _EV_SQL + "," + _Q_SQL + """,
e AS (SELECT id, o_orderdate AS ts, CAST(o_custkey * 7 % 360 - 180 AS DOUBLE) AS lon,
             CAST(o_custkey * 13 % 180 - 90 AS DOUBLE) AS lat FROM ev WHERE o_orderpriority <> '3-MEDIUM'),
qq AS (SELECT id, time AS ts, longitude AS lon, latitude AS lat FROM q),
pairs AS (
  SELECT e.id AS event_id, qq.id AS earthquake_id,
         CAST(floor(epoch(qq.ts)) - floor(epoch(e.ts)) AS BIGINT) AS delay_seconds,
         6371.0 * 2 * asin(sqrt(pow(sin(radians(qq.lat - e.lat) / 2), 2)
           + cos(radians(e.lat)) * cos(radians(qq.lat)) * pow(sin(radians(qq.lon - e.lon) / 2), 2))) AS dist
  FROM e JOIN qq ON abs((floor(epoch(qq.ts)) - floor(epoch(e.ts))) / 3600.0) <= 168.0)
SELECT event_id, earthquake_id, round(dist, 2) AS distance_km, round(delay_seconds / 3600.0, 2) AS delay_hours
FROM pairs WHERE dist <= 500.0""")
def j03_clean_load_match(spark, d):
    """Entry 1 end to end: the event_earthquake table of the clean load."""
    return loaded(spark, d)["event_earthquake"]


def synced(spark: SparkSession, d: str):
    """Entry 5: seed tables, then one batch: reference categories (one per
    order priority) and every order as an event record."""
    env = event_envelopes(spark, d, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ev = _records(env, "events", SC.EVENT_RECORD).withColumn("_seq", F.col("_ingested_at"))
    refs = (table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("id"))
            .agg(F.lit("reference").alias("description"))
            .select("id", F.lower("id").alias("title"), "description"))
    return UP.sync(seed_tables(spark), ev, categories=refs)


_SYNC_SQL = """
WITH ok AS (SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '2-HIGH'),
bad AS (SELECT * FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '2-HIGH')"""


@register("e05_upsert_counts", _SYNC_SQL + """
SELECT 'event' AS table_name, CAST(3 + COUNT(*) AS BIGINT) AS row_count FROM ok
UNION ALL SELECT 'category', CAST(3 + (SELECT COUNT(DISTINCT o_orderpriority) FROM orders) AS BIGINT)
UNION ALL SELECT 'source', CAST(3 + COUNT(DISTINCT o_orderstatus) AS BIGINT) FROM ok
UNION ALL SELECT 'event_category', CAST(4 + COUNT(*) AS BIGINT) FROM ok
UNION ALL SELECT 'event_source', CAST(4 + COUNT(*) AS BIGINT) FROM ok
UNION ALL SELECT 'geometry', CAST(4 + COUNT(*) AS BIGINT) FROM ok
UNION ALL SELECT 'processed', CAST(COUNT(*) AS BIGINT) FROM ok
UNION ALL SELECT 'failed', CAST(COUNT(*) AS BIGINT) FROM bad""")
def e05_upsert_counts(spark, d):
    """Per-record isolation (a record with any invalid row is
    rejected whole), last-writer-wins events, first-writer-wins children."""
    t, counts = synced(spark, d)
    out = None
    for n in ("event", "category", "source", "event_category", "event_source", "geometry"):
        one = t[n].agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    c = counts.selectExpr("stack(2, 'processed', processed, 'failed', failed) AS (table_name, row_count)")
    return out.unionByName(c)


@register("e05_upsert_categories", """
SELECT * FROM (VALUES ('wildfires', 'Wildfires'), ('severeStorms', 'Severe Storms'),
                      ('volcanoes', 'Volcanoes')) s(id, title)
UNION ALL
SELECT DISTINCT o_orderpriority, lower(o_orderpriority) FROM orders""")
def e05_upsert_categories(spark, d):
    """Reference rows update titles; embedded categories never overwrite."""
    t, _ = synced(spark, d)
    return t["category"].select("id", "title")
