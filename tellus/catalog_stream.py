"""Queries for windows, streaming, monitoring and validation over the
driver tables (S3-S5, T1-T6, K2, K3, A13, Q21, Q23, F12, X1-X10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellus import schemas as SC
from tellus.catalog import LEFT, MAX_HOURS, MAX_KM, RIGHT, _match_sql, _pts_sql, match_points, points, register, table
from tellus.catalog_feeds import _records, event_envelopes, quake_envelopes
from tellus.catalog_hazard import hazard_tables
from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators import validate as V
from tellus.plans import marts as Q
from tellus.plans import report as RP
from tellus.session import scratch_path
from tellus.sources import feeds as FD
from tellus.sources import sinks as K
from tellus.streaming import lake as LK
from tellus.streaming import match as SM


# ------------------------------------------------------ collection windows

@register("s03_event_window", """
SELECT 'O' || o_orderkey AS id FROM orders
WHERE o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 30 DAY
ORDER BY o_orderdate DESC, id LIMIT 50""")
def s03_event_window(spark, d):
    """S3: open events of the last 30 days before ``as_of``, newest 50."""
    ev = _records(event_envelopes(spark, d), "events", SC.EVENT_RECORD)
    return FD.event_window(ev, as_of="2001-08-01 00:00:00", days=30, limit=50).select("id")


@register("s04_quake_window", """
SELECT l_orderkey || '-' || l_linenumber AS id, l_shipdate AS time FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'
  AND l_quantity / 5.0 >= 4.5
ORDER BY l_shipdate DESC, id LIMIT 500""")
def s04_quake_window(spark, d):
    """Quakes in a time range above a magnitude, newest 500."""
    q = _records(quake_envelopes(spark, d), "features", SC.QUAKE_RECORD)
    w = FD.quake_window(q, start="1998-01-01 00:00:00", end="1998-12-31 00:00:00",
                        min_magnitude=4.5, limit=500)
    return w.select("id", F.timestamp_millis("properties.time").cast("timestamp_ntz").alias("time"))


@register("s05_reference_rows", """
SELECT CAST(s_suppkey AS VARCHAR) AS id,
       CASE WHEN s_acctbal >= 5000 THEN 'https://s' || s_suppkey || '.org'
            WHEN s_acctbal >= 0 THEN 'https://alt' || s_suppkey || '.org' END AS url
FROM supplier WHERE s_acctbal >= 0""")
def s05_reference_rows(spark, d):
    """Reference-data envelope; the address falls back to the second
    field and rows without any address are skipped."""
    s = table(spark, d, "supplier")
    rec = F.struct(F.col("s_suppkey").cast("string").alias("id"),
                   F.expr("CASE WHEN s_acctbal >= 5000 THEN concat('https://s', s_suppkey, '.org') "
                          "ELSE '' END").alias("url"),
                   F.expr("CASE WHEN s_acctbal >= 0 THEN concat('https://alt', s_suppkey, '.org') END")
                   .alias("source"))
    env = s.select(F.to_json(F.struct(F.array(rec).alias("sources"))).alias("value"))
    return FD.reference_rows(env, "sources")


# ------------------------------------------------------------ streaming

def _event_messages(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of keyed JSON messages: four files, one
    per micro-batch."""
    events = table(spark, d, "events")
    files = scratch_path(spark, "messages")
    events.repartition(4, "event_id").write.parquet(files)
    s = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    return s.select(F.concat(F.lit("app."), "event_type").alias("topic"),
                    F.col("event_id").cast("string").alias("key"),
                    F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value")).alias("value"),
                    F.col("ts").cast("timestamp").alias("_t"))


@register("t01_lake_volumes", """
SELECT 'app_' || event_type AS source, TRUE AS has_objects, COUNT(*) AS lines
FROM events GROUP BY event_type""")
def t01_lake_volumes(spark, d):
    """Stream the messages into the raw lake
    (one line per message, partitioned by source and flush hour), drain with
    an available-now trigger over several micro-batches, then count objects
    and lines per source from the written lake (how many objects there are
    depends on the writers, so only that there are some is compared)."""
    return LK.volumes(spark, _written_lake(spark, d)).select("source", (F.col("objects") >= 1).alias("has_objects"), "lines")


def _written_lake(spark, d) -> str:
    lake, ck = scratch_path(spark, "lake"), scratch_path(spark, "lake-ck")
    LK.ingest(_event_messages(spark, d), lake, ck, routes={}, available_now=True).awaitTermination()
    return lake


@register("q22_raw_vs_clean", """
WITH raw AS (SELECT 'app_' || event_type AS source, COUNT(*) AS lines FROM events GROUP BY 1),
clean AS (SELECT 'app_' || event_type AS source, COUNT(DISTINCT event_id) AS clean_rows FROM events
          WHERE ts IS NOT NULL AND value >= 1.0 GROUP BY 1)
SELECT raw.source, TRUE AS has_objects, lines, COALESCE(clean_rows, 0) AS clean_rows,
       lines - COALESCE(clean_rows, 0) AS gap,
       CAST((2 * COALESCE(clean_rows, 0) * 10000 + lines) // (2 * lines) AS DOUBLE) / 10000 AS clean_ratio
FROM raw LEFT JOIN clean ON raw.source = clean.source""")
def q22_raw_vs_clean(spark, d):
    """The written lake's volumes against the rows of a clean
    table that was loaded from the same lake."""
    lake, tables = _written_lake(spark, d), scratch_path(spark, "tables")
    lines = spark.read.option("basePath", lake).text(lake)
    rec = lines.select("source", F.from_json("value", "event_id long, ts string, value double").alias("r")).select("source", "r.*")
    K.write_snapshot(rec.filter("ts IS NOT NULL AND value >= 1.0").dropDuplicates(["event_id"]), tables, "clean")
    clean = K.read_snapshot(spark, tables, "clean").groupBy("source").agg(F.count("*").alias("clean_rows"))
    out = Q.raw_vs_clean(LK.volumes(spark, lake), clean)
    return out.withColumn("has_objects", F.col("objects") >= 1).drop("objects")


@register("t06_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def t06_stream_dedup(spark, d):
    """Replayed records deduplicated on the stream within a watermark."""
    schema = table(spark, d, "events").schema
    s = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
         .withColumn("ts", F.col("ts").cast("timestamp")))
    out = scratch_path(spark, "dedup")
    q = (LK.dedup_stream(s, ["user_id", "event_type"], "ts", "365 days")
         .select("user_id", "event_type").writeStream.format("parquet")
         .option("checkpointLocation", out + "-ck").trigger(availableNow=True).start(out))
    q.awaitTermination()
    return spark.read.parquet(out)


def _point_stream(spark, d, kinds):
    schema = table(spark, d, "events").schema
    s = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
         .filter(F.col("event_type").isin(*kinds)))
    return s.select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"),
                    (((F.col("event_id") * 7919) % 36000).cast("double") / 100 - 180).alias("lon"),
                    (((F.col("event_id") * 104729) % 18000).cast("double") / 100 - 90).alias("lat"))


@register("t03_stream_match", _match_sql() + """
SELECT l_id AS event_id, r_id AS earthquake_id, round(dist, 2) AS distance_km, delay_seconds
FROM best WHERE rn = 1""")
def t03_stream_match(spark, d):
    """J3 as a stream-stream join under watermarks (optional streaming form);
    each error event has one point, so every pair is already unique."""
    out = scratch_path(spark, "stream-match")
    m = SM.stream_match(_point_stream(spark, d, LEFT), _point_stream(spark, d, RIGHT),
                        max_km=MAX_KM, max_hours=MAX_HOURS, delay="365 days")
    q = (m.writeStream.format("parquet").option("checkpointLocation", out + "-ck")
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    r = spark.read.parquet(out)
    return r.select(F.col("l_id").alias("event_id"), F.col("r_id").alias("earthquake_id"),
                    F.round("distance_km", 2).alias("distance_km"), "delay_seconds")


# ------------------------------------------------------------ monitoring

@register("q21_trace_record", f"""
WITH e AS ({_pts_sql(LEFT)}), q AS ({_pts_sql(RIGHT)}),
target AS (SELECT max_by(id, (value, id)) AS id FROM q)
SELECT e.id AS event_id, q.id AS earthquake_id,
       CAST(floor(epoch(q.ts)) - floor(epoch(e.ts)) AS BIGINT) AS delay_seconds
FROM e JOIN q ON q.id = (SELECT id FROM target)
WHERE abs((floor(epoch(q.ts)) - floor(epoch(e.ts))) / 3600.0) <= 168.0
  AND 6371.0 * 2 * asin(sqrt(pow(sin(radians(q.lat - e.lat) / 2), 2)
        + cos(radians(e.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - e.lon) / 2), 2))) <= 500.0""")
def q21_trace_record(spark, d):
    """One record (the strongest quake) traced into the matches.
    The quake side is cut to the record before the match, so one point is
    matched."""
    qk = points(spark, d, RIGHT)
    strongest = qk.agg(F.max_by("id", F.struct("value", "id")).alias("target"))
    # one row by construction
    one = qk.join(F.broadcast(strongest), F.col("id") == F.col("target"), "left_semi")
    return match_points(spark, points(spark, d, LEFT), one).select("event_id", "earthquake_id", "delay_seconds")


def _metrics(spark, d) -> DataFrame:
    """Hourly snapshots per source: cumulative raw lines and clean rows."""
    e = table(spark, d, "events")
    per_hour = (e.groupBy(F.col("event_type").alias("source"),
                          F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("at"))
                 .agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("value") >= 100).alias("clean")))
    from pyspark.sql import Window
    w = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return per_hour.select("source", "at", F.sum("raw").over(w).alias("raw_lines"),
                           F.sum("clean").over(w).alias("clean_rows"))


@register("q23_stalled", """
WITH h AS (SELECT event_type AS source, date_trunc('hour', ts) AS snap, COUNT(*) AS raw,
                  COUNT(*) FILTER (WHERE value >= 100) AS clean FROM events GROUP BY 1, 2),
m AS (SELECT source, snap, SUM(raw) OVER w AS raw_lines, SUM(clean) OVER w AS clean_rows FROM h
      WINDOW w AS (PARTITION BY source ORDER BY snap ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT *, clean_rows = lag(clean_rows) OVER (PARTITION BY source ORDER BY snap) AS flat FROM m),
g AS (SELECT *, SUM(CASE WHEN flat THEN 0 ELSE 1 END) OVER (PARTITION BY source ORDER BY snap
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM f),
r AS (SELECT source, grp, MIN(snap) AS since, MAX(snap) AS until, CAST(MAX(raw_lines) - MIN(raw_lines) AS BIGINT) AS raw_growth
      FROM g GROUP BY source, grp)
SELECT source, since, until, raw_growth,
       round((epoch(until) - epoch(since)) / 60.0, 1) AS flat_minutes
FROM r WHERE (epoch(until) - epoch(since)) / 60.0 > 15 AND raw_growth > 0""")
def q23_stalled(spark, d):
    """Q23: raw volume grows while the clean count stays flat > 15 min."""
    st = RP.stalled(_metrics(spark, d), minutes=15)
    return st.withColumn("since", F.col("since").cast("timestamp_ntz")).withColumn(
        "until", F.col("until").cast("timestamp_ntz"))


@register("f12_bbox_filter", """
SELECT event_id AS id, lon, lat FROM (
  SELECT event_id, CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 AS lon,
         CAST((event_id * 104729) % 18000 AS DOUBLE) / 100 - 90 AS lat
  FROM events)
WHERE lon BETWEEN -30 AND 60 AND lat BETWEEN 0 AND 70""")
def f12_bbox_filter(spark, d):
    """bounding-box filter."""
    p = points(spark, d)
    return p.filter(P.in_bbox("lon", "lat", -30, 0, 60, 70)).select("id", "lon", "lat")


# ------------------------------------------------------------ validation

def _geometry_validated(spark, d):
    t = hazard_tables(spark, d)
    rules = [*V.not_null("event_id", "date", "type", "coordinates"),
             V.one_of("type", ["Point", "Polygon"]), V.point_geometry(), V.max_length("type", 20),
             V.Rule("date_parses", S.parse_ts("date").isNotNull() | F.col("date").isNull())]
    g = t["geometry"].withColumn("_canon", S.canonical_json("coordinates"))
    return V.validate(g, rules, key=["event_id", "date", "_canon"], key_order=["_ingested_at", "_pos"],
                      parents=[("event", t["event"], "event_id", "id")])


@register("x05_geometry_rejections", """
WITH g AS (
  SELECT CASE WHEN event_type = 'signup' AND value > 200 THEN 'U' || user_id
              ELSE CAST(user_id AS VARCHAR) END AS event_id,
    CASE WHEN event_type = 'signup' AND value < 1 THEN 'n/a'
         ELSE strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') END AS date,
    CASE WHEN event_type = 'view' THEN 'Polygon'
         WHEN event_type = 'signup' AND value > 300 THEN 'LineString'
         WHEN event_type = 'signup' AND value < 2 THEN NULL ELSE 'Point' END AS type,
    CASE WHEN event_type = 'view' THEN '[[[0, 0], [1, 0], [1, 1], [0, 0]]]'
         WHEN event_type = 'click' AND value < 2 THEN NULL
         WHEN event_type = 'error' AND value > 300 THEN '[' || (user_id * 7 % 360 - 180) || ']'
         ELSE '[' || (user_id * 7 % 360 - 180) || ', ' || (user_id * 13 % 180 - 90) || ']' END AS coordinates,
    ts AS _ingested_at, event_id AS _pos
  FROM events),
r AS (
  SELECT *, list_filter([
    CASE WHEN event_id IS NULL THEN 'not_null:event_id' END,
    CASE WHEN date IS NULL THEN 'not_null:date' END,
    CASE WHEN type IS NULL THEN 'not_null:type' END,
    CASE WHEN coordinates IS NULL THEN 'not_null:coordinates' END,
    CASE WHEN type IS NOT NULL AND type NOT IN ('Point', 'Polygon') THEN 'one_of:type' END,
    CASE WHEN type = 'Point' AND NOT COALESCE(json_array_length(coordinates) = 2
           AND CAST(json_extract(coordinates, '$[0]') AS DOUBLE) BETWEEN -180 AND 180
           AND CAST(json_extract(coordinates, '$[1]') AS DOUBLE) BETWEEN -90 AND 90, FALSE)
         THEN 'geometry_shape'
         WHEN type = 'Polygon' AND json_array_length(coordinates) IS NULL AND coordinates IS NOT NULL
         THEN 'geometry_shape' END,
    CASE WHEN length(type) > 20 THEN 'max_length:type' END,
    CASE WHEN date IS NOT NULL AND TRY_CAST(date AS TIMESTAMPTZ) IS NULL THEN 'date_parses' END,
    CASE WHEN event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o
           WHERE CAST(o.o_custkey AS VARCHAR) = g.event_id) THEN 'missing_parent:event' END
  ], lambda x: x IS NOT NULL) AS reasons
  FROM g),
ok AS (SELECT * FROM r WHERE len(reasons) = 0),
dup AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY event_id, date, CAST(json(coordinates) AS VARCHAR)
          ORDER BY _ingested_at DESC NULLS FIRST, _pos DESC NULLS FIRST) > 1),
all_reasons AS (SELECT unnest(reasons) AS reason FROM r UNION ALL SELECT 'duplicate_key' FROM dup)
SELECT reason, COUNT(*) AS n FROM all_reasons GROUP BY reason""")
def x05_geometry_rejections(spark, d):
    """Section 2.12 on the geometry table: NOT NULL (X1), type set (X4),
    Point shape and bounds (X5), varchar length (X10), parsable date,
    unique JSON value (X7/X8) and foreign key (X9); rejections per reason."""
    _, bad = _geometry_validated(spark, d)
    return bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


@register("x07_tied_duplicates", """
SELECT 'accepted' AS outcome, COUNT(DISTINCT (user_id, event_type)) AS n FROM events
UNION ALL SELECT 'duplicate_key', COUNT(*) - COUNT(DISTINCT (user_id, event_type)) FROM events""")
def x07_tied_duplicates(spark, d):
    """Rows that tie on the key, most of them identical: one of each key
    is accepted, all others are rejected, and none is lost."""
    good, bad = V.validate(table(spark, d, "events").select("user_id", "event_type"), [], key=["user_id", "event_type"])
    kinds = good.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(F.explode("reasons").alias("outcome")))
    return kinds.groupBy("outcome").agg(F.count("*").alias("n"))


@register("x11_rules", """
SELECT name AS reason, n FROM (
  SELECT 'not_blank:title' AS name, COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS n FROM orders
  UNION ALL SELECT 'url:link', COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') FROM orders
  UNION ALL SELECT 'decimal:amount', COUNT(*) FILTER (WHERE round(o_totalprice, 2) >= 100000) FROM orders
  UNION ALL SELECT 'one_of:phase', COUNT(*) FILTER (WHERE o_orderstatus = 'P') FROM orders) WHERE n > 0""")
def x11_rules(spark, d):
    """X2, X3, X10 (decimal) and X11 as rules over one table."""
    o = table(spark, d, "orders").select(
        F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN '  ' ELSE o_orderpriority END").alias("title"),
        F.expr("concat(CASE WHEN o_orderpriority = '2-HIGH' THEN 'ftp' ELSE 'https' END, '://x/', o_orderkey)").alias("link"),
        F.col("o_totalprice").alias("amount"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'before' WHEN 'O' THEN 'after' ELSE 'never' END").alias("phase"))
    _, bad = V.validate(o, [V.not_blank("title"), V.url("link"), V.fits_decimal("amount", 7, 2), V.one_of("phase", ["before", "after"])])
    return bad.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
