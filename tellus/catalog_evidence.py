"""Queries that reach the branches the others don't: lake scans with broken
lines and a missing feed, the gates of the clean load, blanks in the upsert,
and the row order of reports (as a rank column)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellus import schemas as SC
from tellus.catalog import AS_OF, RUN_ID, register, table
from tellus.catalog_feeds import _ISO, _e, _records
from tellus.catalog_hazard import VIEWS_SQL, _controls_sql, _with, audit_before
from tellus.plans import clean_load as PL
from tellus.plans import marts as Q
from tellus.plans import report as RP
from tellus.plans import upsert as UP
from tellus.session import scratch_path
from tellus.sources import feeds as FD
from tellus.sources.tables import seed_tables
from tellus.streaming import lake as LK


# ------------------------------------------------------------- lake scans

@register("s07_lake_scans", """
SELECT 'eonet' AS feed, COUNT(*) AS lines, COUNT(*) FILTER (o_orderstatus = 'P') AS broken,
       COUNT(DISTINCT o_orderkey) FILTER (o_orderstatus <> 'P') AS ids FROM orders
UNION ALL SELECT 'usgs', COUNT(*), 0, COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
UNION ALL SELECT 'absent', 0, 0, 0""")
def s07_lake_scans(spark, d):
    """Both feeds of a written lake, broken lines counted for
    the quarantine; a feed that is not there reads as an empty table."""
    lake = scratch_path(spark, "lake")
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    ev = o.select(F.lit("eonet.events").alias("topic"), _e(
        "CASE WHEN o_orderstatus = 'P' THEN concat('{id ', o_orderkey) "
        "ELSE to_json(named_struct('id', concat('O', o_orderkey))) END").alias("value"))
    qk = li.select(F.lit("usgs.earthquakes").alias("topic"),
                   F.to_json(F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"))).alias("value"))
    # a table may be one split: its rows are dealt out by size before each task sorts its own by folder
    LK.to_lake_rows(ev.unionByName(qk)).hint("rebalance").write.partitionBy(*LK.PARTS).text(lake)

    def scan(feed, schema):
        r = FD.read_lake(spark, lake, feed, schema)
        return r.agg(F.lit(feed).alias("feed"), F.count("*").alias("lines"), F.count_if("_corrupt").alias("broken"),
                     F.count_distinct("id").alias("ids"))
    return scan("eonet", SC.EVENT_RECORD).unionByName(scan("usgs", SC.QUAKE_RECORD)).unionByName(scan("absent", SC.EVENT_RECORD))


# ------------------------------------------------------------------ gates

@register("k05_gates", """
WITH ev AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderpriority <> '4-NOT SPECIFIED')
SELECT 'event' AS table_name, COUNT(DISTINCT o_orderkey) AS n FROM ev
UNION ALL SELECT 'geometry', COUNT(DISTINCT o_orderkey) FROM ev WHERE o_orderpriority <> '3-MEDIUM'
UNION ALL SELECT 'earthquake', COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
  WHERE l_tax <= 0.07 AND NOT (l_returnflag = 'A' AND l_discount > 0.05)
UNION ALL SELECT 'magnitude', COUNT(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
  WHERE l_tax <= 0.07 AND NOT (l_returnflag = 'A' AND l_discount > 0.05) AND l_returnflag <> 'R'""")
def k05_gates(spark, d):
    """Blank titles, bad links, dates that don't
    parse, arrays that are too short, magnitudes missing (kept) or out of
    range (dropped)."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    rec = F.struct(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id"),
        _e("CASE WHEN o_orderpriority = '5-LOW' THEN '   ' ELSE o_orderpriority END").alias("title"),
        _e("CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'gopher://x' ELSE 'https://x/y' END").alias("link"),
        F.array(F.struct(_e(f"CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'soon' ELSE date_format(o_orderdate, \"{_ISO}\") END").alias("date"),
                         F.lit("Point").alias("type"), F.lit("[1, 2]").alias("coordinates"))).alias("geometry"))
    ev = o.select(F.to_json(F.struct(F.array(rec).alias("events"))).alias("value"),
                  F.col("o_orderdate").cast("timestamp").alias("_ingested_at"), F.lit("o").alias("_seq"))
    # the id tells apart what differs in the gates, so any row of an id passes or none does
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    rec = F.struct(key.alias("id"), F.struct(
        _e("CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' AND l_discount > 0.05 THEN 11.0D ELSE 5.0D END").alias("mag"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("time")).alias("properties"),
        F.struct(_e("CASE WHEN l_tax > 0.07 THEN array(1.0D) ELSE array(1.0D, 2.0D) END").alias("coordinates")).alias("geometry"))
    qk = li.select(F.to_json(F.struct(F.array(rec).alias("features"))).alias("value"),
                   F.col("l_shipdate").cast("timestamp").alias("_ingested_at"), F.lit("l").alias("_seq"))
    t = PL.clean_events(PL._slim(_records(ev, "events", SC.EVENT_RECORD)))
    # before the last step, which keeps one row of each id
    q = PL.clean_quakes(PL._slim(_records(qk, "features", SC.QUAKE_RECORD)))
    one = lambda df, n: df.agg(F.lit(n).alias("table_name"), F.count("*").alias("n"))
    withmag = PL.clean_quakes(PL._slim(_records(qk, "features", SC.QUAKE_RECORD)).filter("properties.mag IS NOT NULL"))
    return one(t["event"], "event").unionByName(one(t["geometry"], "geometry")).unionByName(
        one(q, "earthquake")).unionByName(one(withmag, "magnitude"))


# ----------------------------------------------------------------- upsert

@register("e05_upsert_blanks", """
WITH ok AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderpriority <> '4-NOT SPECIFIED')
SELECT 'processed' AS kind, COUNT(*) AS n FROM ok
UNION ALL SELECT 'failed', COUNT(*) FROM orders WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')
UNION ALL SELECT 'sources', COUNT(DISTINCT o_orderstatus) FROM ok WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'titled by id', COUNT(DISTINCT o_orderpriority) FROM ok WHERE o_orderpriority = '1-URGENT'""")
def e05_upsert_blanks(spark, d):
    """An empty address skips the source, an empty category title
    falls back to the id, a title of spaces rejects the record, of the event
    as of a category."""
    o = table(spark, d, "orders")
    rec = F.struct(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("id"),
        _e("CASE WHEN o_orderpriority = '5-LOW' THEN '   ' ELSE 't' END").alias("title"), F.lit("https://x").alias("link"),
        F.array(F.struct(F.concat(F.lit("c"), F.col("o_orderpriority")).alias("id"), _e(
            "CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '4-NOT SPECIFIED' THEN ' ' ELSE 'C' END").alias("title"))).alias("categories"),
        F.array(F.struct(F.concat(F.lit("s"), F.col("o_orderstatus")).alias("id"),
                         _e("CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'https://s' END").alias("url"))).alias("sources"))
    env = o.select(F.to_json(F.struct(F.array(rec).alias("events"))).alias("value"),
                   F.col("o_orderdate").cast("timestamp").alias("_ingested_at"), F.lit("o").alias("_seq"))
    t, counts = UP.sync(seed_tables(spark), _records(env, "events", SC.EVENT_RECORD))
    c = counts.selectExpr("stack(2, 'processed', processed, 'failed', failed) AS (kind, n)")
    s = t["source"].filter("id LIKE 's_'").agg(F.lit("sources").alias("kind"), F.count("*").alias("n"))
    k = t["category"].filter("title = id").agg(F.lit("titled by id").alias("kind"), F.count("*").alias("n"))
    return c.unionByName(s).unionByName(k)


# -------------------------------------------------------------- row order

def _ranked(df: DataFrame) -> DataFrame:
    """The place of each row of a sorted report (few rows by nature)."""
    d = df.withColumn("_at", F.monotonically_increasing_id())
    return d.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


@register("o01_order_by_count", """
SELECT brand, line_count, row_number() OVER (ORDER BY line_count DESC, brand) AS place FROM (
  SELECT p.p_brand AS brand, COUNT(*) AS line_count FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1)""")
def o01_order_by_count(spark, d):
    """O1: most frequent first, ties by name."""
    return _ranked(Q.count_by_title(table(spark, d, "lineitem"), table(spark, d, "part"), link_key="l_partkey",
                                    dim_key="p_partkey", title="p_brand", label="brand", name="line_count"))


@register("o02_order_by_band", """
SELECT band, event_count, row_number() OVER (ORDER BY f) AS place FROM (
  SELECT floor(value) AS f, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' - ' || CAST(CAST(floor(value) AS BIGINT) + 1 AS VARCHAR) AS band,
         COUNT(*) AS event_count FROM events WHERE value IS NOT NULL GROUP BY floor(value))""")
def o02_order_by_band(spark, d):
    """O2: bands in the order of their numbers, not of their texts."""
    return _ranked(Q.band_counts(table(spark, d, "events"), "value", label="band", name="event_count"))


@register("o04_report_order", _with(VIEWS_SQL) + f"""
SELECT phase, dimension, control_id, table_name, total_rows, failing_rows, round(fail_rate * 100, 2) AS fail_pct,
       row_number() OVER (ORDER BY phase, dimension, control_id) AS place FROM ({_controls_sql("", "before", RUN_ID, AS_OF)})""")
def o04_report_order(spark, d):
    """The extract of a run in its order of several keys."""
    return _ranked(RP.extract(audit_before(spark, d), RUN_ID)).drop("details")
