"""The hazard data model derived from the driver tables, for the audit,
repair and report queries (sections 2.9-2.11).

Every staging table is a projection of one driver table; faults come from
column values (no sampling, no row subsets), so the controls, repairs and
report queries run over whole tables:

=============== =========== ==============================================
hazard table    driver      key / notable derivations
=============== =========== ==============================================
event           orders      id = custkey (duplicates), closed = date of F
category        part        id = brand (duplicates), blank/NULL titles
source          supplier    id = nationkey (duplicates), scheme-less urls
geometry        events      event_id = user, hour text dates, JSON coords
event_category  lineitem    (partkey, 'Brand#' || suppkey % 30)
event_source    lineitem    (suppkey, partkey % 30)
earthquake      events      id = user-type, derived lon/lat/magnitude
=============== =========== ==============================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellus.catalog import AS_OF, RUN_AT, RUN_ID, register, table
from tellus.plans import audit as AU
from tellus.plans import report as RP
from tellus.plans.repair import repair
from tellus.session import scratch_path
from tellus.sources.sinks import append_report, write_parquet_all

OLD_RUN_ID = "run-0000"
OLD_RUN_AT = "1999-12-31 00:00:00"
# the older run saw the tables two years before
OLD_AS_OF = "1997-06-01 00:00:00"
EPOCH_2024 = 1704067200


def _e(sql: str):
    return F.expr(sql)


def hazard_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    o, p, s = table(spark, d, "orders"), table(spark, d, "part"), table(spark, d, "supplier")
    ev, li = table(spark, d, "events"), table(spark, d, "lineitem")
    event = o.select(
        F.col("o_custkey").cast("string").alias("id"),
        _e("CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL "
           "WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '   ' "
           "ELSE concat(' ', o_orderpriority) END").alias("title"),
        _e("CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END").alias("description"),
        _e("CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL "
           "WHEN o_orderpriority = '2-HIGH' THEN concat('example.org/c/', o_custkey) "
           "ELSE concat('https://example.org/c/', o_custkey) END").alias("link"),
        _e("CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) END").alias("closed"),
        F.col("o_orderdate").cast("timestamp").alias("_ingested_at"),
        F.col("o_orderkey").alias("_pos"))
    category = p.select(
        F.col("p_brand").alias("id"),
        _e("CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN ' ' ELSE p_type END").alias("title"),
        F.col("p_name").alias("description"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("p_partkey")).alias("_ingested_at"),
        F.col("p_partkey").alias("_pos"))
    source = s.select(
        F.col("s_nationkey").cast("string").alias("id"),
        _e("CASE WHEN s_acctbal < 0 THEN concat('www.s', s_suppkey, '.org') "
           "WHEN s_acctbal < 1000 THEN concat('//s', s_suppkey) "
           "ELSE concat('https://s', s_suppkey, '.org') END").alias("url"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("s_suppkey")).alias("_ingested_at"),
        F.col("s_suppkey").alias("_pos"))
    geometry = ev.select(
        _e("CASE WHEN event_type = 'signup' AND value > 200 THEN concat('U', user_id) "
           "ELSE CAST(user_id AS STRING) END").alias("event_id"),
        _e("CASE WHEN event_type = 'signup' AND value < 1 THEN 'n/a' "
           "ELSE date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END").alias("date"),
        _e("CASE WHEN event_type = 'view' THEN 'Polygon' "
           "WHEN event_type = 'signup' AND value > 300 THEN 'LineString' "
           "WHEN event_type = 'signup' AND value < 2 THEN NULL ELSE 'Point' END").alias("type"),
        _e("CASE WHEN event_type = 'view' THEN '[[[0, 0], [1, 0], [1, 1], [0, 0]]]' "
           "WHEN event_type = 'click' AND value < 2 THEN NULL "
           "WHEN event_type = 'error' AND value > 300 THEN concat('[', user_id * 7 % 360 - 180, ']') "
           "ELSE concat('[', user_id * 7 % 360 - 180, ', ', user_id * 13 % 180 - 90, ']') END")
        .alias("coordinates"),
        F.col("ts").cast("timestamp").alias("_ingested_at"),
        F.col("event_id").alias("_pos"))
    event_category = li.select(
        F.col("l_partkey").cast("string").alias("event_id"),
        _e("CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL "
           "ELSE concat('Brand#', l_suppkey % 30) END").alias("category_id"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"))
    event_source = li.select(
        _e("CASE WHEN l_returnflag = 'A' AND l_discount > 0.09 THEN concat('X', l_suppkey) "
           "ELSE CAST(l_suppkey AS STRING) END").alias("event_id"),
        (F.col("l_partkey") % 30).cast("string").alias("source_id"),
        F.col("l_shipdate").cast("timestamp").alias("_ingested_at"))
    earthquake = ev.select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"),
        _e("CASE WHEN event_type = 'view' AND value < 1 THEN CAST(ts AS TIMESTAMP) - INTERVAL '27' YEAR "
           "ELSE CAST(ts AS TIMESTAMP) END").alias("time"),
        _e("CASE WHEN event_type = 'error' THEN NULL ELSE value / 30.0 END").alias("magnitude"),
        _e("CASE WHEN event_type = 'click' THEN NULL ELSE event_type END").alias("mag_type"),
        _e("CASE WHEN event_type = 'signup' THEN ' ' WHEN event_type = 'click' AND value < 1 THEN NULL ELSE props END").alias("place"),
        _e("CASE WHEN value > 400 THEN 181.0 WHEN event_type = 'signup' THEN 0.0 "
           "ELSE CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 END").alias("longitude"),
        _e("CASE WHEN value < 0.05 THEN NULL WHEN value > 350 THEN 95.0 WHEN event_type = 'signup' THEN 0.0 "
           "ELSE CAST((event_id * 104729) % 18000 AS DOUBLE) / 100 - 90 END").alias("latitude"),
        _e("CASE WHEN event_type = 'view' THEN NULL ELSE value - 20 END").alias("depth_km"),
        _e("CAST(get_json_object(props, '$.k') AS INT) > 80").alias("tsunami"),
        _e("CAST(get_json_object(props, '$.k') AS INT)").alias("significance"),
        F.concat(F.lit("https://quake.example/"), F.col("event_id").cast("string")).alias("url"),
        F.col("ts").cast("timestamp").alias("_ingested_at"),
        F.col("event_id").alias("_pos"))
    out = {"event": event, "category": category, "source": source, "geometry": geometry,
           "event_category": event_category, "event_source": event_source,
           "earthquake": earthquake}
    return out


# DuckDB statement of the same views.
VIEWS_SQL = f"""
event AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
         WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '   '
         ELSE ' ' || o_orderpriority END AS title,
    CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS description,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL
         WHEN o_orderpriority = '2-HIGH' THEN 'example.org/c/' || o_custkey
         ELSE 'https://example.org/c/' || o_custkey END AS link,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed,
    o_orderdate AS _ingested_at, o_orderkey AS _pos
  FROM orders),
category AS (
  SELECT p_brand AS id,
    CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN ' ' ELSE p_type END AS title,
    p_name AS description,
    CAST(to_timestamp({EPOCH_2024} + p_partkey) AS TIMESTAMP) AS _ingested_at, p_partkey AS _pos
  FROM part),
source AS (
  SELECT CAST(s_nationkey AS VARCHAR) AS id,
    CASE WHEN s_acctbal < 0 THEN 'www.s' || s_suppkey || '.org'
         WHEN s_acctbal < 1000 THEN '//s' || s_suppkey
         ELSE 'https://s' || s_suppkey || '.org' END AS url,
    CAST(to_timestamp({EPOCH_2024} + s_suppkey) AS TIMESTAMP) AS _ingested_at, s_suppkey AS _pos
  FROM supplier),
geometry AS (
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
event_category AS (
  SELECT CAST(l_partkey AS VARCHAR) AS event_id,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
         ELSE 'Brand#' || (l_suppkey % 30) END AS category_id,
    l_shipdate AS _ingested_at
  FROM lineitem),
event_source AS (
  SELECT CASE WHEN l_returnflag = 'A' AND l_discount > 0.09 THEN 'X' || l_suppkey
              ELSE CAST(l_suppkey AS VARCHAR) END AS event_id, CAST(l_partkey % 30 AS VARCHAR) AS source_id,
    l_shipdate AS _ingested_at
  FROM lineitem),
earthquake AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || event_type AS id,
    CASE WHEN event_type = 'view' AND value < 1 THEN ts - INTERVAL 27 YEAR ELSE ts END AS time,
    CASE WHEN event_type = 'error' THEN NULL ELSE value / 30.0 END AS magnitude,
    CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS mag_type,
    CASE WHEN event_type = 'signup' THEN ' ' WHEN event_type = 'click' AND value < 1 THEN NULL ELSE props END AS place,
    CASE WHEN value > 400 THEN 181.0 WHEN event_type = 'signup' THEN 0.0 ELSE CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 END AS longitude,
    CASE WHEN value < 0.05 THEN NULL WHEN value > 350 THEN 95.0 WHEN event_type = 'signup' THEN 0.0 ELSE CAST((event_id * 104729) % 18000 AS DOUBLE) / 100 - 90 END AS latitude,
    CASE WHEN event_type = 'view' THEN NULL ELSE value - 20 END AS depth_km,
    CAST(json_extract_string(props, '$.k') AS INTEGER) > 80 AS tsunami,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS significance,
    'https://quake.example/' || event_id AS url,
    ts AS _ingested_at, event_id AS _pos
  FROM events)"""

# Repairs in SQL (imputation -> deletion -> correction), one CTE per table and stage.
_FIX_URL = ("CASE WHEN {c} IS NOT NULL AND NOT regexp_matches({c}, '^https?://') "
            "AND regexp_matches({c}, '^[a-zA-Z0-9]') THEN 'https://' || {c} ELSE {c} END")
_LATEST = "QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY _ingested_at DESC NULLS FIRST, _pos DESC NULLS FIRST) = 1"
REPAIR_SQL = f"""
eq1 AS (SELECT * REPLACE (COALESCE(mag_type, 'unknown') AS mag_type,
          CASE WHEN place IS NULL OR trim(place, ' ') = '' THEN 'unknown' ELSE place END AS place)
        FROM earthquake),
ev1 AS (SELECT * REPLACE (COALESCE(description, '') AS description) FROM event),
cat1 AS (SELECT * REPLACE (CASE WHEN title IS NULL OR trim(title, ' ') = '' THEN id ELSE title END AS title)
         FROM category),
eq2 AS (SELECT * FROM eq1 WHERE NOT COALESCE(
          longitude IS NULL OR latitude IS NULL
          OR longitude < -180 OR longitude > 180 OR latitude < -90 OR latitude > 90
          OR (magnitude IS NOT NULL AND (magnitude < -1 OR magnitude > 10))
          OR (depth_km IS NOT NULL AND depth_km < 0), FALSE)),
ev2 AS (SELECT * FROM ev1 WHERE NOT COALESCE(title IS NULL OR trim(title, ' ') = '' OR link IS NULL, FALSE)),
geo2 AS (SELECT * FROM geometry g
         WHERE NOT COALESCE(coordinates IS NULL OR type NOT IN ('Point', 'Polygon'), FALSE)
           AND EXISTS (SELECT 1 FROM ev2 WHERE ev2.id = g.event_id)),
ec2 AS (SELECT * FROM event_category x
        WHERE EXISTS (SELECT 1 FROM ev2 WHERE ev2.id = x.event_id)
          AND EXISTS (SELECT 1 FROM cat1 WHERE cat1.id = x.category_id)),
es2 AS (SELECT * FROM event_source x
        WHERE EXISTS (SELECT 1 FROM ev2 WHERE ev2.id = x.event_id)
          AND EXISTS (SELECT 1 FROM source WHERE source.id = x.source_id)),
r_event AS (SELECT * REPLACE (trim(title, ' ') AS title, {_FIX_URL.format(c='link')} AS link) FROM ev2
            {_LATEST.format(k='id')}),
r_source AS (SELECT * REPLACE ({_FIX_URL.format(c='url')} AS url) FROM source {_LATEST.format(k='id')}),
r_earthquake AS (SELECT * FROM eq2 {_LATEST.format(k='id')}),
r_category AS (SELECT * FROM cat1 {_LATEST.format(k='id')}),
r_event_category AS (SELECT DISTINCT event_id, category_id FROM ec2),
r_event_source AS (SELECT DISTINCT event_id, source_id FROM es2),
r_geometry AS (
  SELECT * FROM geo2 WHERE event_id IS NULL OR coordinates IS NULL
  UNION ALL
  SELECT * FROM geo2 WHERE event_id IS NOT NULL AND coordinates IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id, date, CAST(json(coordinates) AS VARCHAR)
                             ORDER BY _ingested_at DESC NULLS FIRST, _pos DESC NULLS FIRST) = 1)"""


def _controls_sql(p: str, phase: str, run_id: str, as_of: str) -> str:
    """The 32 controls as one UNION ALL over tables prefixed ``p``."""
    t = {n: f"{p}{n}" for n in ("event", "category", "source", "geometry", "event_category",
                                "event_source", "earthquake")}
    asof = f"TIMESTAMP '{as_of}'"
    row = [
        ("C01", "completeness", "event", "title IS NULL OR trim(title, ' ') = ''"),
        ("C02", "completeness", "event", "description IS NULL"),
        ("C03", "completeness", "event", "link IS NULL"),
        ("C04", "completeness", "earthquake", "magnitude IS NULL"),
        ("C05", "completeness", "earthquake", "mag_type IS NULL"),
        ("C06", "completeness", "earthquake", "place IS NULL"),
        ("C07", "completeness", "earthquake", "depth_km IS NULL"),
        ("C08", "completeness", "earthquake", "longitude IS NULL OR latitude IS NULL"),
        ("C09", "completeness", "geometry", "coordinates IS NULL"),
        ("V01", "validity", "event", "link IS NOT NULL AND NOT regexp_matches(link, '^https?://')"),
        ("V02", "validity", "source", "url IS NOT NULL AND NOT regexp_matches(url, '^https?://')"),
        ("V03", "validity", "earthquake", "longitude IS NOT NULL AND (longitude < -180 OR longitude > 180)"),
        ("V04", "validity", "earthquake", "latitude IS NOT NULL AND (latitude < -90 OR latitude > 90)"),
        ("V05", "validity", "earthquake", "magnitude IS NOT NULL AND (magnitude < -1 OR magnitude > 10)"),
        ("V06", "validity", "earthquake", "depth_km IS NOT NULL AND depth_km < 0"),
        ("V07", "validity", "geometry", "type IS NOT NULL AND type NOT IN ('Point', 'Polygon')"),
        ("V08", "validity", "geometry", "type = 'Point' AND coordinates IS NOT NULL AND "
                                        "(json_type(coordinates) <> 'ARRAY' OR json_array_length(coordinates) < 2)"),
        ("Co02", "coherence", "earthquake", "tsunami AND (magnitude IS NULL OR magnitude < 6.5)"),
        ("Co03", "coherence", "earthquake", f"time > {asof} + INTERVAL 1 DAY"),
        ("Co04", "coherence", "earthquake", f"time < {asof} - INTERVAL 365 DAY"),
        ("Co05", "coherence", "event", f"closed IS NOT NULL AND closed > {asof} + INTERVAL 1 DAY"),
    ]
    parts = []
    for cid, dim, tab, where in row:
        parts.append(f"SELECT '{cid}' AS control_id, '{dim}' AS dimension, 'staging.{tab}' AS table_name, "
                     f"COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {where}) AS failing_rows FROM {t[tab]}")

    def dup(cid, dim, tab, keys):
        parts.append(f"SELECT '{cid}', '{dim}', 'staging.{tab}', CAST(SUM(c) AS BIGINT), "
                     f"CAST(COALESCE(SUM(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) "
                     f"FROM (SELECT COUNT(*) AS c FROM {t[tab]} GROUP BY {keys})")

    def orphan(cid, tab, ck, parent):
        parts.append(f"SELECT '{cid}', 'integrity', 'staging.{tab}', COUNT(*), "
                     f"COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {t[parent]} p WHERE p.id = x.{ck})) "
                     f"FROM {t[tab]} x")
    dup("U01", "uniqueness", "event", "id")
    dup("U02", "uniqueness", "earthquake", "id")
    dup("U03", "uniqueness", "earthquake",
        "date_trunc('minute', time), round(CAST(latitude AS DECIMAL(18,6)), 1), "
        "round(CAST(longitude AS DECIMAL(18,6)), 1), round(CAST(magnitude AS DECIMAL(18,6)), 1)")
    dup("U04", "uniqueness", "category", "id")
    dup("U05", "uniqueness", "source", "id")
    parts.append(f"SELECT 'Co01', 'coherence', 'staging.event', COUNT(*) FILTER (WHERE e.closed IS NOT NULL), "
                 f"COUNT(*) FILTER (WHERE e.closed IS NOT NULL AND e.closed < (SELECT MIN(CAST(TRY_CAST(g.date AS TIMESTAMPTZ) AS TIMESTAMP)) "
                 f"FROM {t['geometry']} g WHERE g.event_id = e.id)) FROM {t['event']} e")
    orphan("I01", "event_category", "event_id", "event")
    orphan("I02", "event_category", "category_id", "category")
    orphan("I03", "event_source", "event_id", "event")
    orphan("I04", "event_source", "source_id", "source")
    orphan("I05", "geometry", "event_id", "event")
    body = "\n  UNION ALL ".join(parts)
    return (f"SELECT '{run_id}' AS run_id, '{phase}' AS phase, control_id, dimension, table_name, "
            f"CAST(total_rows AS BIGINT) AS total_rows, CAST(failing_rows AS BIGINT) AS failing_rows, "
            f"CASE WHEN total_rows = 0 THEN 0.0 ELSE CAST((2 * failing_rows * 10000 + total_rows) // (2 * total_rows) AS DOUBLE) / 10000 END AS fail_rate "
            f"FROM (\n  {body})")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes if c.strip())


_BEFORE = _controls_sql("", "before", RUN_ID, AS_OF)
_AFTER = _controls_sql("r_", "after", RUN_ID, AS_OF)
_OLD = _controls_sql("", "before", OLD_RUN_ID, OLD_AS_OF)
REPORT_SQL = (f"report AS MATERIALIZED (SELECT *, TIMESTAMP '{RUN_AT}' AS run_at FROM ({_BEFORE}) "
              f"UNION ALL SELECT *, TIMESTAMP '{RUN_AT}' FROM ({_AFTER}) "
              f"UNION ALL SELECT *, TIMESTAMP '{OLD_RUN_AT}' FROM ({_OLD}))")
_OUT = "run_id, phase, control_id, dimension, table_name, total_rows, failing_rows, fail_rate"


def audit_before(spark, d, run_id=RUN_ID, run_at=RUN_AT, as_of=AS_OF):
    return AU.run_audit(hazard_tables(spark, d), phase="before", run_id=run_id, run_at=run_at,
                        as_of=as_of)


def repaired(spark, d):
    """Repaired tables and change counts, as lazy plans over the hazard
    tables; nothing runs until a result is read."""
    return repair(hazard_tables(spark, d))


def written_repair(spark, d):
    """The repaired tables, written to the shared checkpoint folder (the
    repair's output is a new table version): the audit that follows reads
    every table several times."""
    t, _ = repaired(spark, d)
    paths = {name: scratch_path(spark, f"repaired-{name}") for name in t}
    write_parquet_all([(df, paths[n]) for n, df in t.items()])
    return {n: spark.read.parquet(p) for n, p in paths.items()}


def audit_after(spark, d):
    return AU.run_audit(written_repair(spark, d), phase="after", run_id=RUN_ID, run_at=RUN_AT, as_of=AS_OF)


def full_report(spark, d):
    """The stored report table: two runs, an older one (before only, with an
    earlier "now") and the current before + after, appended by run (K8); the
    report queries read the written table."""
    path = scratch_path(spark, "report")
    append_report(audit_before(spark, d, OLD_RUN_ID, OLD_RUN_AT, OLD_AS_OF), path)
    append_report(audit_before(spark, d).unionByName(audit_after(spark, d)), path)
    return spark.read.parquet(path)


@register("c32_audit_before", _with(VIEWS_SQL) + "\n" + _BEFORE)
def c32_audit_before(spark, d):
    """Sections 2.9 / G2 / G3: the 32 controls over the staging tables."""
    return audit_before(spark, d).select(*_OUT.split(", "))


@register("c32_audit_after", _with(VIEWS_SQL, REPAIR_SQL) + "\n" + _AFTER)
def c32_audit_after(spark, d):
    """Re-audit after the 23 repairs (phase 'after')."""
    return audit_after(spark, d).select(*_OUT.split(", "))


_CHANGES_SQL = """
SELECT 'R01' AS rule_id, COUNT(*) FILTER (WHERE mag_type IS NULL) AS changed_rows FROM earthquake
UNION ALL SELECT 'R02', COUNT(*) FILTER (WHERE place IS NULL OR trim(place, ' ') = '') FROM earthquake
UNION ALL SELECT 'R03', COUNT(*) FILTER (WHERE description IS NULL) FROM event
UNION ALL SELECT 'R04', COUNT(*) FILTER (WHERE title IS NULL OR trim(title, ' ') = '') FROM category
UNION ALL SELECT 'R05', COUNT(*) FILTER (WHERE longitude IS NULL OR latitude IS NULL) FROM eq1
UNION ALL SELECT 'R06', COUNT(*) FILTER (WHERE NOT (longitude IS NULL OR latitude IS NULL)
    AND (longitude < -180 OR longitude > 180 OR latitude < -90 OR latitude > 90)) FROM eq1
UNION ALL SELECT 'R07', COUNT(*) FILTER (WHERE NOT (longitude IS NULL OR latitude IS NULL)
    AND NOT (longitude < -180 OR longitude > 180 OR latitude < -90 OR latitude > 90)
    AND magnitude IS NOT NULL AND (magnitude < -1 OR magnitude > 10)) FROM eq1
UNION ALL SELECT 'R08', COUNT(*) FILTER (WHERE NOT (longitude IS NULL OR latitude IS NULL)
    AND NOT (longitude < -180 OR longitude > 180 OR latitude < -90 OR latitude > 90)
    AND NOT COALESCE(magnitude < -1 OR magnitude > 10, FALSE)
    AND depth_km IS NOT NULL AND depth_km < 0) FROM eq1
UNION ALL SELECT 'R09', (SELECT COUNT(*) FROM ev1) - (SELECT COUNT(*) FROM ev2)
UNION ALL SELECT 'R10', COUNT(*) FILTER (WHERE COALESCE(coordinates IS NULL OR type NOT IN ('Point', 'Polygon'), FALSE)) FROM geometry
UNION ALL SELECT 'R13', (SELECT COUNT(*) FROM geometry WHERE NOT COALESCE(coordinates IS NULL OR type NOT IN ('Point', 'Polygon'), FALSE))
                       - (SELECT COUNT(*) FROM geo2)
UNION ALL SELECT 'R11', (SELECT COUNT(*) FROM event_category) - (SELECT COUNT(*) FROM ec2)
UNION ALL SELECT 'R12', (SELECT COUNT(*) FROM event_source) - (SELECT COUNT(*) FROM es2)
UNION ALL SELECT 'R14', COUNT(*) FILTER (WHERE title <> trim(title, ' ')) FROM ev2
UNION ALL SELECT 'R16', COUNT(*) FILTER (WHERE link <> """ + _FIX_URL.format(c="link") + """) FROM ev2
UNION ALL SELECT 'R15', COUNT(*) FILTER (WHERE url <> """ + _FIX_URL.format(c="url") + """) FROM source
UNION ALL SELECT 'R17', (SELECT COUNT(*) FROM eq2) - (SELECT COUNT(*) FROM r_earthquake)
UNION ALL SELECT 'R18', (SELECT COUNT(*) FROM ev2) - (SELECT COUNT(*) FROM r_event)
UNION ALL SELECT 'R19', (SELECT COUNT(*) FROM cat1) - (SELECT COUNT(*) FROM r_category)
UNION ALL SELECT 'R20', (SELECT COUNT(*) FROM source) - (SELECT COUNT(*) FROM r_source)
UNION ALL SELECT 'R21', (SELECT COUNT(*) FROM ec2) - (SELECT COUNT(*) FROM r_event_category)
UNION ALL SELECT 'R22', (SELECT COUNT(*) FROM es2) - (SELECT COUNT(*) FROM r_event_source)
UNION ALL SELECT 'R23', (SELECT COUNT(*) FROM geo2) - (SELECT COUNT(*) FROM r_geometry)"""


@register("r23_repair_changes", _with(VIEWS_SQL, REPAIR_SQL) + """
SELECT rule_id, CAST(changed_rows AS BIGINT) AS changed_rows FROM (""" + _CHANGES_SQL + ")")
def r23_repair_changes(spark, d):
    """Section 2.10: rows changed by each of the 23 repair statements."""
    _, ch = repaired(spark, d)
    return ch.select("rule_id", "changed_rows")


def _repaired_table(name, cols):
    def q(spark, d):
        t, _ = repaired(spark, d)
        return t[name].select(*cols)
    return q


for _name, _cols in (("event", ["id", "title", "description", "link", "closed"]),
                     ("geometry", ["event_id", "date", "type", "coordinates"]),
                     ("earthquake", ["id", "time", "magnitude", "mag_type", "place", "longitude",
                                     "latitude", "depth_km"]),
                     ("event_category", ["event_id", "category_id"]),
                     ("event_source", ["event_id", "source_id"]),
                     ("source", ["id", "url"]), ("category", ["id", "title", "description"])):
    register(f"r_repaired_{_name}", _with(VIEWS_SQL, REPAIR_SQL) +
             f"\nSELECT {', '.join(_cols)} FROM r_{_name}")(_repaired_table(_name, _cols))


# ----------------------------------------------------------------- report

@register("q13_summary", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + f"""
SELECT phase, dimension, COUNT(*) AS controls, CAST(SUM(failing_rows) AS BIGINT) AS anomalies,
       COUNT(*) FILTER (WHERE failing_rows > 0) AS failed_controls
FROM report WHERE run_id = '{RUN_ID}' GROUP BY phase, dimension""")
def q13_summary(spark, d):
    return RP.summary(full_report(spark, d), RUN_ID)


_LATEST_RUN = "(SELECT run_id FROM report ORDER BY run_at DESC, run_id DESC LIMIT 1)"


@register("q14_latest_summary", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + f"""
SELECT phase, dimension, COUNT(*) AS controls, CAST(SUM(failing_rows) AS BIGINT) AS anomalies,
       COUNT(*) FILTER (WHERE failing_rows > 0) AS failed_controls
FROM report WHERE run_id = {_LATEST_RUN} GROUP BY phase, dimension""")
def q14_latest_summary(spark, d):
    return RP.summary(full_report(spark, d))


@register("q15_failing_controls", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + f"""
SELECT phase, control_id, dimension, table_name, total_rows, failing_rows,
       round(fail_rate * 100, 2) AS fail_pct
FROM report WHERE run_id = {_LATEST_RUN} AND failing_rows > 0""")
def q15_failing_controls(spark, d):
    return RP.failing_controls(full_report(spark, d)).drop("details")


@register("q16_run_history", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + """
SELECT run_id, run_at, phase, CAST(SUM(failing_rows) AS BIGINT) AS anomalies
FROM report GROUP BY run_id, run_at, phase""")
def q16_run_history(spark, d):
    return RP.run_history(full_report(spark, d))


@register("q17_extract", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + f"""
SELECT phase, dimension, control_id, table_name, total_rows, failing_rows,
       round(fail_rate * 100, 2) AS fail_pct
FROM report WHERE run_id = {_LATEST_RUN}""")
def q17_extract(spark, d):
    return RP.extract(full_report(spark, d)).drop("details")


@register("q18_by_dimension", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + """
SELECT dimension, COUNT(*) AS controls, CAST(SUM(failing_rows) AS BIGINT) AS anomalies
FROM report WHERE phase = 'before' AND table_name LIKE 'staging.%' GROUP BY dimension""")
def q18_by_dimension(spark, d):
    return RP.anomalies_by_dimension(full_report(spark, d))


@register("q19_run_details", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL) + f"""
SELECT phase, control_id, dimension, table_name, total_rows, failing_rows, fail_rate
FROM report WHERE run_id = '{RUN_ID}'""")
def q19_run_details(spark, d):
    return RP.run_details(full_report(spark, d), RUN_ID).drop("details")


_PER_CONTROL_SQL = f"""per AS (
  SELECT control_id, table_name,
         SUM(CASE WHEN phase = 'before' THEN failing_rows END) AS b,
         SUM(CASE WHEN phase = 'after' THEN failing_rows END) AS a
  FROM report WHERE run_id = {_LATEST_RUN} GROUP BY control_id, table_name)"""


@register("q24_before_after", _with(VIEWS_SQL, REPAIR_SQL, REPORT_SQL, _PER_CONTROL_SQL) + """
SELECT CAST(SUM(b) AS BIGINT) AS anomalies_before, CAST(SUM(a) AS BIGINT) AS anomalies_after,
       CAST(SUM(b - a) AS BIGINT) AS resolved,
       CASE WHEN SUM(b) = 0 THEN NULL
            ELSE CAST((2 * SUM(b - a) * 10000 + SUM(b)) // (2 * SUM(b)) AS DOUBLE) / 10000 END AS resolution_rate
FROM per WHERE a IS NOT NULL AND b IS NOT NULL""")
def q24_before_after(spark, d):
    return RP.before_after(full_report(spark, d))
