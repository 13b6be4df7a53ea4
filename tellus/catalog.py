"""Registered queries over the driver tables (``queries()`` / ``oracle_sql()``).

Every generic operator of the library is parameterised here onto the
TPC-H-like test tables, named after its inventory ID. Each entry is a pair:
a Spark plan built with ``tellus`` operators and an independent, hand
written ANSI SQL query (DuckDB dialect) computing the same result, used as
the correctness oracle. All queries read whole tables.

Mapping conventions
-------------------
* points: ``events`` rows with a derived position
  lon = ((event_id * 7919) % 36000) / 100 - 180,
  lat = ((event_id * 104729) % 18000) / 100 - 90;
  error, view and signup rows play the hazard events, purchase and click
  rows the earthquakes, so the matches read every row.
* link / dimension: ``lineitem`` -> ``part`` / ``orders``;
  parent / child: ``orders`` -> ``lineitem``, ``customer`` -> ``orders``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators import aggregates as A
from tellus.operators import dedup as D
from tellus.operators import match as M
from tellus.operators import merge as MG
from tellus.operators import referential as RF
from tellus.operators import validate as V
from tellus.plans import audit as AU
from tellus.plans import marts as Q

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

# Fixed parameters of the registered queries.
AS_OF = "2000-01-01 00:00:00"
RUN_ID = "run-0001"
RUN_AT = "2000-01-02 00:00:00"
MAX_KM = 500.0
MAX_HOURS = 168.0
#: The event types that play either side of a match; together they are all.
LEFT, RIGHT = ("error", "view", "signup"), ("purchase", "click")


def _naive_timestamps(df: DataFrame) -> DataFrame:
    """Return timestamps as UTC wall-clock ``timestamp_ntz`` (what the SQL
    oracle's TIMESTAMP holds), so results do not depend on the caller's
    session or Python time zone."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, d: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _naive_timestamps(fn(spark, d))
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql.strip()
        return fn
    return deco


def _load_all():
    # registering modules; imported lazily to avoid an import cycle
    from tellus import catalog_evidence, catalog_feeds, catalog_hazard, catalog_loads, catalog_stream  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------- derived inputs

def points(spark: SparkSession, d: str, kinds=LEFT + RIGHT, id_col: str = "event_id") -> DataFrame:
    """events of some types with derived coordinates (see module doc)."""
    e = table(spark, d, "events")
    if set(kinds) != set(LEFT + RIGHT):
        e = e.filter(F.col("event_type").isin(*kinds))
    lon = ((F.col("event_id") * 7919) % 36000).cast("double") / 100 - 180
    lat = ((F.col("event_id") * 104729) % 18000).cast("double") / 100 - 90
    return e.select(
        F.col(id_col).alias("id"), F.col("event_id"), F.col("ts").cast("timestamp").alias("ts"),
        lon.alias("lon"), lat.alias("lat"), F.col("value"), F.col("props"), F.col("event_type"))


_PTS_SQL = """
  SELECT {id} AS id, event_id, ts, value, props, event_type,
         CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 AS lon,
         CAST((event_id * 104729) % 18000 AS DOUBLE) / 100 - 90 AS lat
  FROM events WHERE event_type IN {kinds}"""


def _pts_sql(kinds=LEFT + RIGHT, id_col: str = "event_id") -> str:
    return _PTS_SQL.format(id=id_col, kinds=tuple(kinds))


_HAV_SQL = """6371.0 * 2 * asin(sqrt(pow(sin(radians(q.lat - e.lat) / 2), 2)
          + cos(radians(e.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - e.lon) / 2), 2)))"""

# brute-force candidate pairs (oracle only): time band, then distance
_PAIRS_SQL = f"""
  pairs AS (
    SELECT e.id AS l_id, q.id AS r_id,
           CAST(floor(epoch(q.ts)) - floor(epoch(e.ts)) AS BIGINT) AS delay_seconds,
           {_HAV_SQL} AS dist
    FROM e JOIN q
      ON abs((floor(epoch(q.ts)) - floor(epoch(e.ts))) / 3600.0) <= {MAX_HOURS}
  ),
  hits AS (SELECT * FROM pairs WHERE dist <= {MAX_KM})"""


def _tasks(spark: SparkSession) -> int:
    # the test tables are one file with one row group each: spread them
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def matches(spark: SparkSession, d: str, left_id: str = "event_id", **labels) -> DataFrame:
    return match_points(spark, points(spark, d, LEFT, left_id), points(spark, d, RIGHT), **labels)


def match_points(spark: SparkSession, ev: DataFrame, qk: DataFrame, **labels) -> DataFrame:
    return M.match_pairs(ev, qk, max_km=MAX_KM, max_hours=MAX_HOURS, partitions=_tasks(spark),
                         left_id="id", left_ts="ts", left_lon="lon", left_lat="lat",
                         right_id="id", right_ts="ts", right_lon="lon", right_lat="lat", **labels)


def _labelled_matches(spark: SparkSession, d: str):
    return lambda left, right: matches(spark, d, left_labels=left, right_labels=right)


def _match_sql(left_id: str = "event_id") -> str:
    return f"""WITH e AS ({_pts_sql(LEFT, left_id)}),
  q AS ({_pts_sql(RIGHT)}),{_PAIRS_SQL},
  best AS (
    SELECT *, row_number() OVER (PARTITION BY l_id, r_id
             ORDER BY dist, abs(delay_seconds), delay_seconds) AS rn
    FROM hits)"""


# ================================================================ marts

@register("q07_daily_counts", """
WITH g AS (SELECT * FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL),
l AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY event_id
        ORDER BY ts DESC NULLS FIRST, user_id DESC NULLS FIRST) = 1)
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, COUNT(*) AS event_count
FROM l GROUP BY 1""")
def q07_daily_counts(spark, d):
    """Minimum slice: typed scan -> required-field gate (F1) -> latest-wins
    dedup (W1) -> per-day count (P15 + A4)."""
    e = table(spark, d, "events").filter(P.all_not_null("event_id", "ts"))
    e = D.latest(e, ["event_id"], ["ts", "user_id"], total=True)
    return Q.daily_counts(e, "ts", label="day", name="event_count")


@register("q01_open_count", """
SELECT COUNT(*) AS open_orders FROM (
  SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed FROM orders) t
WHERE closed IS NULL""")
def q01_open_count(spark, d):
    o = table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("closed"))
    return Q.open_count(o, "closed", name="open_orders")


@register("q02_row_count", "SELECT COUNT(*) AS row_count FROM lineitem")
def q02_row_count(spark, d):
    return Q.row_count(table(spark, d, "lineitem"), name="row_count")


@register("q03_max_value", "SELECT MAX(value) AS max_value FROM events")
def q03_max_value(spark, d):
    return Q.max_value(table(spark, d, "events"), "value", name="max_value")


@register("q04_match_count", _match_sql() + """
SELECT COUNT(*) AS match_count FROM best WHERE rn = 1""")
def q04_match_count(spark, d):
    return Q.row_count(matches(spark, d), name="match_count")


@register("q05_count_by_title", """
SELECT p.p_brand AS brand, COUNT(*) AS line_count
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY p.p_brand""")
def q05_count_by_title(spark, d):
    return Q.count_by_title(table(spark, d, "lineitem"), table(spark, d, "part"),
                            link_key="l_partkey", dim_key="p_partkey", title="p_brand",
                            label="brand", name="line_count")


@register("q06_band_counts", """
SELECT CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ' - ' ||
       CAST(CAST(floor(value) AS BIGINT) + 1 AS VARCHAR) AS band,
       COUNT(*) AS event_count
FROM events WHERE value IS NOT NULL GROUP BY floor(value)""")
def q06_band_counts(spark, d):
    return Q.band_counts(table(spark, d, "events"), "value", label="band", name="event_count")


@register("q08_above_threshold", f"""
SELECT event_id AS id, event_type, value, lat, lon FROM ({_pts_sql()}) p
WHERE value >= 5.0""")
def q08_above_threshold(spark, d):
    return Q.above_threshold(points(spark, d), "value", 5.0,
                             cols=("id", "event_type", "value", "lat", "lon"))


@register("q09_point_locations", """
WITH g AS (
  SELECT user_id AS event_id, ts AS date,
         CASE WHEN event_type = 'view' THEN 'Polygon' ELSE 'Point' END AS type,
         CAST((event_id * 7919) % 36000 AS DOUBLE) / 100 - 180 AS lon,
         CAST((event_id * 104729) % 18000 AS DOUBLE) / 100 - 90 AS lat
  FROM events)
SELECT c.c_custkey AS id, c.c_name AS title, g.lon AS longitude, g.lat AS latitude, g.date
FROM customer c JOIN g ON g.event_id = c.c_custkey
WHERE g.type = 'Point'""")
def q09_point_locations(spark, d):
    e = table(spark, d, "events")
    lon = ((F.col("event_id") * 7919) % 36000).cast("double") / 100 - 180
    lat = ((F.col("event_id") * 104729) % 18000).cast("double") / 100 - 90
    # geometry rows carry their position as JSON text, parsed back by Q09
    geo = e.select(F.col("user_id").alias("event_id"), F.col("ts").alias("date"),
                   F.when(F.col("event_type") == "view", "Polygon").otherwise("Point").alias("type"),
                   F.to_json(F.array(lon, lat)).alias("coordinates"))
    parent = table(spark, d, "customer").select(F.col("c_custkey").alias("id"),
                                                F.col("c_name").alias("title"))
    return Q.point_locations(parent, geo)


@register("j03_spacetime_match", _match_sql() + """
SELECT l_id AS event_id, r_id AS earthquake_id, round(dist, 2) AS distance_km, delay_seconds
FROM best WHERE rn = 1""")
def j03_spacetime_match(spark, d):
    return matches(spark, d).select("event_id", "earthquake_id", "distance_km", "delay_seconds")


@register("d04_one_match_per_pair", _match_sql("user_id") + """
SELECT l_id AS event_id, r_id AS earthquake_id, round(dist, 2) AS distance_km, delay_seconds
FROM best WHERE rn = 1""")
def d04_one_match_per_pair(spark, d):
    """Left ids are users with many points each: one row per (user, quake),
    nearest point first, then smallest absolute delay."""
    return matches(spark, d, "user_id").select("event_id", "earthquake_id", "distance_km",
                                               "delay_seconds")


@register("j01_time_band_join", f"""
WITH e AS ({_pts_sql(LEFT)}), q AS ({_pts_sql(RIGHT)})
SELECT e.id AS l_id, COUNT(*) AS pairs, MIN(q.id) AS first_id,
       CAST(SUM(floor(epoch(q.ts)) - floor(epoch(e.ts))) AS BIGINT) AS delay_seconds,
       CAST(SUM(CAST(floor(epoch(q.ts)) - floor(epoch(e.ts)) + 1000 AS BIGINT) * q.id % 1000003) AS BIGINT) AS digest
FROM e JOIN q ON abs((floor(epoch(q.ts)) - floor(epoch(e.ts))) / 3600.0) <= 0.25 GROUP BY e.id""")
def j01_time_band_join(spark, d):
    """Temporal band join alone (15 minutes), as a bucketed equi-join;
    the pairs are counted per left id, and a digest holds each right id with
    its delay."""
    out = M.time_band_join(points(spark, d, LEFT), points(spark, d, RIGHT), max_hours=0.25,
                           left_id="id", left_ts="ts", right_id="id", right_ts="ts", partitions=_tasks(spark))
    return out.groupBy("l_id").agg(F.count("*").alias("pairs"), F.min("r_id").alias("first_id"),
                                   F.sum("delay_seconds").alias("delay_seconds"),
                                   F.sum((F.col("delay_seconds") + 1000) * F.col("r_id") % 1000003).alias("digest"))


@register("j02_radius_join", f"""
WITH e AS ({_pts_sql(LEFT)}), q AS ({_pts_sql(RIGHT)}),
p AS (SELECT e.id AS l_id, q.id AS r_id, {_HAV_SQL} AS dist FROM e, q)
SELECT l_id, COUNT(*) AS pairs, MIN(r_id) AS first_id, round(MIN(dist), 2) AS distance_km,
       CAST(SUM(CAST(floor(dist * 1000) AS BIGINT) * r_id % 1000003) AS BIGINT) AS digest
FROM p WHERE dist <= 100.0 GROUP BY l_id""")
def j02_radius_join(spark, d):
    """Spatial radius join alone (100 km, any time); the pairs are
    counted per left id, and a digest holds each right id with its distance
    in metres."""
    out = M.radius_join(points(spark, d, LEFT), points(spark, d, RIGHT), max_km=100.0,
                        left_id="id", left_lon="lon", left_lat="lat",
                        right_id="id", right_lon="lon", right_lat="lat", partitions=_tasks(spark))
    return out.groupBy("l_id").agg(F.count("*").alias("pairs"), F.min("r_id").alias("first_id"),
                                   F.round(F.min("distance_km"), 2).alias("distance_km"),
                                   F.sum(F.floor(F.col("distance_km") * 1000) * F.col("r_id") % 1000003).alias("digest"))


@register("q10_match_details", _match_sql() + """
SELECT e.event_type || '#' || CAST(e.event_id AS VARCHAR) AS event_title,
       q.props AS quake_place, q.value AS magnitude, round(b.dist, 2) AS distance_km,
       b.delay_seconds, q.ts AS quake_time
FROM best b JOIN e ON e.id = b.l_id JOIN q ON q.id = b.r_id WHERE b.rn = 1""")
def q10_match_details(spark, d):
    ev = points(spark, d, LEFT).select(
        "id", F.concat_ws("#", "event_type", F.col("event_id").cast("string")).alias("title"))
    qk = points(spark, d, RIGHT).select("id", F.col("props").alias("place"),
                                             F.col("value").alias("magnitude"),
                                             F.col("ts").alias("time"))
    return Q.match_details(_labelled_matches(spark, d), ev, qk,
                           measures=("distance_km", "delay_seconds"))


@register("q11_match_triples", _match_sql() + """
SELECT round(b.dist, 2) AS distance_km, b.delay_seconds, q.value AS magnitude
FROM best b JOIN q ON q.id = b.r_id WHERE b.rn = 1""")
def q11_match_triples(spark, d):
    qk = points(spark, d, RIGHT).select("id", F.col("value").alias("magnitude"))
    return Q.match_triples(_labelled_matches(spark, d), qk, measures=("distance_km", "delay_seconds"))


@register("q12_flagged_sorted", """
SELECT event_type AS place, value AS magnitude, ts AS time, user_id, event_id
FROM events WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) > 90""")
def q12_flagged_sorted(spark, d):
    e = table(spark, d, "events").withColumn(
        "flag", F.get_json_object("props", "$.k").cast("int") > 90)
    e = e.select(F.col("event_type").alias("place"), F.col("value").alias("magnitude"),
                 F.col("ts").alias("time"), "user_id", "event_id", "flag")
    return Q.flagged_sorted(e, "flag", "magnitude",
                            cols=("place", "magnitude", "time", "user_id", "event_id"))


_ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


@register("q20_row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _ALL_TABLES))
def q20_row_counts(spark, d):
    return Q.row_counts({t: table(spark, d, t) for t in _ALL_TABLES})


@register("q25_open_per_category", """
SELECT p.p_brand AS category, COUNT(*) AS open_events
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'F')
GROUP BY p.p_brand""")
def q25_open_per_category(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("closed"))
    link = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"),
                                              F.col("l_partkey").alias("category_id"))
    dim = table(spark, d, "part").select(F.col("p_partkey").alias("id"),
                                         F.col("p_brand").alias("title"))
    return Q.open_per_category(o, link, dim)


# ======================================================= dedup / windows

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
_LI_ORDER_SQL = ("l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS FIRST, "
                 "l_suppkey DESC NULLS FIRST, l_extendedprice DESC NULLS FIRST")


@register("w01_latest_per_key", """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1""")
def w01_latest_per_key(spark, d):
    """Latest row per user (ts desc, event_id desc)."""
    return D.latest(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], total=True)


@register("d02_dedup_null_keys", f"""
WITH t AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linenumber END AS line,
                  l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem)
SELECT * FROM t WHERE line IS NULL
UNION ALL
SELECT * FROM t WHERE line IS NOT NULL AND l_orderkey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY l_orderkey, line ORDER BY {_LI_ORDER_SQL}) = 1""")
def d02_dedup_null_keys(spark, d):
    """Duplicate keys removed (last row kept), rows with a
    NULL key never removed."""
    t = table(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") == "R", F.lit(None))
                       .otherwise(F.col("l_linenumber")).alias("line"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    return D.dedup_keys(t, ["l_orderkey", "line"], order_by=_LI_ORDER)


@register("d03_distinct_rows", """
SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem""")
def d03_distinct_rows(spark, d):
    return D.distinct_rows(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"))


@register("o05_top_k_recent", """
SELECT event_id, ts, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND value >= 4.5
ORDER BY ts DESC, event_id DESC LIMIT 500""")
def o05_top_k_recent(spark, d):
    """Collection window (time range, minimum value), most recent
    first, limited - the limit is the feature (top-k)."""
    e = table(spark, d, "events").filter(
        (F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
        & (F.col("value") >= 4.5))
    return (e.select("event_id", "ts", "event_type", "value")
             .orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(500))


# ============================================================ aggregates

@register("a06_duplicate_surplus", """
SELECT CAST(SUM(c) AS BIGINT) AS total_rows,
       CAST(COALESCE(SUM(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) AS failing_rows
FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber) t""")
def a06_duplicate_surplus(spark, d):
    return A.duplicate_surplus(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("a06_text_duplicates", """
SELECT CAST(SUM(c) AS BIGINT) AS total_rows,
       CAST(COALESCE(SUM(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) AS failing_rows
FROM (SELECT COUNT(*) AS c FROM documents GROUP BY text) t""")
def a06_text_duplicates(spark, d):
    """U04/U05 shape on whole document texts (NULL text is one group). The
    texts are grouped by a 256-bit hash, so they are not shuffled."""
    t = table(spark, d, "documents").select(F.sha2("text", 256).alias("hash"), F.octet_length("text").alias("size"))
    return A.duplicate_surplus(t, ["hash", "size"])


@register("a07_fuzzy_duplicates", """
SELECT CAST(SUM(c) AS BIGINT) AS total_rows,
       CAST(COALESCE(SUM(CASE WHEN c > 1 THEN c - 1 END), 0) AS BIGINT) AS failing_rows
FROM (SELECT COUNT(*) AS c FROM lineitem
      GROUP BY date_trunc('minute', l_shipdate), round(CAST(l_discount AS DECIMAL(18,6)), 1),
               round(CAST(l_tax AS DECIMAL(18,6)), 1), round(CAST(l_quantity AS DECIMAL(18,6)), 1)) t""")
def a07_fuzzy_duplicates(spark, d):
    """U03 shape: same minute, rounded 'lat/lon/magnitude' stand-ins."""
    li = table(spark, d, "lineitem")
    return A.duplicate_surplus(li, A.fuzzy_keys("l_shipdate", "l_discount", "l_tax", "l_quantity"))


@register("a08_group_measures", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
       CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
       COUNT(*) FILTER (WHERE l_discount >= 0.05) AS n_discounted
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a08_group_measures(spark, d):
    """Count, sum and filtered count per group."""
    return (table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"),
                 F.count_if(F.col("l_discount") >= 0.05).alias("n_discounted")))


# ====================================================== referential joins

def _customers_kept(spark, d):
    return table(spark, d, "customer").filter(F.col("c_mktsegment") != "BUILDING")


@register("j07_orphans", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey
                  AND c.c_mktsegment <> 'BUILDING')""")
def j07_orphans(spark, d):
    """Orders whose customer is not among the kept customers."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return RF.orphans(o, _customers_kept(spark, d), "o_custkey", "c_custkey")


@register("i01_orphan_counts", """
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM part p
            WHERE p.p_partkey = l.l_partkey AND p.p_size <= 40)) AS BIGINT) AS failing_rows
FROM lineitem l""")
def i01_orphan_counts(spark, d):
    """I01-I05 measure: child rows and orphans in one child scan."""
    parts = table(spark, d, "part").filter(F.col("p_size") <= 40)
    return AU.orphan_counts(table(spark, d, "lineitem"), parts, "l_partkey", "p_partkey")


@register("j08_all_parents", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority <> '1-URGENT')
  AND EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 40)""")
def j08_all_parents(spark, d):
    """A child is kept only when every parent exists."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    o = table(spark, d, "orders").filter(F.col("o_orderpriority") != "1-URGENT")
    p = table(spark, d, "part").filter(F.col("p_size") <= 40)
    return RF.with_all_parents(li, [(o, "l_orderkey", "o_orderkey"), (p, "l_partkey", "p_partkey")])


@register("j10_before_first_child", """
SELECT o.o_orderkey, o.o_orderdate FROM orders o
WHERE o.o_orderdate IS NOT NULL
  AND o.o_orderdate < (SELECT MIN(l.l_shipdate) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def j10_before_first_child(spark, d):
    """J10 / Co01: orders dated before their first shipment."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return RF.before_first_child(o, table(spark, d, "lineitem"), parent_key="o_orderkey",
                                 parent_ts="o_orderdate", child_key="l_orderkey",
                                 child_ts="l_shipdate", child_ts_is_text=False)


@register("co01_coherence_counts", """
SELECT CAST(COUNT(*) FILTER (WHERE o.o_orderdate IS NOT NULL) AS BIGINT) AS total_rows,
       CAST(COUNT(*) FILTER (WHERE o.o_orderdate IS NOT NULL AND o.o_orderdate <
            (SELECT MIN(CAST(l.l_shipdate AS VARCHAR)::TIMESTAMP) FROM lineitem l
             WHERE l.l_orderkey = o.o_orderkey)) AS BIGINT) AS failing_rows
FROM orders o""")
def co01_coherence_counts(spark, d):
    """Co01 measure with the child time stored as text (parsed safely)."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", F.col("l_shipdate").cast("string").alias("l_shipdate"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"),
                                         F.col("o_orderdate").alias("closed"))
    m = AU.closed_before_first_point("event", "geometry", parent_key="id", parent_ts="closed",
                                     child_key="l_orderkey", child_ts="l_shipdate")
    return m({"event": o, "geometry": li}, F.current_timestamp())


@register("j14_cascade", """
SELECT l_orderkey, l_linenumber FROM lineitem l
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')""")
def j14_cascade(spark, d):
    """J14 CASCADE: deleting orders in status P removes their lines."""
    kept = table(spark, d, "orders").filter(F.col("o_orderstatus") != "P")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return RF.with_parent(li, kept, "l_orderkey", "o_orderkey")


@register("j14_restrict", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE o.o_orderstatus = 'P'
  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def j14_restrict(spark, d):
    """J14 RESTRICT: of the orders proposed for deletion (status P), those
    that no line references (the others must stay)."""
    cand = (table(spark, d, "orders").filter(F.col("o_orderstatus") == "P")
            .select("o_orderkey", "o_custkey"))
    return RF.restrict(cand, table(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


# ================================================================ merge

def _merge_inputs(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_totalprice", "o_orderpriority")
    base = o.filter(F.col("o_orderstatus").isin("F", "O"))
    delta = (o.filter(F.col("o_orderstatus").isin("O", "P"))
              .withColumn("o_orderpriority", F.concat(F.lit("new-"), "o_orderpriority")))
    return base, delta


_MERGE_SQL = """
WITH base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 0 AS src
              FROM orders WHERE o_orderstatus IN ('F', 'O')),
delta AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                 'new-' || o_orderpriority AS o_orderpriority, 1 AS src
          FROM orders WHERE o_orderstatus IN ('O', 'P')),
u AS (SELECT * FROM base UNION ALL SELECT * FROM delta)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM u
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY src {dir}) = 1"""


@register("j09_merge_update", _MERGE_SQL.format(dir="DESC"))
def j09_merge_update(spark, d):
    """J9 last writer wins (ON CONFLICT DO UPDATE)."""
    base, delta = _merge_inputs(spark, d)
    return MG.merge(base, delta, ["o_orderkey"], on_match="update")


@register("j09_merge_ignore", _MERGE_SQL.format(dir="ASC"))
def j09_merge_ignore(spark, d):
    """J9 first writer wins (ON CONFLICT DO NOTHING)."""
    base, delta = _merge_inputs(spark, d)
    return MG.merge(base, delta, ["o_orderkey"], on_match="ignore")


# ========================================================== validation

def _li_rules():
    return [V.between("l_quantity", 1, 49), V.Rule("max_discount", F.col("l_discount") <= 0.09),
            V.one_of("l_returnflag", ["A", "N"]), *V.not_null("l_shipdate")]


def _validated(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").filter(F.col("o_orderpriority") != "1-URGENT")
    return V.validate(li, _li_rules(), key=["l_orderkey"],
                      key_order=["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
                                 "l_extendedprice"],
                      parents=[("orders", o, "l_orderkey", "o_orderkey")])


_VALID_SQL = """
WITH r AS (
  SELECT l.*, list_filter([
      CASE WHEN NOT COALESCE(l_quantity BETWEEN 1 AND 49, TRUE) THEN 'range:l_quantity' END,
      CASE WHEN NOT COALESCE(l_discount <= 0.09, TRUE) THEN 'max_discount' END,
      CASE WHEN NOT COALESCE(l_returnflag IN ('A', 'N'), TRUE) THEN 'one_of:l_returnflag' END,
      CASE WHEN l_shipdate IS NULL THEN 'not_null:l_shipdate' END,
      CASE WHEN l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o
             WHERE o.o_orderkey = l.l_orderkey AND o.o_orderpriority <> '1-URGENT')
           THEN 'missing_parent:orders' END], lambda x: x IS NOT NULL) AS reasons
  FROM lineitem l),
ok AS (SELECT * FROM r WHERE len(reasons) = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC NULLS FIRST,
             l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST,
             l_extendedprice DESC NULLS FIRST) AS rn FROM ok)"""


@register("x01_validate_rejected", _VALID_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(reasons, ',') AS reasons
FROM r WHERE len(reasons) > 0
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, 'duplicate_key' FROM ranked WHERE rn > 1""")
def x01_validate_rejected(spark, d):
    """Section 2.12: quarantine with reasons (row rules, PK, FK)."""
    _, bad = _validated(spark, d)
    return bad.select("l_orderkey", "l_linenumber", "l_partkey",
                      F.array_join("reasons", ",").alias("reasons"))


@register("x02_validate_accepted", _VALID_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey FROM ranked WHERE rn = 1""")
def x02_validate_accepted(spark, d):
    ok, _ = _validated(spark, d)
    return ok.select("l_orderkey", "l_linenumber", "l_partkey")


@register("a16_load_counts", _VALID_SQL + """
SELECT CAST((SELECT COUNT(*) FROM ranked WHERE rn = 1) AS BIGINT) AS processed,
       CAST((SELECT COUNT(*) FROM r WHERE len(reasons) > 0)
            + (SELECT COUNT(*) FROM ranked WHERE rn > 1) AS BIGINT) AS failed""")
def a16_load_counts(spark, d):
    ok, bad = _validated(spark, d)
    return V.load_counts(ok, bad)


# ============================================================ corrections

@register("r16_add_https", """
WITH t AS (SELECT page_id, regexp_replace(url, '^http://', '') AS url FROM pages)
SELECT page_id, url AS url_before,
       CASE WHEN url IS NOT NULL AND NOT regexp_matches(url, '^https?://')
                 AND regexp_matches(url, '^[a-zA-Z0-9]') THEN 'https://' || url ELSE url END AS url_after
FROM t""")
def r16_add_https(spark, d):
    """R15 / R16 on page addresses whose http:// scheme was stripped."""
    t = table(spark, d, "pages").select("page_id", F.regexp_replace("url", "^http://", "").alias("url"))
    return t.select("page_id", F.col("url").alias("url_before"), S.add_https("url").alias("url_after"))
