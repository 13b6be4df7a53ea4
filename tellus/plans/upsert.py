"""Incremental upsert of feed records into the clean tables (entry 5: J9,
S5, A16, section 2.12 per-record isolation).

One call applies a whole batch set-wise:

1. reference categories / sources: last writer wins (ON CONFLICT DO UPDATE);
   a source's address falls back to its second field, rows without one are
   skipped;
2. every event record is checked *as a unit*: the event row and all its
   embedded categories, sources and geometry must satisfy the clean-table
   constraints, otherwise the whole record is rejected and counted as a
   failure (the per-event transaction of the row-at-a-time worker);
3. accepted events: last writer wins for the event row; embedded categories,
   sources, links and geometry are inserted only when their key is absent
   (ON CONFLICT DO NOTHING).

The record check uses higher-order functions over the record's arrays, so
it is one projection; merges are the skew-safe union + grouped pick.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellus.functions import scalars as S
from tellus.functions.predicates import URL_PATTERN
from tellus.operators.merge import merge
from tellus.sources import sinks as K

_ORDER = "_seq"


def _id_ok(c: Column) -> Column:
    return c.isNotNull() & (F.length(c) <= 50)


def _title_ok(c: Column, most: int) -> Column:
    return c.isNotNull() & (F.length(F.trim(c)) > 0) & (F.length(c) <= most)


def _url_ok(c: Column) -> Column:
    return c.isNotNull() & c.rlike(URL_PATTERN) & (F.length(c) <= 255)


def _filled(c: Column) -> Column:
    """NULL for the empty text."""
    return F.nullif(c, F.lit(""))


def _category_title(c: Column) -> Column:
    """The title, or the id where it is missing or empty. A title of
    spaces stays and fails the table's check."""
    return F.coalesce(_filled(c["title"]), c["id"])


def _geometry_ok(g: Column) -> Column:
    arr = F.from_json(g["coordinates"], "array<double>")
    n = F.json_array_length(g["coordinates"])
    point = ((n == 2) & F.get(arr, F.lit(0)).between(-180, 180)
             & F.get(arr, F.lit(1)).between(-90, 90))
    shape = (F.when(g["type"] == "Point", F.coalesce(point, F.lit(False)))
              .when(g["type"] == "Polygon", n.isNotNull()).otherwise(F.lit(False)))
    return (g["type"].isin("Point", "Polygon") & F.try_to_timestamp(g["date"]).isNotNull()
            & g["coordinates"].isNotNull() & shape)


def record_ok(rec: DataFrame) -> Column:
    """True when every row one event record would insert is valid. A source
    without an address (missing or empty) would not be inserted."""
    cats = F.coalesce(F.col("categories"), F.array())
    srcs = F.coalesce(F.col("sources"), F.array())
    geos = F.coalesce(F.col("geometry"), F.array())
    return (_id_ok(F.col("id")) & _title_ok(F.col("title"), 255) & _url_ok(F.col("link"))
            & F.forall(cats, lambda c: _id_ok(c["id"]) & _title_ok(_category_title(c), 100))
            & F.forall(srcs, lambda s: _filled(s["url"]).isNull() | (_id_ok(s["id"]) & _url_ok(s["url"])))
            & F.forall(geos, _geometry_ok))


def sync(tables: Mapping[str, DataFrame], events: DataFrame, *,
         categories: DataFrame | None = None, sources: DataFrame | None = None,
         order: str = _ORDER, checkpoint: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Apply one batch. ``events`` are parsed records (``schemas.EVENT_RECORD``)
    with an ordering column ``order`` (arrival order; later wins for DO
    UPDATE, earlier wins for DO NOTHING). ``categories`` / ``sources`` are
    reference rows (``id, title, description`` / ``id, url, source``).

    With ``checkpoint`` the checked records are written once to the shared
    checkpoint folder, where all tables and counts read the columns they
    need; without it each of them parses and checks the records again.

    Returns ``(tables, counts)`` with counts ``(processed, failed)``.
    """
    out = dict(tables)
    if categories is not None:
        ob = [order] if order in categories.columns else []
        c = categories.select("id", "title", "description", *ob)
        out["category"] = _upsert(out["category"], c, ["id"], ob)
    if sources is not None:
        ob = [order] if order in sources.columns else []
        url = F.coalesce(F.nullif(F.col("url"), F.lit("")), F.nullif(F.col("source"), F.lit("")))
        s = sources.select("id", url.alias("url"), *ob).filter(F.col("url").isNotNull())
        out["source"] = _upsert(out["source"], s, ["id"], ob)

    ok = events.withColumn("_ok", F.coalesce(record_ok(events), F.lit(False)))
    if checkpoint:
        cols = ["id", "title", "description", "link", "closed", "categories", "sources", "geometry"]
        ok = K.materialize(ok.sparkSession, ok.select(*cols, *([] if order in cols else [order]), "_ok"), "records")
    counts = ok.agg(F.count_if("_ok").cast("long").alias("processed"),
                    F.count_if(~F.col("_ok")).cast("long").alias("failed"))
    # no filter goes below what is exploded: the check would parse the record anew for each field that it reads, and
    # below the shuffle of the records, which the tables then could not share
    kept = list(dict.fromkeys(["id", "title", "description", "link", "closed", "categories", "sources", "geometry", order]))
    good = ok.select(F.explode(F.array(F.struct("_ok", *kept))).alias("_g")).filter("_g._ok").select("_g.*")

    ev = good.select("id", "title", "description", "link", S.parse_ts("closed").alias("closed"), order)
    out["event"] = merge(out["event"].withColumn(order, F.lit(None).cast(ev.schema[order].dataType)),
                         ev, ["id"], on_match="update", order_by=[order]).drop(order)

    cat = good.select(order, F.explode("categories").alias("c")).select(
        F.col("c.id").alias("id"), _category_title(F.col("c")).alias("title"),
        S.typed_null("string").alias("description"), order)
    out["category"] = _insert_new(out["category"], cat, ["id"], order)
    ec = good.select("id", order, F.explode("categories").alias("c")).select(
        F.col("id").alias("event_id"), F.col("c.id").alias("category_id"), order)
    out["event_category"] = _insert_new(out["event_category"], ec, ["event_id", "category_id"], order)

    src = (good.select("id", order, F.explode("sources").alias("s"))
               .filter(_filled(F.col("s.url")).isNotNull()))
    out["source"] = _insert_new(out["source"], src.select(F.col("s.id").alias("id"),
                                                          F.col("s.url").alias("url"), order),
                                ["id"], order)
    es = src.select(F.col("id").alias("event_id"), F.col("s.id").alias("source_id"), order)
    out["event_source"] = _insert_new(out["event_source"], es, ["event_id", "source_id"], order)

    geo = good.select("id", order, F.explode("geometry").alias("g")).select(
        F.col("id").alias("event_id"), S.parse_ts("g.date").alias("date"),
        F.col("g.type").alias("type"), F.col("g.coordinates").alias("coordinates"), order)
    cur = out["geometry"].withColumn("_canon", S.canonical_json("coordinates"))
    new = geo.withColumn("_canon", S.canonical_json("coordinates"))
    out["geometry"] = _insert_new(cur, new, ["event_id", "date", "_canon"], order).drop("_canon")
    return out, counts


def _upsert(target: DataFrame, rows: DataFrame, keys, order_by) -> DataFrame:
    """ON CONFLICT DO UPDATE: among new rows with one key the latest by
    ``order_by`` wins, and it replaces the existing row."""
    if not order_by:
        return merge(target, rows, list(keys), on_match="update")
    o = order_by[0]
    t = target.withColumn(o, F.lit(None).cast(rows.schema[o].dataType))
    return merge(t, rows.select(*t.columns), list(keys), on_match="update", order_by=[o]).drop(o)


def _insert_new(target: DataFrame, rows: DataFrame, keys, order: str) -> DataFrame:
    """ON CONFLICT DO NOTHING: existing keys stay, among new rows with one
    key the earliest by ``order`` is inserted."""
    t = target.withColumn(order, F.lit(None).cast(rows.schema[order].dataType))
    return merge(t, rows.select(*t.columns), list(keys), on_match="ignore", order_by=[order]).drop(order)
