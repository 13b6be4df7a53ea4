"""Batch clean-and-load job (entry 1: K4, K5, K7, P*, F*, D*, J3).

``stage(events, quakes)`` projects the raw feed records into the seven
staging tables (all rows, before any filter); ``clean(events, quakes)``
applies the required-field gates, normalisation and deterministic
deduplication to produce the clean tables, and ``run`` adds the
spatio-temporal match. Clean rows that break a constraint of their table
(``plans/rules.py``) go to the quarantine with their reasons.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators import dedup as D
from tellus.operators.match import match_pairs
from tellus.operators.referential import with_parent
from tellus.operators.validate import validate
from tellus.plans.rules import PARENTS, table_rules
from tellus.schemas import EVENT_RECORD, INGESTED_AT, QUAKE_RECORD
from tellus.sources.feeds import empty_feed

#: Latest first: landing time, then the arrival position where the feed has
#: one, then a hash of the record's text (8 bytes; the text itself is not
#: carried on).
ORDER = [INGESTED_AT, "_seq", "_rec"]


def _slim(df: DataFrame) -> DataFrame:
    """A feed without its text: the hash of the text orders equal times."""
    if "_raw" in df.columns:
        df = df.withColumn("_rec", F.xxhash64("_raw"))
    return df.drop("_raw", "_file", "_corrupt")


def _order(df: DataFrame) -> list[str]:
    return [c for c in ORDER if c in df.columns]


def _meta(df: DataFrame) -> list[str]:
    return _order(df)


def _explode(df: DataFrame, arr: str, parent: bool = True) -> DataFrame:
    """Unnest an array of structs, NULL elements dropped, parent key and
    ordering metadata kept."""
    cols = ([F.col("id").alias("event_id")] if parent else []) + [F.col(c) for c in _meta(df)]
    return df.select(*cols, F.explode(arr).alias("_e")).filter(F.col("_e").isNotNull())


def stage(events: DataFrame | None, quakes: DataFrame | None) -> dict[str, DataFrame]:
    """K4: raw staging tables (no filter; timestamps parsed safely)."""
    out: dict[str, DataFrame] = {}
    if events is not None:
        m = _meta(events)
        out["event"] = events.select("id", "title", "description", "link",
                                     S.parse_ts("closed").alias("closed"), *m)
        c = _explode(events, "categories", parent=False)
        out["category"] = c.select(F.col("_e.id").alias("id"), F.col("_e.title").alias("title"),
                                   S.typed_null("string").alias("description"), *m)
        s = _explode(events, "sources", parent=False)
        out["source"] = s.select(F.col("_e.id").alias("id"), F.col("_e.url").alias("url"), *m)
        out["event_category"] = _explode(events, "categories").select(
            "event_id", F.col("_e.id").alias("category_id"), *m)
        out["event_source"] = _explode(events, "sources").select(
            "event_id", F.col("_e.id").alias("source_id"), *m)
        out["geometry"] = _explode(events, "geometry").select(
            "event_id", F.col("_e.date").alias("date"), F.col("_e.type").alias("type"),
            F.col("_e.coordinates").alias("coordinates"), *m)
    if quakes is not None:
        m = _meta(quakes)
        c = F.col("geometry.coordinates")
        out["earthquake"] = quakes.select(
            "id", S.epoch_ms_to_ts("properties.time").alias("time"),
            F.col("properties.mag").alias("magnitude"), F.col("properties.magType").alias("mag_type"),
            F.col("properties.place").alias("place"),
            S.element_or_null(c, 0).alias("longitude"), S.element_or_null(c, 1).alias("latitude"),
            S.element_or_null(c, 2).alias("depth_km"),
            S.int_to_bool("properties.tsunami").alias("tsunami"),
            F.col("properties.sig").alias("significance"), F.col("properties.url").alias("url"), *m)
    return out


def fit_events(events: DataFrame) -> DataFrame:
    """The event records that pass the gates of the clean load."""
    return (events.filter(P.all_not_null("id", "title", "link"))
                  .withColumn("title", F.trim("title"))
                  .filter(F.length("title") > 0)
                  .filter(P.url_ok("link"))
                  .withColumn("closed", S.parse_ts("closed")))


def newest(records: DataFrame) -> DataFrame:
    """The latest record of each id."""
    return D.latest(records, ["id"], _order(records) or ["id"])


def clean_events(events: DataFrame, checkpoint: bool = False) -> dict[str, DataFrame]:
    """K5 for the event feed (filters F1-F4, F8, P4, P8, P9, P11; dedup D1-D3).

    Six tables derive from the deduplicated records; with ``checkpoint``
    those are written once to the shared checkpoint folder
    (``DataFrame.checkpoint``), so writing the tables one by one does not
    repeat the dedup shuffle.
    """
    ev = newest(fit_events(events))
    if checkpoint:
        ev = ev.checkpoint(eager=True)
    return event_tables(ev)


def event_tables(ev: DataFrame) -> dict[str, DataFrame]:
    """The six tables of the latest event records."""
    m = _meta(ev)
    event = ev.select("id", "title", "description", "link", "closed")

    c = _explode(ev, "categories", parent=False).select(
        F.col("_e.id").alias("id"), S.title_or_id("_e.title", "_e.id").alias("title"), *m)
    category = D.latest(c.filter(F.col("id").isNotNull()), ["id"], m or ["title"]).select(
        "id", "title", S.typed_null("string").alias("description"))

    s = (_explode(ev, "sources", parent=False)
         .filter(F.col("_e.url").isNotNull() & P.url_ok("_e.url"))
         .select(F.col("_e.id").alias("id"), F.col("_e.url").alias("url"), *m))
    source = D.latest(s.filter(F.col("id").isNotNull()), ["id"], m or ["url"]).select("id", "url")

    event_category = D.distinct_rows(_explode(ev, "categories").select(
        "event_id", F.col("_e.id").alias("category_id")).filter(F.col("category_id").isNotNull()))
    event_source = D.distinct_rows(
        _explode(ev, "sources").filter(F.col("_e.url").isNotNull() & P.url_ok("_e.url"))
        .select("event_id", F.col("_e.id").alias("source_id")).filter(F.col("source_id").isNotNull()))

    g = (_explode(ev, "geometry")
         .select("event_id", S.parse_ts("_e.date").alias("date"), F.col("_e.type").alias("type"),
                 F.col("_e.coordinates").alias("coordinates"), *m)
         .filter(P.in_set("type", ["Point", "Polygon"]))
         .filter(P.all_not_null("date", "coordinates"))
         .withColumn("_canon", S.canonical_json("coordinates")))
    geometry = D.latest(g, ["event_id", "date", "_canon"], m or ["coordinates"]).select(
        "event_id", "date", "type", "coordinates")
    # links to dimensions that were dropped would break the foreign keys
    event_category = with_parent(event_category, category, "category_id", "id")
    event_source = with_parent(event_source, source, "source_id", "id")
    return {"event": event, "category": category, "source": source, "geometry": geometry,
            "event_category": event_category, "event_source": event_source}


def fit_quakes(quakes: DataFrame) -> DataFrame:
    """The quake records that pass the gates of the clean load."""
    c = F.col("geometry.coordinates")
    return (quakes.filter(P.all_not_null("id", "properties.time"))
                  .filter(P.min_size(c, 2))
                  .withColumn("longitude", S.element_or_null(c, 0))
                  .withColumn("latitude", S.element_or_null(c, 1))
                  .withColumn("depth_km", S.element_or_null(c, 2))
                  .filter(P.in_range("longitude", -180, 180) & P.in_range("latitude", -90, 90))
                  .filter(P.null_or_range("properties.mag", -1, 10)))


def clean_quakes(quakes: DataFrame, checkpoint: bool = False) -> DataFrame:
    """K5 for the quake feed (F1, F5-F7, P5-P7, P10; dedup D1)."""
    q = newest(fit_quakes(quakes))
    if checkpoint:  # read by the clean table and by the match
        q = q.checkpoint(eager=True)
    return quake_table(q)


def quake_table(q: DataFrame) -> DataFrame:
    """The earthquake table of the latest quake records."""
    return q.select(
        "id", S.epoch_ms_to_ts("properties.time").alias("time"),
        F.col("properties.mag").alias("magnitude"), F.col("properties.magType").alias("mag_type"),
        F.col("properties.place").alias("place"), "longitude", "latitude", "depth_km",
        S.int_to_bool("properties.tsunami", default=False).alias("tsunami"),
        F.col("properties.sig").alias("significance"),
        F.when(P.url_ok("properties.url"), F.col("properties.url")).alias("url"))


def point_observations(geometry: DataFrame) -> DataFrame:
    """Point geometries as (id, ts, lon, lat) for the match."""
    arr = S.json_double_array("coordinates")
    return (geometry.filter(F.col("type") == "Point")
                    .withColumn("_a", arr).filter(P.min_size("_a", 2))
                    .select(F.col("event_id").alias("id"), F.col("date").alias("ts"),
                            F.get("_a", F.lit(0)).alias("lon"), F.get("_a", F.lit(1)).alias("lat")))


def run(events: DataFrame | None, quakes: DataFrame | None, *, max_km: float = 500.0,
        max_hours: float = 168.0, checkpoint: bool = False, partitions: int | None = None,
        spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """Entry 1: staging + clean + match + ``quarantine.row`` (rejected clean
    rows: table_name, reasons, row as JSON). A missing feed (None or empty)
    gives empty tables, so a rebuild never leaves old rows behind (S9).
    ``checkpoint`` writes the deduplicated records once to the shared
    checkpoint folder when the tables will be written one by one (the
    parsed records too, so the lake is scanned and parsed once)."""
    spark = spark or (events if events is not None else quakes).sparkSession
    events = _slim(events if events is not None else empty_feed(spark, EVENT_RECORD))
    quakes = _slim(quakes if quakes is not None else empty_feed(spark, QUAKE_RECORD))
    if checkpoint:
        events, quakes = events.checkpoint(eager=True), quakes.checkpoint(eager=True)
    out = {f"staging.{k}": v for k, v in stage(events, quakes).items()}
    clean = clean_events(events, checkpoint)
    clean["earthquake"] = clean_quakes(quakes, checkpoint)
    clean, out["quarantine.row"] = accept(clean)
    out.update(clean)
    q = clean["earthquake"].select("id", F.col("time").alias("ts"), F.col("longitude").alias("lon"),
                                   F.col("latitude").alias("lat"))
    out["event_earthquake"] = match_pairs(point_observations(clean["geometry"]), q, max_km=max_km,
                                          max_hours=max_hours, partitions=partitions).drop("delay_seconds")
    return out


def accept(clean: dict[str, DataFrame], **parent: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """K5 / 2.12: clean tables cut to the rows that keep every constraint,
    parents before children, and the rejected rows of all tables. Parents
    that are not among the tables are given by name."""
    out, rejected = {}, []
    for name in ("event", "category", "source", "earthquake", "geometry", "event_category", "event_source"):
        if name not in clean:
            continue
        parents = [(p, out[p] if p in out else parent[p], ck, pk) for p, ck, pk in PARENTS.get(name, ())]
        out[name], bad = validate(clean[name], table_rules(name), parents=parents)
        row = F.to_json(F.struct(*[F.col(c) for c in clean[name].columns]))
        rejected.append(bad.select(F.lit(name).alias("table_name"), "reasons", row.alias("row")))
    return out, reduce(DataFrame.unionByName, rejected)
