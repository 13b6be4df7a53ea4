"""Dashboard queries (Q01-Q12, Q20-Q22, Q25).

Each function takes DataFrames plus column names (defaults are the hazard
tables' names) and returns a lazy DataFrame. Sorting follows PostgreSQL
null order (DESC -> NULLS FIRST, ASC -> NULLS LAST, M5).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators import aggregates as A
from tellus.operators.aggregates import table_counts


def open_count(event: DataFrame, closed: str = "closed", name: str = "open_events") -> DataFrame:
    """Q01: open items (no closing time)."""
    return event.filter(P.is_open(closed)).agg(F.count(F.lit(1)).alias(name))


def row_count(df: DataFrame, name: str = "quake_count") -> DataFrame:
    """Q02 / Q04."""
    return A.count_rows(df, name)


def max_value(df: DataFrame, c: str = "magnitude", name: str = "max_magnitude") -> DataFrame:
    """Q03."""
    return A.max_of(df, c, name)


def count_by_title(link: DataFrame, dim: DataFrame, *, link_key: str = "category_id",
                   dim_key: str = "id", title: str = "title", label: str = "category",
                   name: str = "event_count") -> DataFrame:
    """Q05: link rows per dimension *title* (not id), most first.

    Links are pre-aggregated per key (partial aggregate, one row per key and
    task) before the join, so the join and its shuffle see one row per key
    instead of one per link. Joining the counts keeps SQL join semantics (a
    duplicated dimension key counts its links twice).
    """
    per_key = (link.filter(F.col(link_key).isNotNull())
                   .groupBy(F.col(link_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
    d = dim.select(F.col(dim_key).alias("_dk"), F.col(title).alias(label))
    j = per_key.join(d, per_key["_k"] == d["_dk"], "inner")
    return (j.groupBy(label).agg(F.sum("_n").cast("long").alias(name))
             .orderBy(F.col(name).desc_nulls_first(), F.col(label).asc_nulls_last()))


def band_counts(df: DataFrame, c: str = "magnitude", label: str = "band",
                name: str = "quake_count") -> DataFrame:
    """Q06: integer bands ``'4 - 5'`` of a value, NULLs excluded."""
    per = A.count_by(df.filter(F.col(c).isNotNull()), [F.floor(F.col(c)).alias("_floor")], name)
    return per.orderBy("_floor").select(S.band_label("_floor").alias(label), name)


def daily_counts(df: DataFrame, ts: str = "time", label: str = "day",
                 name: str = "quake_count") -> DataFrame:
    """Q07: rows per calendar day (no gap filling)."""
    return A.count_by(df, [S.day_of(ts).alias(label)], name).orderBy(F.col(label).asc_nulls_last())


def above_threshold(df: DataFrame, c: str = "magnitude", threshold: float = 5.0,
                    cols: Sequence[str] = ("id", "place", "magnitude", "latitude", "longitude")) -> DataFrame:
    """Q08: rows at or above a threshold, for a map."""
    return df.filter(F.col(c) >= threshold).select(*cols)


def point_locations(event: DataFrame, geometry: DataFrame, *, event_key: str = "id",
                    geo_key: str = "event_id", title: str = "title", type_col: str = "type",
                    coords: str = "coordinates", date: str = "date",
                    cols: Sequence[str] = ("id", "title")) -> DataFrame:
    """Q09: Point geometries with lon/lat read from the JSON coordinates."""
    g = geometry.filter(F.col(type_col) == "Point").select(
        F.col(geo_key).alias("_gk"), S.json_array_item(coords, 0).alias("longitude"),
        S.json_array_item(coords, 1).alias("latitude"), F.col(date).alias("date"))
    j = event.select(*cols).join(g, F.col(event_key) == F.col("_gk"), "inner")
    return j.select(*cols, "longitude", "latitude", "date")


def match_details(matches: DataFrame | Callable, event: DataFrame, quake: DataFrame, *,
                  event_title: str = "title", quake_place: str = "place",
                  magnitude: str = "magnitude", quake_time: str = "time",
                  measures: Sequence[str] = ("distance_km", "delay_hours")) -> DataFrame:
    """Q10: matches with both sides' labels, nearest first. ``matches`` may
    be a match that takes the labels of both sides (``match_pairs``), whose
    points carry them: the pairs are not shuffled for a join."""
    e = event.select(F.col("id").alias("_eid"), F.col(event_title).alias("event_title"))
    q = quake.select(F.col("id").alias("_qid"), F.col(quake_place).alias("quake_place"),
                     F.col(magnitude).alias("magnitude"), F.col(quake_time).alias("quake_time"))
    if callable(matches):
        j = matches(e.withColumnRenamed("_eid", "id"), q.withColumnRenamed("_qid", "id"))
    else:
        j = (matches.join(e, matches["event_id"] == e["_eid"], "inner")
                    .join(q, matches["earthquake_id"] == q["_qid"], "inner"))
    return (j.select("event_title", "quake_place", "magnitude", *measures, "quake_time")
             .orderBy(F.col("distance_km").asc_nulls_last()))


def match_triples(matches: DataFrame | Callable, quake: DataFrame, magnitude: str = "magnitude",
                  measures: Sequence[str] = ("distance_km", "delay_hours")) -> DataFrame:
    """Q11: distance / delay / magnitude scatter (``matches`` as in Q10)."""
    q = quake.select(F.col("id").alias("_qid"), F.col(magnitude).alias("magnitude"))
    if callable(matches):
        j = matches(None, q.withColumnRenamed("_qid", "id"))
    else:
        j = matches.join(q, matches["earthquake_id"] == q["_qid"], "inner")
    return j.select(*measures, "magnitude")


def flagged_sorted(df: DataFrame, flag: str = "tsunami", by: str = "magnitude",
                   cols: Sequence[str] = ("place", "magnitude", "time", "latitude", "longitude")) -> DataFrame:
    """Q12: flagged rows, largest first (NULL first like PostgreSQL DESC)."""
    return df.filter(P.is_true(flag)).select(*cols).orderBy(F.col(by).desc_nulls_first())


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q20."""
    return table_counts(tables)


def raw_vs_clean(raw: DataFrame, clean: DataFrame, *, source: str = "source") -> DataFrame:
    """Q22: raw lines per source against clean rows per source.

    ``raw``: (source, objects, lines) from ``streaming.lake.volumes``;
    ``clean``: (source, clean_rows). Both are one row per source.
    """
    j = raw.join(clean, source, "full_outer")
    lines = F.coalesce(F.col("lines"), F.lit(0))
    kept = F.coalesce(F.col("clean_rows"), F.lit(0))
    return j.select(source, F.coalesce(F.col("objects"), F.lit(0)).alias("objects"),
                    lines.alias("lines"), kept.alias("clean_rows"),
                    (lines - kept).alias("gap"),
                    S.exact_ratio(kept, lines, 4).alias("clean_ratio"))


def open_per_category(event: DataFrame, link: DataFrame, dim: DataFrame, *,
                      closed: str = "closed", link_key: str = "category_id",
                      title: str = "title") -> DataFrame:
    """Q25: open events per category title."""
    open_ids = event.filter(P.is_open(closed)).select(F.col("id").alias("_eid"))
    l2 = link.join(open_ids, link["event_id"] == open_ids["_eid"], "left_semi")
    return count_by_title(l2, dim, link_key=link_key, title=title,
                          label="category", name="open_events")
