"""Declarative data-quality audit (G2, G3, section 2.9, A5-A7, A12, J7, J10).

A *row control* is a predicate over one table; all row controls of a table
are evaluated together in one scan (``count(*)`` + one ``count_if`` each,
then ``stack``). A *set control* computes ``(total_rows, failing_rows)`` from
one or more tables (duplicates, orphans, temporal coherence) with its own
pre-aggregated plan. ``run_audit`` unions everything into report rows.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators.aggregates import duplicate_surplus, fuzzy_keys
from tellus.operators.referential import before_first_child

Tables = Mapping[str, DataFrame]
PredicateLike = Union[str, Column, Callable[[Column], Column]]


def _details(c) -> str:
    """The report's text of a control, from what it is about: its dimension,
    columns and bound."""
    return f"{c.dimension}: {c.table} ({c.on})" + (f" [{c.bound}]" if c.bound else "")


@dataclass(frozen=True)
class Control:
    """Rows of ``table`` failing ``predicate`` (SQL text, a Column, or a
    function of the ``as_of`` Column)."""
    id: str
    dimension: str
    table: str
    predicate: PredicateLike
    severity: str = "M"
    on: str = ""
    bound: str = ""

    @property
    def details(self) -> str:
        return _details(self)

    def column(self, as_of: Column) -> Column:
        p = self.predicate
        if isinstance(p, str):
            return F.expr(p)
        if isinstance(p, Column):
            return p
        return p(as_of)


@dataclass(frozen=True)
class SetControl:
    """``measure(tables, as_of)`` returns one row ``(total_rows,
    failing_rows)``; ``table`` is the label written to the report."""
    id: str
    dimension: str
    table: str
    measure: Callable[[Tables, Column], DataFrame]
    severity: str = "M"
    on: str = ""
    bound: str = ""

    @property
    def details(self) -> str:
        return _details(self)


# ---------------------------------------------------------------- measures

def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str,
                  parent_key: str) -> DataFrame:
    """J7 as a measure: child rows and child rows without parent.

    The child is first counted per key (partial aggregate), so the join
    sees one row per distinct child key - a key holding a third of the rows
    is one row - and the parent side is reduced to its distinct keys. A
    NULL child key has no parent (NOT EXISTS semantics)."""
    per_key = (child.groupBy(F.col(child_key).alias("_ck"))
                    .agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct().withColumn("_hit", F.lit(1))
    j = per_key.join(keys, F.col("_ck") == F.col("_pk"), "left")
    return j.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_rows"),
                 F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0))
                  .cast("long").alias("failing_rows"))


def surplus_measure(table: str, keys: Sequence) -> Callable[[Tables, Column], DataFrame]:
    def m(tables: Tables, as_of: Column) -> DataFrame:
        k = keys(tables[table]) if callable(keys) else keys
        return duplicate_surplus(tables[table], k)
    return m


def orphan_measure(child: str, child_key: str, parent: str, parent_key: str = "id"):
    def m(tables: Tables, as_of: Column) -> DataFrame:
        return orphan_counts(tables[child], tables[parent], child_key, parent_key)
    return m


def closed_before_first_point(parent: str = "event", child: str = "geometry", *,
                              parent_key="id", parent_ts="closed",
                              child_key="event_id", child_ts="date",
                              child_ts_is_text=True):
    """Co01: total = parents with a closing time; failing = those closed
    before their earliest child time."""
    def m(tables: Tables, as_of: Column) -> DataFrame:
        p = tables[parent]
        bad = before_first_child(p, tables[child], parent_key=parent_key,
                                 parent_ts=parent_ts, child_key=child_key,
                                 child_ts=child_ts, child_ts_is_text=child_ts_is_text)
        flags = (p.filter(F.col(parent_ts).isNotNull()).select(F.lit(0).alias("_f"))
                  .unionByName(bad.select(F.lit(1).alias("_f"))))
        return flags.agg(F.count_if(F.col("_f") == 0).cast("long").alias("total_rows"),
                         F.count_if(F.col("_f") == 1).cast("long").alias("failing_rows"))
    return m


# ------------------------------------------------------- the 32 controls

DIMENSIONS = ("completeness", "uniqueness", "validity", "coherence", "integrity")


def hazard_controls() -> list:
    """The 32 controls over the hazard tables (event, category, source,
    geometry, event_category, event_source, earthquake). Fixed values: the
    ids, dimensions, severities and bounds."""
    c, u, v, co, i = DIMENSIONS
    R = [
        Control("C01", c, "event", P.is_blank("title"), "H", on="title"),
        Control("C02", c, "event", F.col("description").isNull(), "L", on="description"),
        Control("C03", c, "event", F.col("link").isNull(), "H", on="link"),
        Control("C04", c, "earthquake", F.col("magnitude").isNull(), "M", on="magnitude"),
        Control("C05", c, "earthquake", F.col("mag_type").isNull(), "L", on="mag_type"),
        Control("C06", c, "earthquake", F.col("place").isNull(), "L", on="place"),
        Control("C07", c, "earthquake", F.col("depth_km").isNull(), "L", on="depth_km"),
        Control("C08", c, "earthquake", P.any_null("longitude", "latitude"), "H", on="longitude, latitude"),
        Control("C09", c, "geometry", F.col("coordinates").isNull(), "H", on="coordinates"),
        SetControl("U01", u, "event", surplus_measure("event", ["id"]), "H", on="id"),
        SetControl("U02", u, "earthquake", surplus_measure("earthquake", ["id"]), "H", on="id"),
        SetControl("U03", u, "earthquake",
                   surplus_measure("earthquake", fuzzy_keys("time", "latitude", "longitude", "magnitude")),
                   "M", on="time, latitude, longitude, magnitude", bound="same minute, 0.1, 0.1"),
        SetControl("U04", u, "category", surplus_measure("category", ["id"]), "M", on="id"),
        SetControl("U05", u, "source", surplus_measure("source", ["id"]), "M", on="id"),
        Control("V01", v, "event", P.url_bad("link"), "H", on="link"),
        Control("V02", v, "source", P.url_bad("url"), "H", on="url"),
        Control("V03", v, "earthquake", P.out_of_range("longitude", -180, 180), "H", on="longitude", bound="-180 to 180"),
        Control("V04", v, "earthquake", P.out_of_range("latitude", -90, 90), "H", on="latitude", bound="-90 to 90"),
        Control("V05", v, "earthquake", P.out_of_range("magnitude", -1, 10), "H", on="magnitude", bound="-1 to 10"),
        Control("V06", v, "earthquake", P.out_of_range("depth_km", 0, None), "M", on="depth_km", bound="0 and more"),
        Control("V07", v, "geometry", P.not_in_set("type", ["Point", "Polygon"]), "M", on="type", bound="Point, Polygon"),
        Control("V08", v, "geometry",
                (F.col("type") == "Point") & F.col("coordinates").isNotNull()
                & F.coalesce(F.json_array_length("coordinates") < 2, F.lit(True)),
                "H", on="type, coordinates"),
        SetControl("Co01", co, "event", closed_before_first_point(), "M", on="closed, geometry.date"),
        Control("Co02", co, "earthquake",
                P.is_true("tsunami") & (F.col("magnitude").isNull() | (F.col("magnitude") < 6.5)),
                "L", on="tsunami, magnitude", bound="6.5"),
        Control("Co03", co, "earthquake",
                lambda as_of: F.col("time") > as_of + F.expr("INTERVAL 1 DAY"), "M", on="time", bound="as_of + 1 day"),
        Control("Co04", co, "earthquake",
                lambda as_of: F.col("time") < as_of - F.expr("INTERVAL 365 DAYS"), "L", on="time", bound="as_of - 365 days"),
        Control("Co05", co, "event",
                lambda as_of: F.col("closed").isNotNull() & (F.col("closed") > as_of + F.expr("INTERVAL 1 DAY")),
                "M", on="closed", bound="as_of + 1 day"),
        SetControl("I01", i, "event_category", orphan_measure("event_category", "event_id", "event"), "H", on="event_id"),
        SetControl("I02", i, "event_category", orphan_measure("event_category", "category_id", "category"), "H", on="category_id"),
        SetControl("I03", i, "event_source", orphan_measure("event_source", "event_id", "event"), "H", on="event_id"),
        SetControl("I04", i, "event_source", orphan_measure("event_source", "source_id", "source"), "H", on="source_id"),
        SetControl("I05", i, "geometry", orphan_measure("geometry", "event_id", "event"), "H", on="event_id"),
    ]
    return R


# ------------------------------------------------------------------ runner

def _lit_ts(ts) -> Column:
    if isinstance(ts, Column):
        return ts
    if ts is None:
        return F.current_timestamp()
    if isinstance(ts, str):
        return F.to_timestamp(F.lit(ts))
    return F.lit(ts).cast("timestamp")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_audit(tables: Tables, controls: Sequence | None = None, *, phase: str = "before",
              run_id: str | None = None, run_at=None, as_of=None,
              schema: str = "staging") -> DataFrame:
    """Evaluate ``controls`` and return report rows (schema ``REPORT``).

    One aggregate job per table for all its row controls, one small plan per
    set control; everything is unioned lazily so the caller writes it once.
    ``as_of`` replaces ``now()`` in time-relative controls (reproducible).
    """
    if phase not in ("before", "after"):
        raise ValueError("phase must be 'before' or 'after'")
    controls = hazard_controls() if controls is None else list(controls)
    run_id = run_id or str(uuid.uuid4())
    run_at_c = _lit_ts(run_at if run_at is not None else _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    as_of_c = _lit_ts(as_of)
    by_table: dict[str, list[Control]] = defaultdict(list)
    parts: list[DataFrame] = []
    for ctl in controls:
        if isinstance(ctl, Control):
            by_table[ctl.table].append(ctl)
    for table, ctls in by_table.items():
        df = tables[table]
        aggs = [F.count(F.lit(1)).alias("_total")]
        aggs += [F.count_if(F.coalesce(ct.column(as_of_c), F.lit(False))).alias(f"_p{n}")
                 for n, ct in enumerate(ctls)]
        rows = ", ".join(
            f"{_sql_str(ct.id)}, {_sql_str(ct.dimension)}, {_sql_str(ct.severity)}, "
            f"{_sql_str(ct.details)}, _p{n}" for n, ct in enumerate(ctls))
        parts.append(df.agg(*aggs).selectExpr(
            f"stack({len(ctls)}, {rows}) AS (control_id, dimension, severity, details, failing_rows)",
            "_total AS total_rows").withColumn("table_name", F.lit(f"{schema}.{table}")))
    for ctl in controls:
        if isinstance(ctl, SetControl):
            m = ctl.measure(tables, as_of_c)
            parts.append(m.select(
                F.lit(ctl.id).alias("control_id"), F.lit(ctl.dimension).alias("dimension"),
                F.lit(ctl.severity).alias("severity"), F.lit(ctl.details).alias("details"),
                F.col("failing_rows"), F.col("total_rows"),
                F.lit(f"{schema}.{ctl.table}").alias("table_name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        F.lit(run_id).alias("run_id"), run_at_c.alias("run_at"), F.lit(phase).alias("phase"),
        "control_id", "dimension", "severity", "table_name",
        F.col("total_rows").cast("long").alias("total_rows"),
        F.col("failing_rows").cast("long").alias("failing_rows"),
        S.fail_rate("failing_rows", "total_rows").alias("fail_rate"),
        "details")

