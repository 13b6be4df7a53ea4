"""Staging repair (section 2.10, R01-R23) with a per-rule change report.

``repair(tables)`` applies the three stages in the order the reference
actually executes them (imputation, deletion, correction; configurable) and
returns ``(repaired_tables, changes)`` where ``changes`` has one row per rule
``(rule_id, action, table_name, changed_rows)``.

Updates are projections, deletes are filters or semi joins, dedups use the
skew-safe ``latest`` / ``dedup_keys``; counts of changed rows are fused
``count_if`` aggregates over each stage's input. With ``materialize`` each
stage's tables are written to the shared checkpoint folder and read back,
which cuts the lineage between stages (recovery after executor loss starts
from the written stage, not from the raw input).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators.aggregates import conditional_counts, duplicate_surplus
from tellus.operators.dedup import dedup_keys, latest
from tellus.operators.referential import with_all_parents, with_parent
from tellus.schemas import INGESTED_AT

DEFAULT_ORDER = ("impute", "delete", "correct")
# Order in which "keep the latest row" breaks ties after _ingested_at.
TIE_BREAK = ("_seq", "_rec", "_pos")


def _count_if(df: DataFrame, named: Mapping[str, Column]) -> DataFrame:
    """Rows of ``df`` that each rule changes, in one scan."""
    return conditional_counts(df, named).select(F.col("name").alias("rule_id"), F.col("failing_rows").alias("changed_rows"))


def _tag(df: DataFrame, action: str, table: str) -> DataFrame:
    return df.select("rule_id", F.lit(action).alias("action"),
                     F.lit(table).alias("table_name"), "changed_rows")


def _order_cols(df: DataFrame) -> list[str]:
    return [c for c in (INGESTED_AT,) + TIE_BREAK if c in df.columns]


# ------------------------------------------------------------------ stages

def impute(t: dict) -> tuple[dict, list[DataFrame]]:
    """R01-R04."""
    out, ch = dict(t), []
    if "earthquake" in t:
        q = t["earthquake"]
        r01 = F.col("mag_type").isNull()
        r02 = P.is_blank("place")
        ch.append(_tag(_count_if(q, {"R01": r01, "R02": r02}), "impute", "earthquake"))
        out["earthquake"] = (q.withColumn("mag_type", F.coalesce("mag_type", F.lit("unknown")))
                              .withColumn("place", F.when(r02, F.lit("unknown")).otherwise(F.col("place"))))
    if "event" in t:
        e = t["event"]
        ch.append(_tag(_count_if(e, {"R03": F.col("description").isNull()}), "impute", "event"))
        out["event"] = e.withColumn("description", F.coalesce("description", F.lit("")))
    if "category" in t:
        c = t["category"]
        r04 = P.is_blank("title")
        ch.append(_tag(_count_if(c, {"R04": r04}), "impute", "category"))
        out["category"] = c.withColumn("title", F.when(r04, F.col("id")).otherwise(F.col("title")))
    return out, ch


def delete(t: dict) -> tuple[dict, list[DataFrame]]:
    """R05-R13 (sequential semantics: each count is over the rows the earlier
    deletes left)."""
    out, ch = dict(t), []
    if "earthquake" in t:
        q = t["earthquake"]
        r05 = P.any_null("longitude", "latitude")
        r06 = ((F.col("longitude") < -180) | (F.col("longitude") > 180)
               | (F.col("latitude") < -90) | (F.col("latitude") > 90))
        r07 = P.out_of_range("magnitude", -1, 10)
        r08 = P.out_of_range("depth_km", 0, None)
        seq, counts, gone = [("R05", r05), ("R06", r06), ("R07", r07), ("R08", r08)], {}, F.lit(False)
        for rid, cond in seq:
            counts[rid] = ~gone & F.coalesce(cond, F.lit(False))
            gone = gone | F.coalesce(cond, F.lit(False))
        ch.append(_tag(_count_if(q, counts), "delete", "earthquake"))
        out["earthquake"] = q.filter(~gone)
    if "event" in t:
        e = t["event"]
        r09 = P.is_blank("title") | F.col("link").isNull()
        ch.append(_tag(_count_if(e, {"R09": r09}), "delete", "event"))
        out["event"] = e.filter(~r09)
    if "geometry" in t:
        g = t["geometry"]
        # NULL type survives (NOT IN over NULL is unknown, M4)
        r10 = F.col("coordinates").isNull() | ~F.col("type").isin("Point", "Polygon")
        ch.append(_tag(_count_if(g, {"R10": r10}), "delete", "geometry"))
        g = g.filter(~F.coalesce(r10, F.lit(False)))
        if "event" in out:
            kept = with_parent(g, out["event"], "event_id", "id")
            ch.append(_tag(_removed("R13", g, kept), "delete", "geometry"))
            g = kept
        out["geometry"] = g
    for rid, link, key, dim in (("R11", "event_category", "category_id", "category"),
                                ("R12", "event_source", "source_id", "source")):
        if link in t and "event" in out and dim in out:
            before = t[link]
            kept = with_all_parents(before, [(out["event"], "event_id", "id"),
                                             (out[dim], key, "id")])
            ch.append(_tag(_removed(rid, before, kept), "delete", link))
            out[link] = kept
    return out, ch


def _removed(rule_id: str, before: DataFrame, after: DataFrame) -> DataFrame:
    b = before.agg(F.count(F.lit(1)).alias("_b"))
    a = after.agg(F.count(F.lit(1)).alias("_a"))
    flags = b.select(F.col("_b").alias("_n")).unionByName(a.select((-F.col("_a")).alias("_n")))
    return flags.agg(F.lit(rule_id).alias("rule_id"), F.sum("_n").cast("long").alias("changed_rows"))


def correct(t: dict) -> tuple[dict, list[DataFrame]]:
    """R14-R23."""
    out, ch = dict(t), []
    if "event" in t:
        e = t["event"]
        trimmed = F.trim(F.col("title"))
        fixed_link = S.add_https("link")
        ch.append(_tag(_count_if(e, {"R14": F.col("title") != trimmed,
                                     "R16": F.col("link") != fixed_link}), "correct", "event"))
        e = e.withColumn("title", trimmed).withColumn("link", fixed_link)
        out["event"] = e
    if "source" in t:
        s = t["source"]
        fixed = S.add_https("url")
        ch.append(_tag(_count_if(s, {"R15": F.col("url") != fixed}), "correct", "source"))
        out["source"] = s.withColumn("url", fixed)
    for rid, name in (("R17", "earthquake"), ("R18", "event"), ("R19", "category"), ("R20", "source")):
        if name in out:
            df = out[name]
            ch.append(_tag(duplicate_surplus(df, ["id"]).select(
                F.lit(rid).alias("rule_id"), "failing_rows").withColumnRenamed(
                "failing_rows", "changed_rows"), "correct", name))
            out[name] = latest(df, ["id"], _order_cols(df) or ["id"])
    for rid, name, keys, null_safe in (("R21", "event_category", ["event_id", "category_id"], ()),
                                       ("R22", "event_source", ["event_id", "source_id"], ()),
                                       ("R23", "geometry", ["event_id", "date", "_coords_text"], ("date",))):
        if name not in out:
            continue
        df = out[name]
        if name == "geometry":
            # jsonb::text equality: canonical JSON text
            df = df.withColumn("_coords_text", S.canonical_json("coordinates"))
        strict = [k for k in keys if k not in null_safe]
        eligible = df.filter(~P.any_null(*strict))
        ch.append(_tag(duplicate_surplus(eligible, keys).select(
            F.lit(rid).alias("rule_id"), F.col("failing_rows").alias("changed_rows")),
            "correct", name))
        order = _order_cols(df)
        res = dedup_keys(df, keys, order_by=order or None, null_safe=null_safe)
        out[name] = res.drop("_coords_text") if name == "geometry" else res
    return out, ch


STAGES: dict[str, Callable] = {"impute": impute, "delete": delete, "correct": correct}


def repair(tables: Mapping[str, DataFrame], order: Sequence[str] = DEFAULT_ORDER,
           materialize: Callable[[str, DataFrame], DataFrame] | None = None):
    """Apply the repair stages; returns ``(tables, changes)``.

    ``materialize(name, df) -> df`` (for example a write to the shared
    checkpoint folder and a read back) is called after each stage on every
    table that stage changed, so the next stage and the change counts start
    from written files instead of recomputing the whole chain.
    """
    t = dict(tables)
    changes: list[DataFrame] = []
    for n, stage in enumerate(order):
        before = t
        t, ch = STAGES[stage](t)
        changes.extend(c.withColumn("stage", F.lit(n + 1)) for c in ch)
        if materialize is not None:
            t = {k: (materialize(f"{stage}-{k}", v) if v is not before.get(k) else v)
                 for k, v in t.items()}
    rep = changes[0]
    for c in changes[1:]:
        rep = rep.unionByName(c)
    return t, rep.select("stage", "rule_id", "action", "table_name", "changed_rows")
