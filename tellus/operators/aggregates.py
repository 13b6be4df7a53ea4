"""Aggregations.

Every measure here is algebraic (count / sum / min / max / count_if), so
Spark runs a partial aggregate in each map task and shuffles only one row
per group and task: a group holding a third of the rows costs no more than
any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellus.functions.predicates import col


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias(name))


def max_of(df: DataFrame, c, name: str) -> DataFrame:
    """A2."""
    return df.agg(F.max(col(c)).alias(name))


def count_by(df: DataFrame, by: Sequence, name: str = "n") -> DataFrame:
    """A3 / A4: group count by columns or expressions."""
    return df.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """A5: ``count(*)`` plus one ``count_if`` per named predicate, computed in
    a single scan. Returns one row per predicate:
    ``(name, total_rows, failing_rows)``."""
    if not predicates:
        raise ValueError("no predicates")
    names = list(predicates)
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(F.coalesce(p, F.lit(False))).alias(f"_p{i}")
             for i, p in enumerate(predicates.values())]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', _p{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (name, failing_rows)",
                           "_total AS total_rows").select(
        "name", F.col("total_rows").cast("long"), F.col("failing_rows").cast("long"))


def duplicate_surplus(df: DataFrame, keys: Sequence) -> DataFrame:
    """``(total_rows, failing_rows)`` where failing counts every
    row beyond the first of its key; NULL keys form one group (M1). Keys may
    be column names or expressions (fuzzy keys)."""
    g = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1)), F.lit(0))
         .cast("long").alias("failing_rows"))


def fuzzy_keys(ts, lat, lon, mag) -> list[Column]:
    """A7 key: same minute, 0.1 deg latitude/longitude, 0.1 magnitude."""
    return [F.date_trunc("minute", col(ts).cast("timestamp")).alias("_k_min"),
            F.round(col(lat).cast("decimal(18,6)"), 1).alias("_k_lat"),
            F.round(col(lon).cast("decimal(18,6)"), 1).alias("_k_lon"),
            F.round(col(mag).cast("decimal(18,6)"), 1).alias("_k_mag")]


def table_counts(tables: Mapping[str, DataFrame], label: str = "table_name",
                 name: str = "row_count") -> DataFrame:
    """Row counts of several tables as one result."""
    out = None
    for t, df in tables.items():
        one = df.agg(F.count(F.lit(1)).cast("long").alias(name)).select(
            F.lit(t).alias(label), name)
        out = one if out is None else out.unionByName(one)
    return out
