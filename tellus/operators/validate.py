"""Constraint validation with quarantine (section 2.12, X1-X11, A16).

``validate(df, rules, ...)`` returns ``(accepted, rejected)``; rejected rows
carry ``reasons`` (array of rule names). Row rules are one projection (no
shuffle); key uniqueness uses the skew-safe ``split_latest``; foreign keys
are joins against the parents' distinct keys. For any data, accepted and
rejected rows together are the input, repeated rows included.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellus.functions import predicates as P
from tellus.functions import scalars as S
from tellus.operators.dedup import split_latest


@dataclass(frozen=True)
class Rule:
    """A CHECK-style rule: the row violates it when ``ok`` is FALSE.

    As in SQL CHECK constraints, a NULL result passes unless
    ``null_fails`` (used for NOT NULL rules).
    """
    name: str
    ok: Column
    null_fails: bool = False

    def violated(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(not self.null_fails))


def not_null(*cols: str) -> list[Rule]:
    return [Rule(f"not_null:{c}", F.col(c).isNotNull(), True) for c in cols]


def not_blank(c: str) -> Rule:
    return Rule(f"not_blank:{c}", P.not_blank(c))


def url(c: str) -> Rule:
    return Rule(f"url:{c}", P.url_ok(c))


def one_of(c: str, values) -> Rule:
    return Rule(f"one_of:{c}", P.in_set(c, values))


def between(c: str, lo, hi) -> Rule:
    return Rule(f"range:{c}", P.in_range(c, lo, hi))


def max_length(c: str, n: int) -> Rule:
    """varchar(n)."""
    return Rule(f"max_length:{c}", F.length(F.col(c)) <= n)


def fits_decimal(c: str, precision: int, scale: int) -> Rule:
    """numeric(p, s) after rounding to the scale."""
    fitted = F.round(F.col(c).cast("double"), scale).try_cast(f"decimal({precision},{scale})")
    return Rule(f"decimal:{c}", fitted.isNotNull() | F.col(c).isNull())


def point_geometry(type_col: str = "type", coords: str = "coordinates",
                   lon_range=(-180, 180), lat_range=(-90, 90)) -> Rule:
    """A Point holds exactly two numbers within lon/lat bounds; a
    Polygon holds a JSON array; other types are left to ``one_of``."""
    arr = S.json_double_array(coords)
    n = F.json_array_length(F.col(coords))
    point_ok = ((n == 2) & F.get(arr, F.lit(0)).between(*lon_range)
                & F.get(arr, F.lit(1)).between(*lat_range))
    poly_ok = n.isNotNull()
    ok = (F.when(F.col(type_col) == "Point", F.coalesce(point_ok, F.lit(False)))
           .when(F.col(type_col) == "Polygon", poly_ok)
           .otherwise(F.lit(True)))
    return Rule("geometry_shape", ok)


def validate(df: DataFrame, rules: Sequence[Rule], *, key: Sequence[str] = (),
             key_order: Sequence[str] = (),
             parents: Sequence[tuple[str, DataFrame, str, str]] = ()):
    """Split ``df`` into ``(accepted, rejected)``.

    * ``rules``: row rules (one pass, no shuffle).
    * ``key`` + ``key_order``: primary key; among rows passing the row rules
      the greatest by ``key_order`` is accepted (ties are broken by the row's
      contents, of identical rows one copy is accepted), the others are
      rejected as ``duplicate_key``.
    * ``parents``: ``(name, parent_df, child_key, parent_key)``; a non-NULL
      child key without a parent is rejected as ``missing_parent:name``.
    """
    reasons = F.array_compact(F.array(*[F.when(r.violated(), F.lit(r.name))
                                        for r in rules])) if rules else \
        F.array().cast("array<string>")
    tagged = df.withColumn("reasons", reasons)
    for name, parent, ck, pk in parents:
        keys = parent.select(F.col(pk).alias("_pk")).distinct().withColumn("_hit", F.lit(True))
        tagged = (tagged.join(keys, tagged[ck] == keys["_pk"], "left")
                        .withColumn("reasons", F.when(
                            F.col(ck).isNotNull() & F.col("_hit").isNull(),
                            F.array_append("reasons", F.lit(f"missing_parent:{name}")))
                            .otherwise(F.col("reasons")))
                        .drop("_pk", "_hit"))
    clean = tagged.filter(F.size("reasons") == 0)
    bad = tagged.filter(F.size("reasons") > 0)
    if key:
        order = list(key_order) or list(key)
        clean, dup = split_latest(clean.drop("reasons"), key, order)
        bad = bad.unionByName(dup.withColumn("reasons", F.array(F.lit("duplicate_key"))))
    return clean.drop("reasons"), bad


def load_counts(accepted: DataFrame, rejected: DataFrame) -> DataFrame:
    """Processed / failed record counts of one load, one scan each."""
    flags = (accepted.select(F.lit(1).alias("_ok"))
             .unionByName(rejected.select(F.lit(0).alias("_ok"))))
    return flags.agg(F.coalesce(F.sum("_ok"), F.lit(0)).cast("long").alias("processed"),
                     F.coalesce(F.sum(1 - F.col("_ok")), F.lit(0)).cast("long").alias("failed"))
