"""Spatio-temporal range join.

Matches left points (id, time, lon, lat) with right points when the great
circle distance is <= ``max_km`` and the absolute time difference is
<= ``max_hours``. Spark has no range join; the band predicates are turned
into an equi-join on bucket keys plus an exact residual filter:

* space: each point becomes a unit vector; the 3-D grid has cell edge
  ``max_km / R`` (arc >= chord, so two matching points differ by at most
  one cell per axis). No special cases at the poles or at +-180 deg.
* time: buckets of ``max_hours``; matching times differ by at most one
  bucket.

Replication is split so every candidate pair meets exactly once and no
dedup is needed: the *space side* is copied to the neighbour cells whose
box lies within reach of the point (about 20 of 27 on average) and keeps
its own time bucket; the *time side* is copied to the 3 neighbour buckets
and keeps its own cell. The join key is (cx, cy, cz, tb); the physical
join is a sort-merge join on the keys (the static estimate does not see the
replication fan-out, so no broadcast is taken from it). One row per pair of
ids is decided where the pair is made (``match_pairs``); pairs are not
shuffled. A cell and bucket
where either side has over ``HOT_ROWS`` points is cut into a grid by measured
counts of both sides: each field holds about ``HOT_ROWS`` points of either
side at most, so no task gets a whole swarm, on whichever side it is.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellus.functions.scalars import EARTH_RADIUS_KM, epoch_seconds, haversine_km
from tellus.operators.dedup import earliest
from tellus.operators.partitioning import spread

_KEYS = ["_cx", "_cy", "_cz", "_tb"]
#: Points of one side in a cell and bucket above which it is cut.
HOT_ROWS = 5000
#: Points of one left id in one place (a band of latitude and a span of time) that are listed with each other.
RIVALS = 1000


def _cells(df: DataFrame, keys: list[str], name: str, copies: dict[str, Column]) -> DataFrame:
    """Rows by key, counted before they are copied: the counts are copied in
    their place (at most as many keys get a point as get its count)."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    for c, around in copies.items():
        n = n.withColumn(c, F.explode(around))
    return n


def _hot_keys(keys: list[str], sp_cells: DataFrame, tp_cells: DataFrame, hot_rows: int) -> DataFrame:
    """Keys where either side has over ``hot_rows`` points, with the columns and rows of their grid."""
    both = sp_cells.withColumn("_nt", F.lit(0)).unionByName(tp_cells.withColumn("_ns", F.lit(0)))
    n = both.groupBy(*keys).agg(F.sum("_ns").alias("_ns"), F.sum("_nt").alias("_nt"))
    n = n.filter((F.greatest("_ns", "_nt") > hot_rows) & (F.least("_ns", "_nt") > 0))
    parts = [F.greatest(F.ceil(F.col(c) / hot_rows), F.lit(1)).cast("int").alias(a) for c, a in (("_ns", "_cols"), ("_nt", "_rows"))]
    return n.select(*keys, *parts)


def _salted(sp: DataFrame, tp: DataFrame, keys: list[str], sp_cells: DataFrame, tp_cells: DataFrame,
            hot_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the keys of their join. A key where either side has over
    ``hot_rows`` points becomes a grid: a point of the space side has one
    column and is copied to all rows, a point of the time side has one row
    and is copied to all columns, so each pair meets in one field. The counts
    are reduced before the shuffle and only hot keys are kept of them."""
    hot = _hot_keys(keys, sp_cells, tp_cells, hot_rows)

    def dealt(df: DataFrame, own: str, place: str, other: str, copy: str) -> DataFrame:
        h = F.xxhash64(*[c for c in df.columns if c not in keys])
        df = df.withColumn("_h", h).join(hot, keys, "left")
        df = df.withColumn(place, F.pmod(F.col("_h"), F.coalesce(own, F.lit(1))).cast("int"))
        return df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))).drop("_h", "_cols", "_rows")
    return dealt(sp, "_cols", "_col", "_rows", "_row"), dealt(tp, "_rows", "_row", "_cols", "_col"), [*keys, "_row", "_col"]


def _points(df, id_col, ts_col, lon_col, lat_col, prefix):
    sec = epoch_seconds(ts_col)
    return (df.select(F.col(id_col).alias(f"{prefix}id"), sec.alias(f"{prefix}sec"),
                      F.col(lon_col).cast("double").alias(f"{prefix}lon"),
                      F.col(lat_col).cast("double").alias(f"{prefix}lat"))
              .filter(F.col(f"{prefix}sec").isNotNull()
                      & F.col(f"{prefix}lon").isNotNull()
                      & F.col(f"{prefix}lat").isNotNull()))


def _vector(prefix: str) -> dict[str, Column]:
    lat_r = F.radians(F.col(f"{prefix}lat"))
    lon_r = F.radians(F.col(f"{prefix}lon"))
    return {"_x": F.cos(lat_r) * F.cos(lon_r), "_y": F.cos(lat_r) * F.sin(lon_r), "_z": F.sin(lat_r)}


def _placed(points, prefix, cell, bucket):
    """Points with their unit vector, cell and time bucket."""
    return (points.withColumns(_vector(prefix))
                  .withColumn("_cx", F.floor(F.col("_x") / cell))
                  .withColumn("_cy", F.floor(F.col("_y") / cell))
                  .withColumn("_cz", F.floor(F.col("_z") / cell))
                  .withColumn("_tb", F.floor(F.col(f"{prefix}sec") / F.lit(bucket))))


def _prepare(df, id_col, ts_col, lon_col, lat_col, prefix, cell, bucket):
    return _placed(_points(df, id_col, ts_col, lon_col, lat_col, prefix), prefix, cell, bucket)


def _grid(max_km: float, max_hours: float | None) -> tuple[float, int]:
    """Edge of a cell and seconds of a time bucket."""
    chord = max_km / EARTH_RADIUS_KM
    # a hair larger than the threshold: only adds candidates, never loses one
    return max(chord, 1e-9) * (1 + 1e-6), max(int(math.ceil((max_hours or 1.0) * 3600.0)), 1)


def _around(c: str) -> Column:
    return F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)


def _in_reach(cosine: Column, max_km: float) -> Column:
    """Whether a pair lies within ``max_km``, by the cosine of its angle; the
    distance itself is computed for a hair at the threshold only."""
    angle = max_km / EARTH_RADIUS_KM
    least = math.cos(angle * (1 + 1e-6)) - 1e-12 if angle * (1 + 1e-6) < math.pi else -2.0
    sure = math.cos(angle * (1 - 1e-6)) + 1e-12 if 0 < angle < math.pi else 2.0
    # 2.0: NaN is larger than any number
    surely = cosine.between(sure, 2.0) & F.col("l_lat").between(-90.0, 90.0) & F.col("r_lat").between(-90.0, 90.0)
    return surely | ((cosine >= F.lit(least)) & (haversine_km("l_lat", "l_lon", "r_lat", "r_lon") <= F.lit(float(max_km))))


def _gap(p, lo, size):
    # distance from coordinate p to the interval [lo, lo + size]
    return F.greatest(lo - p, F.lit(0.0), p - (lo + size))


def spacetime_candidates(left: DataFrame, right: DataFrame, *,
                         left_id="id", left_ts="ts", left_lon="lon", left_lat="lat",
                         right_id="id", right_ts="ts", right_lon="lon", right_lat="lat",
                         max_km: float = 500.0, max_hours: float | None = 168.0,
                         space_side: str = "right", partitions: int | None = None,
                         hot_rows: int = HOT_ROWS) -> DataFrame:
    """J1 + J2: every (left point, right point) pair within both bands.

    Output: ``l_id, r_id, l_sec, r_sec, distance_km`` (unrounded) and
    ``delay_seconds = r_sec - l_sec`` (signed, whole seconds). ``partitions``
    spreads inputs that have too few splits (see ``spread``) and is the
    number of tasks that make pairs.
    """
    cell, bucket = _grid(max_km, max_hours)
    lp = _prepare(left, left_id, left_ts, left_lon, left_lat, "l_", cell, bucket)
    rp = _prepare(right, right_id, right_ts, right_lon, right_lat, "r_", cell, bucket)
    j = _meet(lp, rp, cell, max_km, max_hours, space_side, partitions, hot_rows)
    return j.select("l_id", "r_id", "l_sec", "r_sec", "distance_km", "delay_seconds")


def _parts(df: DataFrame, keys: list[str], near: dict[str, Column], hot: DataFrame) -> DataFrame:
    """Points, not yet copied, with the hot keys among those they are copied
    to (at most as many as a point has copies), so that the copies need no
    join of their own."""
    own = hot
    for k in keys:
        own = own.withColumn(f"_of{k}", F.col(k))
    for k in near:
        own = own.withColumn(f"_of{k}", F.explode(_around(k)))
    own = own.groupBy(*[f"_of{k}" for k in keys]).agg(F.collect_list(F.struct(*keys, "_cols", "_rows")).alias("_hot"))
    return df.join(own.withColumnsRenamed({f"_of{k}": k for k in keys}), keys, "left")


def _in_grid(df: DataFrame, ids: list[str], own: str, place: str, other: str, copy: str) -> DataFrame:
    """Copies with the row and column of their field (one field where the key is not hot)."""
    same = lambda x: reduce(lambda a, b: a & b, [x[k] == F.col(k) for k in _KEYS])
    df = df.withColumn("_at", F.when(F.col("_hot").isNotNull(), F.get(F.filter("_hot", same), F.lit(0))))
    n, m = F.coalesce(F.col(f"_at.{own}"), F.lit(1)), F.coalesce(F.col(f"_at.{other}"), F.lit(1))
    df = df.withColumn(place, F.pmod(F.xxhash64(*ids), n).cast("int"))
    return df.withColumn(copy, F.explode(F.sequence(F.lit(0), m - 1))).drop("_at", "_hot")


def _meet(lp: DataFrame, rp: DataFrame, cell: float, max_km: float, max_hours: float | None,
          space_side: str = "right", partitions: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All pairs of placed points within both bands, with all columns of
    either side but their places."""
    lp, rp = spread(lp, partitions), spread(rp, partitions)
    sp, tp = (rp, lp) if space_side == "right" else (lp, rp)

    offs = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"),
                              F.lit(dz).alias("dz"))
                     for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1)])
    if max_hours is None:  # any time: no copies, one bucket
        sp, tp = sp.withColumn("_tb", F.lit(0)), tp.withColumn("_tb", F.lit(0))
    times = {} if max_hours is None else {"_tb": _around("_tb")}
    around = {k: _around(k) for k in ("_cx", "_cy", "_cz")}
    hot = _hot_keys(_KEYS, _cells(sp, _KEYS, "_ns", around), _cells(tp, _KEYS, "_nt", times), hot_rows)
    ids = [[c for c in df.columns if c not in _KEYS and c not in ("_x", "_y", "_z")] for df in (sp, tp)]
    sp, tp = _parts(sp, _KEYS, around, hot), _parts(tp, _KEYS, times, hot)
    sp = sp.withColumn("_o", F.explode(offs))
    ncx = F.col("_cx") + F.col("_o.dx")
    ncy = F.col("_cy") + F.col("_o.dy")
    ncz = F.col("_cz") + F.col("_o.dz")
    c = F.lit(cell)
    d2 = (F.pow(_gap(F.col("_x"), ncx * c, c), 2) + F.pow(_gap(F.col("_y"), ncy * c, c), 2)
          + F.pow(_gap(F.col("_z"), ncz * c, c), 2))
    sp = (sp.filter(d2 <= F.lit(cell * cell))
            .withColumn("_cx", ncx).withColumn("_cy", ncy).withColumn("_cz", ncz)
            .drop("_o", "_x", "_y", "_z"))
    tp = tp.drop("_x", "_y", "_z")
    for c, near in times.items():
        tp = tp.withColumn(c, F.explode(near))
    sp = _in_grid(sp, ids[0], "_cols", "_col", "_rows", "_row")
    tp = _in_grid(tp, ids[1], "_rows", "_row", "_cols", "_col")
    keys = [*_KEYS, "_row", "_col"]
    if max_hours is None:  # a constant is no key to shuffle by
        keys.remove("_tb")
        sp, tp = sp.drop("_tb"), tp.drop("_tb")
    if partitions:  # the work grows with the pairs, not the bytes by which small partitions would be put together
        sp, tp = sp.repartition(partitions, *keys), tp.repartition(partitions, *keys)
    # vectors behind that shuffle, so that it does not hold them
    sides = ((sp, "r_"), (tp, "l_")) if space_side == "right" else ((sp, "l_"), (tp, "r_"))
    sp, tp = (df.withColumns({f"_{x}{a}": v for a, v in _vector(x).items()}) for df, x in sides)
    # Sort-merge join on the bucket keys. The static size estimate does not
    # see the explode's fan-out, so a broadcast chosen from it could be far
    # larger than planned; the shuffles a sort-merge join inserts are the
    # ones AQE can split when a cell is hot (skew join).
    j = sp.hint("merge").join(tp, keys, "inner")
    delay = F.col("r_sec") - F.col("l_sec")
    cosine = reduce(lambda a, b: a + b, [F.col(f"_l_{a}") * F.col(f"_r_{a}") for a in ("_x", "_y", "_z")])
    met = _in_reach(cosine, max_km)
    if max_hours is not None:  # one condition: the cheaper test goes first
        met = (F.abs(delay / F.lit(3600.0)) <= F.lit(float(max_hours))) & met
    return (j.filter(met)
             .withColumn("distance_km", haversine_km("l_lat", "l_lon", "r_lat", "r_lon"))
             .withColumn("delay_seconds", delay).drop(*keys, *(f"_{x}{a}" for x in ("l_", "r_") for a in ("_x", "_y", "_z"))))


def _rivals(lp: DataFrame, cell: float, bucket: int, max_km: float, max_hours: float,
            most: int) -> tuple[DataFrame, DataFrame]:
    """Left points with their rivals (``_near``: other points of the same id
    that may lie within both bands of one right point, null where there is
    none), and the ids that have more than ``most`` points in one place,
    whose points have no list."""
    own = lp.groupBy("l_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("l_id").alias("_id"))
    p = lp.join(own, F.col("l_id").eqNullSafe(F.col("_id")), "left_semi").select(
        "l_id", "l_sec", "l_lon", "l_lat", F.floor(F.col("_z") / (2 * cell)).alias("_z2"), F.floor(F.col("l_sec") / (2 * bucket)).alias("_t2"))
    place = ["l_id", "_z2", "_t2"]
    copies = p.withColumn("_z2", F.explode(_around("_z2"))).withColumn("_t2", F.explode(_around("_t2")))
    n = _cells(p, place, "_n", {c: _around(c) for c in place[1:]})
    many = n.groupBy(*place).agg(F.sum("_n").alias("_n")).filter(F.col("_n") > most).select(F.col("l_id").alias("_id")).distinct()
    groups = copies.join(many, F.col("l_id").eqNullSafe(F.col("_id")), "left_anti").groupBy(*place).agg(
        F.collect_list(F.struct(F.col("l_sec").alias("sec"), F.col("l_lon").alias("lon"), F.col("l_lat").alias("lat"))).alias("_all"))
    g = groups.select(*[F.col(c).alias(f"_g{c}") for c in place], "_all")
    km = lambda x: haversine_km("l_lat", "l_lon", x["lat"], x["lon"])
    other = lambda x: (x["sec"] != F.col("l_sec")) | (x["lon"] != F.col("l_lon")) | (x["lat"] != F.col("l_lat"))
    near = F.filter("_all", lambda x: (F.abs(x["sec"] - F.col("l_sec")) <= 2 * bucket) & other(x)
                    & ((km(x) <= 2 * max_km * (1 + 1e-6)) | F.isnan(km(x))))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{c}")) for c in place])
    lists = p.join(g, same).select(F.col("l_id").alias("_id"), F.col("l_sec").alias("_sec"), F.col("l_lon").alias("_lon"),
                                   F.col("l_lat").alias("_lat"), near.alias("_near")).filter(F.size("_near") > 0)
    same = (F.col("l_id").eqNullSafe(F.col("_id")) & (F.col("l_sec") == F.col("_sec"))
            & (F.col("l_lon") == F.col("_lon")) & (F.col("l_lat") == F.col("_lat")))
    return lp.join(lists, same, "left").drop("_id", "_sec", "_lon", "_lat"), many


def _labelled(points: DataFrame, key: str, labels: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Points with the labels of their id, and the ids that have not exactly
    one row of labels."""
    if labels is None:
        return points, None
    names = [c for c in labels.columns if c != "id"]
    one = labels.groupBy("id").agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in names])
    tagged = points.join(one.filter("_n = 1 AND id IS NOT NULL").drop("_n").withColumnRenamed("id", "_lid"), F.col(key) == F.col("_lid"), "left")
    other = tagged.filter("_lid IS NULL").select(F.col(key).alias("_id")).distinct()
    return tagged.drop("_lid"), other


def match_pairs(left: DataFrame, right: DataFrame, *, max_km: float = 500.0,
                max_hours: float = 168.0, round_output: bool = True,
                left_name: str = "event_id", right_name: str = "earthquake_id",
                left_id="id", left_ts="ts", left_lon="lon", left_lat="lat",
                right_id="id", right_ts="ts", right_lon="lon", right_lat="lat",
                space_side: str = "right", partitions: int | None = None, hot_rows: int = HOT_ROWS,
                left_labels: DataFrame | None = None, right_labels: DataFrame | None = None,
                rivals: int = RIVALS) -> DataFrame:
    """One row per (left id, right id).

    When a left id has several points, the kept pair is the nearest, then
    the smallest absolute delay, then the smallest delay (a total order;
    the original job kept an arbitrary one). The distance threshold applies
    to the unrounded value; outputs are rounded to 2 decimals when
    ``round_output``. ``delay_seconds`` is kept exact for comparisons.

    Pairs are not shuffled: a left point carries the other points of its id
    that may meet the same right point, and a pair stays if none of them
    makes a better one. Only right ids with several points and left ids with
    over ``rivals`` points in one place have their pairs grouped by ids.

    ``left_labels`` and ``right_labels`` (``id`` and other columns) are
    joined by id (inner): the points carry them, but for ids with several
    rows of labels, which are joined to the pairs.
    """
    cell, bucket = _grid(max_km, max_hours)
    lp = _placed(_points(left, left_id, left_ts, left_lon, left_lat, "l_").distinct(), "l_", cell, bucket)
    rp = _placed(_points(right, right_id, right_ts, right_lon, right_lat, "r_").distinct(), "r_", cell, bucket)
    near, many = _rivals(lp, cell, bucket, max_km, max_hours, rivals)
    twice = rp.groupBy("r_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(F.col("r_id").alias("_id"))
    names = [c for x in (left_labels, right_labels) if x is not None for c in x.columns if c != "id"]
    near, l_other = _labelled(near, "l_id", left_labels)
    tagged, r_other = _labelled(rp, "r_id", right_labels)
    many = many if l_other is None else many.unionByName(l_other).distinct()
    twice = twice if r_other is None else twice.unionByName(r_other).distinct()

    def part(df: DataFrame, key: str, ids: DataFrame, how: str) -> DataFrame:
        return df.join(ids, F.col(key).eqNullSafe(F.col("_id")), how)

    def reach(df: DataFrame, of: DataFrame) -> DataFrame:
        # nothing to copy where nothing is in reach
        cells = of.select(*_KEYS).distinct()
        for k in _KEYS:
            cells = cells.withColumn(k, F.explode(_around(k)))
        return df.join(cells.distinct(), _KEYS, "left_semi")

    def meet(lp: DataFrame, rp: DataFrame) -> DataFrame:
        return _meet(lp, rp, cell, max_km, max_hours, space_side, partitions, hot_rows)

    pairs = meet(part(near, "l_id", many, "left_anti"), part(tagged, "r_id", twice, "left_anti"))
    # a lambda in its condition would take the join out of the generated code: no filter goes below what is exploded
    pairs = pairs.withColumn("_rivals", F.explode(F.array("_near")))
    order = lambda km, delay, lon, lat: F.struct(km, F.abs(delay), delay, lon, lat)
    mine = order(F.col("distance_km"), F.col("delay_seconds"), F.col("l_lon"), F.col("l_lat"))

    degrees = F.degrees(F.col("distance_km") / F.lit(EARTH_RADIUS_KM)) * (1 + 1e-6) + 1e-9

    def better(x: Column) -> Column:
        delay = F.col("r_sec") - x["sec"]
        # the cheaper tests go first
        return (F.abs(delay / F.lit(3600.0)) <= F.lit(float(max_hours))) & (
            (F.abs(x["lat"] - F.col("r_lat")) <= degrees) | (F.abs(x["lat"]) > 90) | (F.abs(F.col("r_lat")) > 90)) & (
            order(haversine_km(x["lat"], x["lon"], "r_lat", "r_lon"), delay, x["lon"], x["lat"]) < mine)
    kept = ["l_id", "r_id", "distance_km", "delay_seconds"]
    pairs = pairs.filter(F.col("_rivals").isNull() | ~F.exists("_rivals", better)).select(*kept, *names)
    l_many, l_few = part(lp, "l_id", many, "left_semi"), part(lp, "l_id", many, "left_anti")
    r_twice = part(rp, "r_id", twice, "left_semi")
    cand = meet(l_many, reach(rp, l_many)).unionByName(meet(reach(l_few, r_twice), r_twice))
    cand = cand.select("l_id", "r_id", "l_sec", "distance_km", "delay_seconds").withColumn("_abs", F.abs(F.col("delay_seconds")))
    rest = earliest(cand, ["l_id", "r_id"],
                    ["distance_km", "_abs", "delay_seconds", "l_sec"], nulls_last=False).select(*kept)
    for key, labels in (("l_id", left_labels), ("r_id", right_labels)):
        if labels is not None:
            rest = rest.join(labels.withColumnRenamed("id", "_lid"), F.col(key) == F.col("_lid")).drop("_lid")
    best = pairs.unionByName(rest)
    hours = F.col("delay_seconds") / F.lit(3600.0)
    dist = F.col("distance_km")
    if round_output:
        hours, dist = F.round(hours, 2), F.round(dist, 2)
    return best.select(F.col("l_id").alias(left_name), F.col("r_id").alias(right_name),
                       dist.alias("distance_km"), hours.alias("delay_hours"),
                       "delay_seconds", *names)


def time_band_join(left: DataFrame, right: DataFrame, *, max_hours: float,
                   left_id="id", left_ts="ts", right_id="id", right_ts="ts",
                   partitions: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """J1 alone: pairs whose whole-second times differ by at most
    ``max_hours`` (inclusive, symmetric). The key is the time bucket; the
    right side keeps its own, the left side is copied to the neighbours.
    ``partitions`` as in ``spacetime_candidates``."""
    bucket = F.lit(max(int(math.ceil(max_hours * 3600.0)), 1))
    lp = left.select(F.col(left_id).alias("l_id"), epoch_seconds(left_ts).alias("l_sec")).filter("l_sec IS NOT NULL")
    rp = right.select(F.col(right_id).alias("r_id"), epoch_seconds(right_ts).alias("r_sec")).filter("r_sec IS NOT NULL")
    lp, rp = spread(lp, partitions), spread(rp, partitions)
    lp = lp.withColumn("_tb", F.floor(F.col("l_sec") / bucket))
    rp = rp.withColumn("_tb", F.floor(F.col("r_sec") / bucket))
    near = F.array(F.col("_tb") - 1, F.col("_tb"), F.col("_tb") + 1)
    cells = _cells(lp, ["_tb"], "_ns", {"_tb": near}), _cells(rp, ["_tb"], "_nt", {})
    lp, rp, keys = _salted(lp.withColumn("_tb", F.explode(near)), rp, ["_tb"], *cells, hot_rows)
    if partitions:  # as in _meet
        lp, rp = lp.repartition(partitions, *keys), rp.repartition(partitions, *keys)
    delay = F.col("r_sec") - F.col("l_sec")
    j = lp.hint("merge").join(rp, keys)
    return j.filter(F.abs(delay / F.lit(3600.0)) <= F.lit(float(max_hours))).select(
        "l_id", "r_id", "l_sec", "r_sec", delay.alias("delay_seconds"))


def radius_join(left: DataFrame, right: DataFrame, *, max_km: float,
                left_id="id", left_lon="lon", left_lat="lat",
                right_id="id", right_lon="lon", right_lat="lat", **kw) -> DataFrame:
    """J2 alone: pairs within ``max_km`` (haversine), at any time; rows
    without a time match too. All times are one constant, so only the
    bucket of that time holds pairs."""
    zero = F.lit(0).cast("timestamp")
    out = spacetime_candidates(
        left.select(left_id, left_lon, left_lat).withColumn("_t0", zero),
        right.select(right_id, right_lon, right_lat).withColumn("_t0", zero),
        max_km=max_km, max_hours=None, left_id=left_id, left_ts="_t0", left_lon=left_lon, left_lat=left_lat,
        right_id=right_id, right_ts="_t0", right_lon=right_lon, right_lat=right_lat, **kw)
    return out.select("l_id", "r_id", "distance_km")
