"""Sinks (K1, K4-K8): snapshots under one atomic manifest, changes that
rewrite only the buckets they touch (J9), report append, and thin JDBC /
Kafka adapters (their jars are not bundled)."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellus.operators.dedup import earliest, latest
from tellus.operators.merge import without_keys
from tellus.session import scratch_path

MANIFEST = "_MANIFEST"
_MANIFEST_ROW = "version long, id string, load string, table_name string, path string, bucket int, layout string"
#: Buckets of a new bucketed table; about its bytes / 256 MB on a cluster.
BUCKETS = 32


@dataclass(frozen=True)
class Buckets:
    """A table dealt out by a hash of its keys: one folder per bucket that
    has rows, of any of the snapshots that were ever published."""
    keys: tuple[str, ...]
    count: int
    schema: T.StructType
    folders: dict[int, str]

    def read(self, spark: SparkSession, only: set[int] | None = None) -> DataFrame:
        held = [p for b, p in sorted(self.folders.items()) if only is None or b in only]
        return spark.read.schema(self.schema).parquet(*held) if held else spark.createDataFrame([], self.schema)

    def of(self) -> Column:
        """The bucket of a row whose keys have the table's types."""
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.count)).cast("int")

    def touched(self, df: DataFrame) -> set[int]:
        return {r.b for r in df.select(self.of().alias("b")).distinct().collect()}  # at most one row per bucket

    def fit(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``columns`` of ``df`` with the table's types, on which the hash depends."""
        return df.select(*[F.col(f"`{c}`").cast(self.schema[c].dataType).alias(c) for c in columns])

    def layout(self) -> str:
        return json.dumps({"keys": self.keys, "count": self.count, "schema": self.schema.jsonValue()})


@dataclass(frozen=True)
class Change:
    """Rows that come into a table and the keys whose held rows go (``gone``;
    the keys of ``rows`` where it is None). Keys need not be unique.
    ``buckets`` is the number of a table that is not yet bucketed."""
    rows: DataFrame
    keys: Sequence[str]
    gone: DataFrame | None = None
    buckets: int = BUCKETS


class Version:
    """One published version of a set of tables: all reads see the same load,
    however many versions are published meanwhile. A table is one folder
    (``paths``) or bucketed (``buckets``)."""

    def __init__(self, spark: SparkSession, version: int, load: str | None, paths: dict[str, str],
                 buckets: dict[str, Buckets] | None = None):
        self.spark, self.version, self.load, self.paths, self.buckets = spark, version, load, paths, buckets or {}

    def read(self, name: str) -> DataFrame:
        if name in self.buckets:
            return self.buckets[name].read(self.spark)
        if name not in self.paths:
            raise FileNotFoundError(f"no snapshot for {name}")
        return self.spark.read.parquet(self.paths[name])

    def __contains__(self, name: str) -> bool:
        return name in self.paths or name in self.buckets

    @property
    def tables(self) -> list[str]:
        return sorted([*self.paths, *self.buckets])


def pin(spark: SparkSession, base: str, version: int | None = None) -> Version:
    """The latest published version of the tables under ``base``, or an
    earlier one by its number. Where nothing is published the version is 0
    and has no tables."""
    try:
        log = spark.read.schema(_MANIFEST_ROW).parquet(f"{base.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return Version(spark, 0, None, {})
        raise
    if version is not None:
        log = log.filter(F.col("version") == version)
    # two publishers may have taken one number: the same one of them wins for every reader
    last = log.agg(F.max(F.struct("version", "id")).alias("m")).first().m
    if last is None:
        return Version(spark, 0, None, {})
    rows = log.filter((F.col("version") == last.version) & (F.col("id") == last.id)).collect()  # a row per table or bucket
    buckets = {}
    for r in rows:
        if r.layout is not None:
            at = json.loads(r.layout)
            folders = {x.bucket: x.path for x in rows if x.table_name == r.table_name and x.bucket is not None}
            buckets[r.table_name] = Buckets(tuple(at["keys"]), at["count"], T.StructType.fromJson(at["schema"]), folders)
    return Version(spark, last.version, rows[0].load, {r.table_name: r.path for r in rows if r.table_name not in buckets}, buckets)


def _bucketed(now: Version, name: str, change: Change, path: str) -> Buckets:
    """Write the buckets that ``change`` touches to ``path``; all others stay
    the folders they are."""
    spark, held = now.spark, now.buckets.get(name)
    rows, keys = change.rows, list(change.keys)
    if held is None:
        table = Buckets(tuple(keys), change.buckets, rows.schema, {})
        old = now.read(name) if name in now else None  # a table of one folder is dealt out once
        if old is not None:
            table = Buckets(tuple(keys), change.buckets, old.schema, {})
        touched = None
    else:
        if list(held.keys) != keys:
            raise ValueError(f"{name} is bucketed by {held.keys}, not by {tuple(keys)}")
        table = held
    rows = table.fit(rows, table.schema.names)
    gone = None if change.gone is None else table.fit(change.gone, keys)
    if held is not None:
        # written first: buckets are chosen and filled from the same rows, also after a lost executor
        rows = materialize(spark, rows, "change")
        gone = None if gone is None else materialize(spark, gone, "gone")
        touched = table.touched(rows.select(*keys) if gone is None else rows.select(*keys).unionByName(gone))
        old = held.read(spark, touched)
    if old is not None:
        rows = without_keys(old, (rows.select(*keys) if gone is None else gone).distinct(), keys).unionByName(rows)
    b = "_bucket"
    while b in table.schema.names:
        b = "_" + b
    # a large bucket is split between tasks, small ones share a task
    rows.withColumn(b, table.of()).hint("rebalance", b).write.mode("errorifexists").partitionBy(b).parquet(path)
    files = spark.read.schema(table.schema).parquet(path).inputFiles()
    written = {int(m) for f in files for m in re.findall(rf"/{b}=(\d+)/", f)}
    if touched is not None and not written <= touched:
        raise RuntimeError(f"{name}: rows came into buckets that the change does not touch")
    kept = {n: p for n, p in table.folders.items() if touched is not None and n not in touched}
    return Buckets(table.keys, table.count, table.schema, kept | {n: f"{path}/{b}={n}" for n in written})


def merge_change(now: Version, name: str, source: DataFrame, keys: Sequence[str], *, on_match: str = "update",
                 order_by: Sequence[str] = (), buckets: int = BUCKETS) -> Change:
    """J9 by file: what ``merge.merge`` does to the table ``name`` of ``now``
    (keys unique, compared null-safely) as a change that rewrites the touched
    buckets only. ``update``: the last writer wins; ``ignore``: only keys
    that the table does not have come in."""
    if on_match not in ("update", "ignore"):
        raise ValueError("on_match must be 'update' or 'ignore'")
    held = now.buckets.get(name)
    if held is not None:
        source = held.fit(source, held.schema.names)
    if on_match == "update":
        return Change(latest(source, keys, list(order_by), nulls_first=False), keys, buckets=buckets)
    first = earliest(source, keys, list(order_by), nulls_last=True)
    if held is not None:
        first = materialize(now.spark, first, "first")
        first = without_keys(first, held.read(now.spark, held.touched(first)), keys)
    elif name in now:
        first = without_keys(first, now.read(name), keys)
    return Change(first, keys, buckets=buckets)


def merge_table(spark: SparkSession, base: str, name: str, source: DataFrame, keys: Sequence[str], *,
                load: str | None = None, **how) -> Version:
    """Merge ``source`` into the published table ``name`` (``merge_change``)
    and publish the result. At most as many buckets are rewritten as the
    source has keys."""
    return publish_tables({name: merge_change(pin(spark, base), name, source, keys, **how)}, base, load=load)


def publish_tables(tables: Mapping[str, DataFrame | Change], base: str, *, load: str | None = None, partition_by=None,
            max_records_per_file: int | None = None) -> Version:
    """K4 / K5 / K7: write a new immutable snapshot of each of ``tables``,
    then make all of them visible at once by appending one file to the
    manifest, which names the snapshot of every table (those not written
    here keep theirs). Of a table given as a ``Change`` only the buckets it
    touches are written. That file appears when its job commits, so a reader
    sees all tables of the old version or all of the new one; a failure
    before that leaves the old version (the reference truncated first and
    could be left empty, or with parents and children of different loads).
    ``load`` names what the version holds, for loads that must not be
    applied twice. One publisher at a time."""
    base = base.rstrip("/")
    first = next(iter(tables.values()))
    spark = (first.rows if isinstance(first, Change) else first).sparkSession
    paths = {name: f"{base}/{name}/snap={uuid.uuid4().hex}" for name in tables}
    before, buckets = pin(spark, base), {}

    def write(name: str) -> None:
        if isinstance(tables[name], Change):
            buckets[name] = _bucketed(before, name, tables[name], paths[name])
            return
        w = tables[name].write.mode("errorifexists")
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", max_records_per_file)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(paths[name])
    _at_once(write, list(tables))
    number, key, load = before.version + 1, uuid.uuid4().hex, load if load is not None else before.load
    held = {n: p for n, p in (before.paths | paths).items() if n not in buckets}
    dealt = {n: b for n, b in before.buckets.items() if n not in paths} | buckets
    rows = [(number, key, load, n, p, None, None) for n, p in sorted(held.items())]
    for n, b in sorted(dealt.items()):
        rows.append((number, key, load, n, None, None, b.layout()))
        rows += [(number, key, load, n, p, i, None) for i, p in sorted(b.folders.items())]
    spark.createDataFrame(rows, _MANIFEST_ROW).coalesce(1).write.mode("append").parquet(f"{base}/{MANIFEST}")
    return Version(spark, number, load, held, dealt)


def write_snapshot(df: DataFrame, base: str, name: str, **options) -> str:
    """Publish a new snapshot of the one table ``name``; returns its path."""
    return publish_tables({name: df}, base, **options).paths[name]


def read_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table ``name`` of the latest version under ``base``, which may be
    a folder inside the published one. Several tables of one version are
    read through ``pin``."""
    here = pin(spark, base)
    if name not in here:
        parent, _, leaf = base.rstrip("/").rpartition("/")
        above = pin(spark, parent) if parent else here
        if f"{leaf}/{name}" in above:
            return above.read(f"{leaf}/{name}")
    return here.read(name)


def write_tables(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    held = publish_tables(tables, base).paths
    return {n: held[n] for n in tables}


def append_report(report: DataFrame, path: str) -> None:
    """K8: append audit rows, partitioned by run."""
    report.write.mode("append").partitionBy("run_id").parquet(path)


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    returned frame's lineage starts at the written files, so a lost
    executor recomputes from there."""
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def _at_once(write, items: list, max_workers: int = 4) -> None:
    """Call ``write`` for each item from a few driver threads: each write is
    its own Spark job, so jobs that cannot fill the cluster on their own
    (small tables, narrow stages) overlap. The first failure is raised."""
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        for done in [pool.submit(write, x) for x in items]:
            done.result()


def write_parquet_all(items: list[tuple[DataFrame, str]], max_workers: int = 4,
                      mode: str = "errorifexists") -> None:
    """Write independent frames concurrently."""
    _at_once(lambda x: x[0].write.mode(mode).parquet(x[1]), items, max_workers)


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict) -> None:
    """K6: append over JDBC (needs the database driver on the classpath)."""
    df.write.mode("append").jdbc(url, table, properties=properties)


def publish(df: DataFrame, topic: str, servers: str, key: str = "key", value: str = "value") -> None:
    """K1: keyed publish (needs the Kafka connector on the classpath)."""
    (df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
       .write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())
