"""Feed sources.

Records travel as raw JSON text; parsing uses explicit schemas and the
``try_``/``from_json`` forms (malformed input never fails the job, it
becomes NULL and can be quarantined).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tellus import schemas as SC
from tellus.operators.partitioning import spread


# ------------------------------------------------------------- envelopes

def unnest_envelope(df: DataFrame, array_field: str, *, value_col: str = "value",
                    key_field: str = "id", require_key: bool = False) -> DataFrame:
    """``{"<array_field>": [rec, ...]}`` text -> one row per record
    ``(key, value)`` where ``value`` is the record's JSON text, untouched.

    Reading the array as ``array<string>`` keeps each element's raw text
    (no re-serialisation). ``require_key`` drops records whose key is NULL or
    empty (the quake collector skips records without id).
    """
    env = F.from_json(F.col(value_col), T.StructType([
        T.StructField(array_field, T.ArrayType(T.StringType()))]))
    recs = df.select(F.explode(env[array_field]).alias("value"))
    out = recs.select(F.get_json_object("value", f"$.{key_field}").alias("key"), "value")
    if require_key:
        out = out.filter(F.col("key").isNotNull() & (F.col("key") != ""))
    return out


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """One row per envelope file (``value`` = whole file text). Envelopes are
    single API responses, bounded by the API page size."""
    return spark.read.text(path, wholetext=True)


def reference_rows(df: DataFrame, array_field: str, *, value_col: str = "value",
                   schema: T.StructType = SC.SOURCE_RECORD, fallback: str | None = "source",
                   url_field: str = "url") -> DataFrame:
    """Reference-data envelope (categories or sources) -> rows. For
    sources, the address falls back to the second field and rows without
    any address are skipped."""
    env = F.from_json(F.col(value_col), T.StructType([
        T.StructField(array_field, T.ArrayType(schema))]))
    rows = df.select(F.explode(env[array_field]).alias("r")).select("r.*")
    if fallback and fallback in rows.columns:
        url = F.coalesce(F.nullif(F.col(url_field), F.lit("")), F.nullif(F.col(fallback), F.lit("")))
        rows = rows.withColumn(url_field, url).drop(fallback).filter(F.col(url_field).isNotNull())
    return rows


# --------------------------------------------------- collection windows

def event_window(records: DataFrame, *, as_of=None, days: int | None = None,
                 status: str = "open", limit: int | None = None,
                 date_col: Column | None = None) -> DataFrame:
    """S3: open (or closed/all) events seen in the last ``days``; with a
    ``limit``, the newest so many. The date is the latest geometry point."""
    as_of_c = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    r = records
    if status == "open":
        r = r.filter(F.col("closed").isNull())
    elif status == "closed":
        r = r.filter(F.col("closed").isNotNull())
    last = date_col if date_col is not None else F.array_max(
        F.transform("geometry", lambda g: F.try_to_timestamp(g["date"])))
    r = r.withColumn("_last", last)
    if days is not None:
        r = r.filter(F.col("_last") >= as_of_c - F.make_dt_interval(F.lit(days)))
    if limit is not None:
        r = r.orderBy(F.col("_last").desc_nulls_last(), F.col("id")).limit(limit)
    return r.drop("_last")


def quake_window(records: DataFrame, *, start=None, end=None, min_magnitude: float | None = None,
                 limit: int | None = None) -> DataFrame:
    """Quakes between ``start`` and ``end`` with magnitude at least
    ``min_magnitude``; with a ``limit``, the newest so many."""
    t = F.timestamp_millis(F.col("properties.time"))
    r = records
    if start is not None:
        r = r.filter(t >= F.lit(start).cast("timestamp"))
    if end is not None:
        r = r.filter(t <= F.lit(end).cast("timestamp"))
    if min_magnitude is not None:
        r = r.filter(F.col("properties.mag") >= min_magnitude)
    if limit is not None:
        r = r.orderBy(t.desc_nulls_last(), F.col("id")).limit(limit)
    return r


# ------------------------------------------------------------ lake scans

#: The order of arrival of a lake line.
SEQ = T.StructType([T.StructField("hour", T.TimestampType()), T.StructField("batch", T.LongType()), T.StructField("part", T.IntegerType()),
                    T.StructField("chunk", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("block", T.LongType()),
                    T.StructField("row", T.LongType())])


def lake_lines(spark: SparkSession, base: str, *, source: str | None = None,
               hours: tuple[str, str] | None = None) -> DataFrame | None:
    """K9: the lines of the raw lake with their place in it: ``value``, the
    partition columns, ``_file`` and ``_seq``, the order of arrival. None
    where there is no lake.

    Arrival is read off what the writer left: landing hour, then micro-batch
    (the ``batch`` folder, where the writer makes one), then the number of
    the writing task and of its file (other writers' timestamped names order
    by name), then the place in the file. A scan reads each block of a file
    from top to bottom in one task, so the block's start and the row's
    number in its scan partition give that place without counting lines.
    """
    try:
        raw = spark.read.option("basePath", base).text(base)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    if "source" not in raw.columns:
        return None
    if source is not None:
        raw = raw.filter(F.col("source") == source)
    if hours is not None:
        key = F.format_string("%04d-%02d-%02d %02d", "year", "month", "day", "hour")
        raw = raw.filter(key.between(hours[0], hours[1]))
    return raw.select("*", F.col("_metadata.file_path").alias("_file"), arrival("batch" in raw.columns).alias("_seq"))


def arrival(batch: bool, row: Column | None = None, name: Column | None = None, block: Column | None = None) -> Column:
    """The order of arrival of a scanned lake line, as a struct that sorts."""
    name = F.col("_metadata.file_name") if name is None else name
    own = F.regexp_extract(name, r"^part-(\d+)-.*[.]c(\d+)", 1), F.regexp_extract(name, r"^part-(\d+)-.*[.]c(\d+)", 2)
    part, chunk = (F.when(x != "", x.cast("int")) for x in own)
    numbered = part.isNotNull() & F.lit(batch)
    return F.struct(
        landing_hour().alias("hour"), (F.col("batch").cast("long") if batch else F.lit(None).cast("long")).alias("batch"),
        part.alias("part"), chunk.alias("chunk"), F.when(~numbered, name).alias("name"),
        (F.col("_metadata.file_block_start") if block is None else block).alias("block"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"))


def landing_hour() -> Column:
    return F.make_timestamp(*[F.col(c).cast("int") for c in ("year", "month", "day", "hour")], F.lit(0), F.lit(0))


def read_lake(spark: SparkSession, base: str, source: str, schema: T.StructType,
              *, hours: tuple[str, str] | None = None) -> DataFrame:
    """Read one feed of the raw lake.

    The lake is ``base/source=<s>/year=/month=/day=/hour=/[batch=/]*``;
    partition discovery keeps those columns, so ``source`` and the optional
    ``hours`` range ('YYYY-MM-DD HH' bounds) prune directories. Lines are
    parsed with the explicit ``schema``; the result also carries
    ``_raw`` (line text), ``_corrupt`` (true when the line is not a JSON
    object), ``_file``, ``_ingested_at`` (the hour under which the line was
    landed) and ``_seq`` (the order of arrival, see ``lake_lines``), so the
    later of two lines of one hour is the later one, and rewriting files
    (``compact``) changes no "latest" row. A missing lake returns an empty
    frame (S9).
    """
    lines = lake_lines(spark, base, source=source, hours=hours)
    if lines is None:
        return empty_feed(spark, schema)
    return parse_records(lines.select(F.col("value").alias("_raw"), "_file", landing_hour().alias("_ingested_at"), "_seq"), schema)


def corrupt_lines(feed: DataFrame) -> DataFrame:
    """T5: the lines of a parsed feed that hold no JSON object, for the
    quarantine table: source file, landing hour and text."""
    return feed.filter("_corrupt").select(F.col("_file").alias("file"), F.col("_ingested_at").alias("ingested_at"), F.col("_raw").alias("line"))


def parse_records(df: DataFrame, schema: T.StructType, raw_col: str = "_raw",
                  partitions: int | None = None) -> DataFrame:
    """Parse JSON lines with a fixed schema (PERMISSIVE: a wrong-typed field
    becomes NULL, a malformed line becomes an all-NULL record, M8)."""
    df = spread(df, partitions)
    parsed = F.from_json(F.col(raw_col), schema)
    corrupt = is_broken(F.col(raw_col))
    return df.select(parsed.alias("_r"), "*").select(
        "_r.*", *[c for c in df.columns], corrupt.alias("_corrupt"))


def is_broken(text: Column) -> Column:
    """True for a text that is not a JSON object, and for NULL."""
    return F.try_parse_json(text).isNull() | ~F.startswith(F.ltrim(text), F.lit("{"))


def empty_feed(spark: SparkSession, schema: T.StructType) -> DataFrame:
    extra = [T.StructField("_raw", T.StringType()), T.StructField("_file", T.StringType()),
             T.StructField("_ingested_at", T.TimestampType()), T.StructField("_seq", SEQ),
             T.StructField("_corrupt", T.BooleanType())]
    return spark.createDataFrame([], T.StructType(list(schema.fields) + extra))


def is_ready(*feeds: DataFrame) -> bool:
    """Every feed has at least one record (one tiny job per feed; the
    retry loop belongs to the scheduler)."""
    return all(not f.isEmpty() for f in feeds)
