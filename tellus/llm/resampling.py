"""Importance resampling towards a target distribution.

Words are hashed into buckets; a bucket's gain is the logarithm of how much
more often the target's texts use it than the documents do. Two passes over
the texts: one adds up the buckets (an array per task, then one aggregate of
``BUCKETS`` keys), one scores every document by the array of gains. A Gumbel
number from the doc_id makes the draw of the highest scores a weighted draw
without replacement.

The draw needs no global sort. Scores are persisted as narrow rows, then the
cutoff is found by bisection on numbers: each step is one exact count job,
first on the score, then on the doc_id of the rows that tie there, then on
the number of words. Only the rows drawn are range-partitioned and sorted;
a row's rank is its place in its range plus the sizes of the ranges before.

Defined cases:

* a null or empty text has no words: weight 0, and it is not eligible;
* ties go to the smaller doc_id, then to fewer words; rows that agree in all
  of that are the same row, counted with their number and drawn one by one;
* a null doc_id is drawn as if its text were empty (``2024:``) and comes
  after all others among ties;
* without documents there is no row; without target texts all gains follow
  from the documents alone (T = 0);
* texts of any length are worked on in bounded blocks; extra columns of any
  name are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tellus.llm import spans
from tellus.llm.common import small_batches, text_or_empty, written

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

# The alphabet of words, after lower-casing A-Z.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    """The remainders of all bytes, by the rule of the reflected polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def crc32s(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span: all spans a byte further at each step."""
    c = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    live, done = np.flatnonzero((lengths > 0) & (lengths <= spans.LONG_SPAN)), 0
    while live.size:
        x = c[live]
        c[live] = _CRC[(x ^ buf[starts[live] + done]) & 0xFF] ^ (x >> 8)
        done += 1
        live = live[lengths[live] > done]
    c = ~c
    for i in np.flatnonzero(lengths > spans.LONG_SPAN):
        c[i] = zlib.crc32(buf[starts[i]:starts[i] + lengths[i]])
    return c


def _edges(previous: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """A text may be cut before a byte that is in no word."""
    return ~_WORD[byte]


def _buckets(column: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bucket of every word, block by block."""
    data, offsets = spans.utf8(column)
    for buf, starts, row, _ in spans.blocks(data, offsets, _edges):
        text = _LOWER[buf]
        inside = _WORD[text[:starts[-1]]]
        turn = np.empty(len(inside) + 1, bool)
        turn[1:-1] = inside[1:] != inside[:-1]
        turn[0], turn[-1] = inside[0], inside[-1]
        # where parts meet, a word ends and another may begin
        meet = starts[1:-1][inside[starts[1:-1]] & inside[starts[1:-1] - 1]]
        edges = np.sort(np.concatenate([np.flatnonzero(turn), meet, meet]))
        begin, length = edges[::2], edges[1::2] - edges[::2]
        yield row[spans.owners(begin, starts)], (crc32s(text, begin, length) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(rows: DataFrame, text: Column, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` of all words of all texts; buckets without words are left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for b in batches:
            for _, bucket in _buckets(b.column(0), buckets):
                held += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["bucket", "n"])

    small_batches(rows.sparkSession)
    d = rows.select(text_or_empty(text).alias("t")).mapInArrow(count, "bucket long, n long")
    return d.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket from the counts of both sides: ``buckets``
    numbers, whatever the tables hold."""
    both = F.broadcast(source.sparkSession.range(buckets).withColumnRenamed("id", "bucket"))  # a fixed number of rows
    s = source.withColumnRenamed("n", "s").join(both, "bucket", "right")
    d = s.join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"]).select("bucket", "s", "t").toPandas()
    d = d.sort_values("bucket")
    s, t = d["s"].to_numpy(np.float64), d["t"].to_numpy(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(rows: DataFrame, of: np.ndarray, text: str = "text") -> DataFrame:
    """``rows`` with the column ``text`` (not null) replaced by ``n_features``
    and ``weight``, the floored mean gain of the words. The other columns are
    of simple types and pass through."""
    kept = [c for c in rows.columns if c != text]
    held = rows.sparkSession.sparkContext.broadcast(of)  # one number per bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = held.value
        for b in batches:
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for row, bucket in _buckets(b.column(text), len(gain)):
                n += np.bincount(row, minlength=b.num_rows)
                # sums of whole numbers below 2^53, exact in doubles
                total += np.bincount(row, gain[bucket], b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(n), pa.array(total // np.maximum(n, 1))],
                                             [*kept, "n_features", "weight"])

    small_batches(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text)
    return rows.mapInArrow(score, schema + ", n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """The rounded Gumbel number of a row, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def cutoff(rows: DataFrame, keys: Sequence[str], copies: str, wanted: int) -> tuple[list[int], int]:
    """The place of the ``wanted``-th row in the order of the integer columns
    ``keys``, where each row stands for ``copies`` equal ones: its keys, and
    how many of its copies are within. One count job for each bit of a key's
    range; ``wanted`` is at least 1 and at most the number of rows."""
    at: list[int] = []
    for key in keys:
        ends = rows.agg(F.min(key), F.max(key)).first()
        lo, hi = int(ends[0]), int(ends[1])
        while lo < hi:  # the smallest value with enough rows up to it
            mid = (lo + hi) // 2
            if (rows.filter(F.col(key) <= mid).agg(F.sum(copies)).first()[0] or 0) >= wanted:
                hi = mid
            else:
                lo = mid + 1
        wanted -= rows.filter(F.col(key) < lo).agg(F.sum(copies)).first()[0] or 0
        at.append(lo)
        rows = rows.filter(F.col(key) == lo)
    return at, wanted


def ranked(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 1) in the order of ``keys``: ranges of
    rows, sorted each by its own task, and the sizes of the ranges before."""
    d = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the number holds the range in its upper bits and the place in it in the lower 33
    d = written(d.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    d = d.withColumn("_range", F.shiftright("_place", 33)).withColumn("_place", F.col("_place").bitwiseAND((1 << 33) - 1))
    before, at = [], 0
    for r in sorted(d.groupBy("_range").agg((F.max("_place") + 1).alias("n")).collect()):  # a row per range
        before.append((r._range, at))
        at += r.n
    before = d.sparkSession.createDataFrame(before, "_range long, _before long")
    return d.join(F.broadcast(before), "_range").withColumn("rank", F.col("_before") + F.col("_place") + 1).drop("_range", "_place", "_before")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document (an
    integer ``doc_id``, a ``text``): drawn are ``percent`` of those with at
    least ``min_words`` words; ``rank`` is null for the rest."""
    of = gains(bucket_counts(docs, F.col("text"), buckets), bucket_counts(target, F.col("text"), buckets), buckets)
    d = weigh(docs.select("doc_id", text_or_empty(F.col("text")).alias("text")), of)
    d = d.groupBy("doc_id", "n_features", "weight").agg(F.count(F.lit(1)).alias("copies"))
    d = d.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    d = written(d.withColumn("down", -F.col("score")).withColumn("last_id", F.coalesce("doc_id", F.lit((1 << 63) - 1))), "scores")
    fit = d.filter(F.col("n_features") >= min_words)
    wanted = (fit.agg(F.sum("copies")).first()[0] or 0) * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    each = d.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    if not wanted:
        return each.select(*out, F.lit(None).cast("long").alias("rank"))
    keys = ["down", "last_id", "n_features"]
    at, within = cutoff(fit, keys, "copies", wanted)
    drawn = F.col("copy") <= within
    for key, value in reversed([*zip(keys, at)]):
        drawn = (F.col(key) < value) | ((F.col(key) == value) & drawn)
    drawn = drawn & (F.col("n_features") >= min_words)
    won = ranked(each.filter(drawn), [*keys, "copy"])
    return won.select(*out, "rank").unionByName(each.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))


def oracle_sql() -> str:
    """Words are told apart before their CRC-32 is worked out byte by byte."""
    return rf"""
WITH RECURSIVE crc(i, k, c) AS (SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
tab AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
words AS (SELECT TRUE AS doc, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL SELECT FALSE, NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
hexed AS MATERIALIZED (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM words)),
hashed AS MATERIALIZED (SELECT w, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, length(x), 2), lambda j: ('0x' || x[j + 1:j + 2])::BIGINT)),
      lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % {BUCKETS} AS bucket FROM hexed, tab),
used AS MATERIALIZED (SELECT doc, doc_id, bucket FROM words JOIN hashed USING (w)),
counts AS (SELECT range AS bucket, count(*) FILTER (doc) AS s, count(*) FILTER (NOT doc) AS t FROM range({BUCKETS}) LEFT JOIN used ON bucket = range GROUP BY ALL),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS}) / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS}))))::BIGINT AS g FROM counts),
per AS (SELECT doc_id, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM used JOIN gain USING (bucket) WHERE doc GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM documents d LEFT JOIN per USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * {PERCENT} // 100 AS k FROM scored WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)"""
