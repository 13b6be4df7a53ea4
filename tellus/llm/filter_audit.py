"""Filter interaction audit: what each of five filters removes, alone and
behind the others, over every order of applying them.

One finite-state pass over the UTF-8 bytes of a text, driven by two tables
(class of a byte; state and class to emissions), counts words, capitals, code
points and symbols. The word spans it marks go into a verified hash table, so
distinct words are counted by their bytes. A document becomes five failure
bits; all orders follow from how many documents have each of the 32 patterns,
so the audit costs one pass over the texts and aggregates of narrow rows.

Failures: A under 100 words; B under 80 % of the words distinct; C capitals
above 10 % of the code points; D a symbol; E the text of a smaller doc_id.

Defined cases:

* a null text is empty; an empty text fails A, and E like any other text; it
  does not fail B, C or D;
* a null language is the part ``""``; rows of an empty table give no part;
* E compares doc_ids: of repeated rows with one doc_id none has a smaller
  one; a null doc_id is not smaller than another and fails nothing by E;
* a document without a label row loses nothing good or toxic; of several
  label rows one with a 1 counts; label rows without a doc_id are not used;
* texts of any length are worked on in bounded blocks; extra columns of any
  name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tellus.llm import spans
from tellus.llm.common import small_batches, text_or_empty

FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10

# Classes of bytes. Words end at white space; a code point starts at a byte
# that does not continue one.
_SPACE, _PLAIN, _CAPITAL, _SYMBOL, _MORE = range(5)
_CLASS = np.full(256, _PLAIN, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("A"):ord("Z") + 1] = _CAPITAL
_CLASS[[ord(c) for c in "#$%&*|"]] = _SYMBOL
_CLASS[0x80:0xC0] = _MORE

# States: between words, inside a word. Emissions are bits.
_BETWEEN, _INSIDE = 0, 8
_START, _END, _CAP, _SYM, _CONT = 1, 2, 4, 8, 16
_NEXT = np.where(np.arange(8) == _SPACE, _BETWEEN, _INSIDE).astype(np.uint8)  # by class, whatever the state
_EMIT = np.zeros(16, np.uint8)  # by state | class
for _c, _bits in ((_CAPITAL, _CAP), (_SYMBOL, _SYM), (_MORE, _CONT)):
    _EMIT[[_BETWEEN | _c, _INSIDE | _c]] = _bits
for _c in (_PLAIN, _CAPITAL, _SYMBOL, _MORE):
    _EMIT[_BETWEEN | _c] |= _START
_EMIT[_INSIDE | _SPACE] |= _END


def _edges(previous: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """A text may be cut before white space."""
    return _CLASS[byte] == _SPACE


def transduce(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over ``text``, whose parts begin at ``starts``: emissions of
    each byte, then the starts and lengths of words. The state before a byte
    is what the byte before it led to, or ``between`` where a part begins."""
    classes = _CLASS[text]
    state = np.empty(len(text) + 1, np.uint8)
    state[1:] = _NEXT[classes]
    last = state[starts[1:]].copy()  # the state at the end of each part
    state[starts[:-1]] = _BETWEEN
    emitted = _EMIT[state[:-1] | classes]
    begin = np.flatnonzero((emitted & _START) != 0)
    stop = np.concatenate([np.flatnonzero((emitted & _END) != 0), starts[1:][last == _INSIDE]])
    stop.sort()
    return emitted, begin, stop - begin


def _signals(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of each row."""
    rows = len(offsets) - 1
    out = np.zeros((rows, 5), np.int64)
    out[:, 3] = np.diff(offsets)
    parted: dict[int, list[np.ndarray]] = {}  # of rows in several parts: spans of distinct words, in data
    for buf, starts, row, base in spans.blocks(data, offsets, _edges):
        emitted, begin, length = transduce(buf[:starts[-1]], starts)
        part = spans.owners(begin, starts)
        owner = row[part]
        entry, _, _ = spans.insert(buf, begin, length, owner)
        first = entry == np.arange(len(entry))
        np.add.at(out[:, 0], row, np.bincount(part, minlength=len(row)))
        np.add.at(out[:, 1], row, np.bincount(part[first], minlength=len(row)))
        for bit, column, sign in ((_CAP, 2, 1), (_CONT, 3, -1), (_SYM, 4, 1)):
            at = spans.owners(np.flatnonzero((emitted & bit) != 0), starts)
            np.add.at(out[:, column], row, sign * np.bincount(at, minlength=len(row)))
        for r, whole in ((row[0], starts[0] + base == offsets[row[0]]), (row[-1], starts[-1] + base == offsets[row[-1] + 1])):
            if not whole or r in parted:
                mine = first & (owner == r)
                parted.setdefault(int(r), []).append(np.stack([begin[mine] + base, length[mine]]))
    for r, found in parted.items():
        a, b = int(offsets[r]), int(offsets[r + 1])
        buf = np.zeros(b - a + 8, np.uint8)
        buf[:b - a] = data[a:b]
        begin, length = np.unique(np.concatenate(found, axis=1), axis=1)
        entry, _, _ = spans.insert(buf, begin - a, length)
        out[r, 1] = np.count_nonzero(entry == np.arange(len(entry)))
    return out


SIGNALS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def signals(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the column ``text`` (not null) replaced by the counts of
    ``SIGNALS``; the other columns are of simple types and pass through."""
    kept = [c for c in rows.columns if c != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = _signals(*spans.utf8(b.column(text)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(found[:, i]) for i in range(5)], [*kept, *SIGNALS])

    small_batches(rows.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text)
    return rows.mapInArrow(count, schema + "".join(f", {s} long" for s in SIGNALS))


def failures() -> Column:
    """The bits of the filters A to D that the counts of a row fail."""
    a = F.col("n_words") < MIN_WORDS
    b = 100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words")
    c = 100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_points")
    d = F.col("n_symbols") > 0
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate((a, b, c, d))), F.lit(0))


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How many documents of each part fail each set of filters: ``part,
    pattern`` (bit i is the filter i), ``n, good, toxic``.

    Texts are told apart by SHA-256. Rows are counted by document before
    labels come in and by text before the smallest doc_id is sought, so a
    text that a third of all rows share is a few narrow rows by then.
    """
    d = docs.select(F.col("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), text_or_empty(F.col("text")).alias("text"))
    d = signals(d.withColumn("digest", F.unhex(F.sha2("text", 256))))
    d = d.groupBy("doc_id", "part", "digest", failures().alias("pattern")).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_of")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    d = d.join(marks, F.col("doc_id") == F.col("_of"), "left")
    kind = ["digest", "part", "pattern", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    # several rows may carry the smallest doc_id
    d = d.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("unnamed"),
        F.min_by("n", "doc_id").alias("at_low"))
    d = d.withColumn("least", F.min("low").over(Window.partitionBy("digest")))
    safe = F.when(F.col("low") == F.col("least"), F.col("at_low")).otherwise(0) + F.coalesce("unnamed", F.lit(0))
    e = 1 << FILTERS.index("E")
    outcomes = F.array(F.struct(F.col("pattern").alias("pattern"), safe.alias("n")),
                       F.struct((F.col("pattern") + e).alias("pattern"), (F.col("n") - safe).alias("n")))
    d = d.select("part", "good", "toxic", F.inline(outcomes)).filter("n > 0")
    return d.groupBy("part", "pattern").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def orders() -> list[tuple[str, int, int, int]]:
    """Every step of every order: the order, the step, the bit of its filter
    and the bits of the filters before it."""
    out = []
    for p in permutations(FILTERS):
        before = 0
        for step, f in enumerate(p, 1):
            bit = 1 << FILTERS.index(f)
            out.append(("".join(p), step, bit, before))
            before |= bit
    return out


def interactions(counts: DataFrame) -> DataFrame:
    """The report over all orders from the counts of ``patterns``: one row
    per part, order and step. A part is 32 numbers, whatever its documents."""
    def line(name: str) -> Column:
        return F.array(*[F.coalesce(F.max(F.when(F.col("pattern") == p, F.col(name))), F.lit(0)) for p in range(1 << len(FILTERS))])

    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before"))
                      for o, s, bit, before in orders()])
    d = counts.groupBy("part").agg(line("n").alias("n"), line("good").alias("good"), line("toxic").alias("toxic"))
    d = d.select("part", "n", "good", "toxic", F.inline(steps))
    bit, before = F.col("bit"), F.col("before")

    def total(line: str, wanted) -> Column:
        values = F.transform(F.col(line), lambda n, p: F.when(wanted(p), n).otherwise(F.lit(0).cast("long")))
        return F.aggregate(values, F.lit(0).cast("long"), lambda x, y: x + y)

    fails = lambda p: p.bitwiseAND(bit) != 0
    earlier = lambda p: p.bitwiseAND(before) != 0
    removed = lambda p: fails(p) & ~earlier(p)
    # a document that fails k filters is removed by each of them in 120 / k of the orders
    share = F.transform("n", lambda n, p: F.when(fails(p), n * (F.lit(120) / F.bit_count(p)).cast("long")).otherwise(F.lit(0).cast("long")))
    return d.select(
        "part", "filter_order", "step", total("n", lambda p: ~fails(p) & ~earlier(p)).alias("kept"), total("n", removed).alias("removed"),
        total("n", lambda p: fails(p) & earlier(p)).alias("redundant"), total("n", lambda p: p == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"), total("toxic", removed).alias("toxic_lost"),
        F.aggregate(share, F.lit(0).cast("long"), lambda x, y: x + y).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(patterns(docs, labels))


def oracle_sql() -> str:
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
m AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(l.quality, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic,
        (len(ws) < {MIN_WORDS})::INT + (100 * len(list_distinct(ws)) < {DISTINCT_PERCENT} * len(ws))::INT * 2
        + (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(t))::INT * 4
        + regexp_matches(t, '[#$%&*|]')::INT * 8 + coalesce(m.low < w.doc_id, FALSE)::INT * 16 AS p
      FROM w JOIN m USING (t) LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, p, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, p),
x AS (SELECT unnest(['A','B','C','D','E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
      FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
        AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, bit,
        coalesce(sum(n) FILTER (p & bit = 0 AND p & before = 0), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (p & bit <> 0 AND p & before = 0), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (p & bit <> 0 AND p & before <> 0), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (p = bit), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (p & bit <> 0 AND p & before = 0), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (p & bit <> 0 AND p & before = 0), 0)::BIGINT AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM r"""
