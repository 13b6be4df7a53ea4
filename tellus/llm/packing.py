"""Best-fit packing of token sequences, planned on a histogram of lengths.

Texts become token ids (a public tokenizer file) with an end id; only those
longer than the capacity are cut, into pieces of the capacity. Pieces above
one third of the capacity are matched greedily, the longest with the longest
that still fits, so a bin holds two of them at most; smaller pieces then go,
longest first, into the smallest gap that holds them.

The plan is made on the histogram of lengths alone. It has one entry per
length, at most ``capacity`` of them, whatever the number of pieces, and
whole runs of equal bins are filled at a time. A run that takes items keeps
less than half of its gap, so a run is used 12 times at most for a capacity
of 4096 and the plan stays under 250,000 steps: small enough to broadcast.
Pieces get a rank within their length (two-level, so that a length shared by
most rows is spread over many tasks), and the plan maps (length, rank) to a
bin and an offset.

Defined cases: a null text is empty; an empty text is the end id alone;
repeated rows and null ids are packed like any other; extra columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from bisect import bisect_left, insort
from collections.abc import Collection, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm.common import give_back, small_batches, text_or_empty, written

CAPACITY = 4096
END_ID = 1
#: Entries of a task's cache of words; it is emptied beyond.
CACHE_WORDS = 500_000
#: Pieces ranked in one group, about.
RANK_ROWS = 10_000
#: Steps of a plan up to which it is broadcast.
PLAN_STEPS = 250_000

_TAIL = ".,;:!?"
# the byte alphabet of byte-level tokenizers: printable bytes stand for
# themselves, the others for the characters from 256 on
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: (chr(b) if b in _PLAIN else chr(256 + sum(o not in _PLAIN for o in range(b)))) for b in range(256)}
# white space for Python that the tokenizer takes for ordinary characters
_NOT_SPACE = re.compile("[\x1c-\x1f]")
# whether an array of unsigned integers has the layout of packed ids
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


def _pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if _NATIVE else np.array(ids, "<u4").tobytes()


class WordEncoder:
    """Encodes texts word by word: the tokenizer's matches never hold white
    space, so the ids of a text are those of its words, one after the other.
    Words seen before come from a bounded cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {}  # packed ids

    def encode(self, parts: list[str], simple: bool) -> dict[str, bytes]:
        """Packed ids of parts of words. In a simple text (lower case, no code
        point above 255) a part of letters alone is one match and has nothing
        to normalise, so the merges can start at once."""
        ids, rest, tokenize = {}, [], self.model.tokenize
        for p in parts:
            if simple and p.isalpha():
                raw = p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(_BYTES)
                ids[p] = _pack([t.id for t in tokenize(raw)])
            else:
                rest.append(p)
        if rest:
            for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
                ids[p] = _pack(e.ids)
        return ids

    def learn(self, words: Collection[str], simple: bool) -> None:
        """Put words into the cache. Marks of punctuation at the end are
        encoded apart: a match never runs from a letter or number into one."""
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.cache.clear()
        cache, new, tailed = self.cache, set(), []
        for w in words:
            base = w.rstrip(_TAIL)
            if len(base) < len(w) and base and base[-1].isalnum():
                tail = w[len(base):]
                tailed.append((w, base, tail))
                new.add(base)
                new.add(tail)
            else:
                new.add(w)
        cache.update(self.encode([p for p in new if p not in cache], simple))
        for w, base, tail in tailed:
            cache[w] = cache[base] + cache[tail]

    def packed(self, text: str) -> bytes:
        """The ids of a text (little-endian unsigned 32-bit)."""
        simple = True
        try:
            text.encode("latin-1")
            text = text.lower()  # the tokenizer does so too; here it saves words
        except UnicodeEncodeError:
            simple = False
        words = text.split(" ") if _NOT_SPACE.search(text) else text.split()
        missing = set(words).difference(self.cache)
        if missing:
            self.learn(missing, simple)
        try:
            return b"".join(map(self.cache.__getitem__, words))
        except KeyError:  # the cache was emptied of words that this text has too
            self.learn(set(words), simple)
            return b"".join(map(self.cache.__getitem__, words))

    def __call__(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()


def token_ids(text: Column, tokenizer_file: str, end_id: int = END_ID) -> Column:
    """Packed ids (little-endian unsigned 32-bit) of a text and the end id."""
    @pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = WordEncoder(tokenizer_file)  # of this task, so its words go with it
        end = _pack([end_id])
        for texts in batches:
            yield pd.Series([encode.packed(t) + end for t in texts])
        del encode
        give_back()
    return ids(text_or_empty(text))


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, piece, start, length, ids): every document's ids, cut
    only where they exceed the capacity."""
    small_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("doc_id"), token_ids(F.col(text_col), tokenizer_file).alias("all_ids"))
    n = (F.octet_length("all_ids") / 4).cast("int")
    count = ((n + capacity - 1) / capacity).cast("int")
    d = d.select("doc_id", "all_ids", n.alias("n"), F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"))
    start = F.col("piece") * capacity
    length = F.least(F.col("n") - start, F.lit(capacity))
    return d.select("doc_id", "piece", start.cast("long").alias("start"), length.cast("long").alias("length"),
                    F.substring(F.col("all_ids"), start * 4 + 1, length * 4).alias("ids"))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Steps (length, first_rank, items, first_bin, per_bin, offset), and the
    number of bins. Item ``first_rank + k`` of a length goes to bin
    ``first_bin + k // per_bin`` at ``offset + (k % per_bin) * length``."""
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []  # the gaps that have bins, ascending
    steps, bins = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    def put(length: int, items: int, first: int, per_bin: int, offset: int) -> None:
        steps.append((length, used[length], items, first, per_bin, offset))
        used[length] += items
        left[length] -= items

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        i = bisect_left(large, capacity - a + 1) - 1  # the longest that fits beside a
        while i >= 0 and not left[large[i]]:
            large.pop(i)
            i -= 1
        b = large[i] if i >= 0 else None
        if b == a and left[a] >= 2:
            n = left[a] // 2
            put(a, 2 * n, bins, 2, 0)
            add(capacity - 2 * a, bins, n)
        elif b is not None and b != a:
            n = min(left[a], left[b])
            put(a, n, bins, 1, 0)
            put(b, n, bins, 1, a)
            add(capacity - a - b, bins, n)
        elif b == a:  # one is left: a shorter partner may still be there
            shorter = [x for x in large[:i] if left[x]]
            n = 1
            put(a, 1, bins, 1, 0)
            if shorter:
                put(shorter[-1], 1, bins, 1, a)
            add(capacity - a - (shorter[-1] if shorter else 0), bins, 1)
        else:
            n = left[a]
            put(a, n, bins, 1, 0)
            add(capacity - a, bins, n)
        bins += n
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            i = bisect_left(order, length)
            if i < len(order):
                gap = order[i]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[i]
            else:
                gap, first, n = capacity, bins, -(-left[length] // (capacity // length))
                bins += n
            per_bin, offset = gap // length, capacity - gap
            full = min(n, left[length] // per_bin)
            if full:
                put(length, full * per_bin, first, per_bin, offset)
                add(gap - per_bin * length, first, full)
            if full < n and left[length] and left[length] < per_bin:
                rest = left[length]
                put(length, rest, first + full, per_bin, offset)
                add(gap - rest * length, first + full, 1)
                full += 1
            add(gap, first + full, n - full)
    return steps, bins


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (with a ``length`` from 1 to the capacity) and sequence_id,
    offset. The rows are written once, so that their ranks can't change."""
    spark = items.sparkSession
    rows = written(items.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps, _ = plan(counts, capacity)
    salts = 1 + sum(counts.values()) // RANK_ROWS
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)))
    sizes = rows.groupBy("length", "_salt").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row"))
    ranked = rows.withColumn("_nth", nth).join(sizes, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_nth") - 1)
    schema = "p_length long, first_rank long, items long, first_bin long, per_bin long, p_offset long"
    steps = spark.createDataFrame(pd.DataFrame(steps, columns=[c.split()[0] for c in schema.split(", ")], dtype="int64"), schema)
    small = steps.count() <= PLAN_STEPS
    k = F.col("_rank") - F.col("first_rank")
    out = ranked.join(F.broadcast(steps) if small else steps,
                      (F.col("length") == F.col("p_length")) & (k >= 0) & (k < F.col("items")))
    out = out.withColumn("sequence_id", F.col("first_bin") + F.floor(k / F.col("per_bin")))
    out = out.withColumn("offset", F.col("p_offset") + k % F.col("per_bin") * F.col("length"))
    return out.select(*items.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (packed), length.
    ``packed`` is the result of ``pack`` over pieces that keep their ids."""
    g = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"),
                                          F.sum("length").alias("length"))
    ids = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return g.select("sequence_id", ids.alias("ids"), "length")
