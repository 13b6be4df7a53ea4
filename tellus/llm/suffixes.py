"""Repeated-substring removal by a hash-compared suffix sort.

Every byte that lies in a string of ``LENGTH`` bytes which also starts
anywhere else (the same text included) is removed. Matches never cross texts.

1. Anchors. Of the ``GRAM``-byte strings inside a window of ``LENGTH`` bytes
   the one with the smallest hash (the leftmost of equals) is its anchor.
   Equal windows have equal anchors at equal offsets, so only windows of one
   anchor can be equal. Neighbouring windows mostly share an anchor; such a
   run is one segment, and one row per segment is shuffled, no text.
2. Equal segments (128-bit digest) are counted. All windows of a segment that
   occurs twice are repeated. An anchor with one segment has no more repeats.
3. What is left are segments that share an anchor and differ somewhere. Their
   bytes are fetched and their windows sorted as suffixes cut to ``LENGTH``:
   a merge sort whose comparisons find the common extension of two suffixes
   by binary search over prefix polynomial hashes, in a logarithmic number of
   steps. Neighbours in the order that agree over ``LENGTH`` bytes are
   repeats; their bytes are compared, and after a hash collision the group is
   sorted again by the bytes themselves.
4. An anchor with over ``GROUP`` different segments would make one task too
   large. Its segments are cut into blocks of ``BLOCK`` windows, and blocks
   are counted by the digests of their bytes and of the bytes that all their
   windows have in common: equal blocks are repeats, a block whose common
   bytes are its own has none, and of the others the windows are counted by
   their digests. All counts combine before the shuffle, so any number of
   segments will do.

By words (``remove_from_texts`` with ``words``): every word that lies in a run
of so many words which also starts anywhere else is removed too, whatever its
bytes and the white space between. Each word becomes a code of ``WORD`` bytes
and the codes are searched as above; only runs of whole codes count. Both
searches share one scan and one chain of tables: the lowest bit of an anchor
says whose it is, so their segments never meet.

Every table goes once what was made of it is written, and so do the shuffle
files behind it; the ranges found are all that stays.

Texts are known by a 128-bit hash, so copies are sorted once and repeated
rows or null ids do no harm.

Defined cases: a null text is empty; a text shorter than ``LENGTH`` bytes
keeps everything; equal texts get equal results (each is the other's repeat);
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm.common import columns, discard, fresh, give_back, small_batches, text_or_empty, written

LENGTH = 400
GRAM = 64
#: Different segments of one anchor up to which they are sorted in one task.
GROUP = 1024
#: Windows of a block of a segment whose anchor is beyond that.
BLOCK = 16
#: Segments sorted in one call, about.
SORT_ROWS = 1024
#: Bytes of a word's code.
WORD = 6
#: Codes of words kept at a time.
CODES = 1 << 17
#: Bytes scanned at a time, about (some 150 bytes of arrays each); a longer
#: text is scanned in parts that overlap.
PART = 1 << 16

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _values() -> np.ndarray:
    """A random-looking odd number for each byte (splitmix64)."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


_VALUES = _values()
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1 modulo 2^64; kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, 1 << 16), base, np.uint64)
        x[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(x)
    return have[:n]


class Prefixes:
    """Prefix polynomial hashes of a byte array, modulo 2^64."""

    def __init__(self, data: np.ndarray, values: np.ndarray = _VALUES):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * _powers(_BASE, n), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Hash of the ``size`` bytes from each ``start``."""
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _digests(chunks: list) -> np.ndarray:
    """128-bit digests as rows of two longs."""
    raw = b"".join(hashlib.blake2b(c, digest_size=16).digest() for c in chunks)
    return np.frombuffer(raw, "<i8").reshape(-1, 2)


def segments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor key) of each segment of some texts
    that lie one after the other in ``data`` and end at ``ends``."""
    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    p = Prefixes(data)
    hashes = _mix((p.sums[gram:] - p.sums[:-gram]) * p.inverse[:n - gram + 1])
    # smallest hash of each window, its place in the low bits: the leftmost wins
    low = np.uint64((1 << 24) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    pad = -len(key) % width
    blocks = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    place = (np.minimum(right[:windows], left[width - 1:width - 1 + windows]) & low).astype(np.int64)
    owner = np.searchsorted(ends, np.arange(windows), "right")
    inside = np.arange(windows) + length <= ends[owner]
    new = np.ones(windows, bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    first = np.flatnonzero(new & inside)
    stop = np.flatnonzero(inside & np.concatenate([new[1:] | ~inside[1:], [True]]))
    return first, stop, hashes[place[first]].view(np.int64)


_SEGMENT = pa.schema([("anchor", pa.int64()), ("g1", pa.int64()), ("g2", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()),
                      ("s", pa.int64()), ("windows", pa.int32())])
_SEGMENT_SQL = "anchor long, g1 long, g2 long, t1 long, t2 long, s long, windows int"


def _parts(texts: list[bytes], length: int, most: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (row, first byte, bytes) of about ``most`` bytes at most."""
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), most):
            piece = t[at:at + most + length - 1]
            if group and size + len(piece) > 2 * most:
                yield group
                group, size = [], 0
            group.append((i, at, piece))
            size += len(piece)
    if group:
        yield group


class _Codes(dict):
    """Codes of the words met lately."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CODES:
            self.clear()
        code = self[word] = hashlib.blake2b(_raw(word), digest_size=WORD).digest()
        return code


def _bytes_of(words: bool) -> Callable[[str | None], bytes]:
    """What is searched of a text: its own bytes, or its words' codes. Codes
    are kept for as long as the function is."""
    codes = _Codes()
    return (lambda t: b"".join([codes[w] for w in (t or "").split()])) if words else _raw


class Search(NamedTuple):
    """One of the searches of a chain: strings of ``length`` bytes of the
    texts or, with ``words``, of their words' codes."""

    length: int
    gram: int
    words: bool = False


def _scan(searches: list[Search]) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [_bytes_of(x.words) for x in searches]
        for b in batches:
            t1, t2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("t1", "t2"))
            for kind, (length, gram, _) in enumerate(searches):
                texts = list(map(made[kind], b.column("text").to_pylist()))
                for group in _parts(texts, length, PART):
                    row, at = np.array([g[0] for g in group]), np.array([g[1] for g in group], np.int64)
                    sizes = np.array([len(g[2]) for g in group], np.int64)
                    ends = np.cumsum(sizes)
                    joined = b"".join(g[2] for g in group)
                    first, last, anchor = segments(np.frombuffer(joined, np.uint8), ends, length, gram)
                    if not len(first):
                        continue
                    view = memoryview(joined)
                    g = _digests([view[a:b + length] for a, b in zip(first.tolist(), last.tolist())])
                    k = np.searchsorted(ends, first, "right")
                    start = first - (ends - sizes)[k] + at[k]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                        anchor & ~1 | kind, g[:, 0], g[:, 1], t1[row[k]], t2[row[k]], start, (last - first + 1).astype(np.int32))], schema=_SEGMENT)
        _POWERS.clear()
        give_back()
    return run


class SuffixSort:
    """Order of the windows of some segments, by their ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int, values: np.ndarray = _VALUES):
        self.data, self.length, self.hash = data, length, Prefixes(data, values)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes at x and y, up to ``length``."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length, np.int64)
        same = self.hash.of(x, self.length) == self.hash.of(y, self.length)
        low[same] = self.length
        at = np.flatnonzero(~same)
        high[at] -= 1
        while len(at):
            mid = (low[at] + high[at] + 1) >> 1
            ok = self.hash.of(x[at], mid) == self.hash.of(y[at], mid)
            low[at] = np.where(ok, mid, low[at])
            high[at] = np.where(ok, high[at], mid - 1)
            at = at[low[at] < high[at]]
        return low

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at x is smaller, equal or larger."""
        n = self.extension(x, y)
        k = np.minimum(n, self.length - 1)
        return np.where(n == self.length, 0, np.sign(self.data[x + k].astype(np.int64) - self.data[y + k]))

    def sort(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """An order of the windows: by group, which ascends, then by suffix.
        Bottom-up merge sort of all groups at once: at each width every
        window finds its rank among the sibling run by binary search."""
        n = len(start)
        order = np.arange(n)
        begin = np.searchsorted(group, group, "left")
        end = np.searchsorted(group, group, "right")
        width, largest = 1, int((end - begin).max(initial=0))
        while width < largest:
            i = np.flatnonzero(end - begin > width)
            b, e = begin[i], end[i]
            block = (i - b) // width
            low0 = b + (block ^ 1) * width
            has = low0 < e
            i, b, e, block, low0 = i[has], b[has], e[has], block[has], low0[has]
            low, high = low0.copy(), np.minimum(low0 + width, e)
            own = start[order[i]]
            at = np.arange(len(i))
            while len(at):
                mid = (low[at] + high[at]) >> 1
                c = self.compare(start[order[mid]], own[at])
                right = c < (block[at] & 1)  # equal windows of the left run stay before
                low[at] = np.where(right, mid + 1, low[at])
                high[at] = np.where(right, high[at], mid)
                at = at[low[at] < high[at]]
            new = order.copy()
            new[b + (block & ~1) * width + (i - b - block * width) + low - low0] = order[i]
            order, width = new, 2 * width
        return order

    def repeated(self, start: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Which windows equal another one of their group."""
        order = self.sort(start, group)
        x, y = start[order[:-1]], start[order[1:]]
        pair = np.flatnonzero((group[:-1] == group[1:]) & (self.hash.of(x, self.length) == self.hash.of(y, self.length)))
        rows = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        equal = np.zeros(len(pair), bool)
        for k in range(0, len(pair), 1 << 14):
            p = pair[k:k + (1 << 14)]
            equal[k:k + (1 << 14)] = (rows[x[p]] == rows[y[p]]).all(1)
        out = np.zeros(len(start), bool)
        out[order[pair[equal]]] = out[order[pair[equal] + 1]] = True
        for g in np.unique(group[pair[~equal]]):  # a collision: this group by its bytes
            i = np.flatnonzero(group == g)
            seen: dict[bytes, list[int]] = {}
            for j in i:
                seen.setdefault(rows[start[j]].tobytes(), []).append(j)
            for same in seen.values():
                out[same] = len(same) > 1
        return out


def sort_segments(rows: pd.DataFrame, length: int, values: np.ndarray = _VALUES) -> pd.DataFrame:
    """Repeated runs (t1, t2, start, stop) of the windows of segments that
    share an anchor with others: columns anchor, place (of the anchor in the
    segment's bytes), t1, t2, s, windows, bytes, fixed (repeated anyway)."""
    data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    size = rows["bytes"].str.len().to_numpy(np.int64)
    count = rows["windows"].to_numpy(np.int64)
    begin = np.cumsum(size) - size
    seg = np.repeat(np.arange(len(rows)), count)
    nth = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[seg] + nth
    anchor = np.unique(rows["anchor"].to_numpy(), return_inverse=True)[1].astype(np.int64)
    group = anchor[seg] * (1 << 20) + (rows["place"].to_numpy(np.int64)[seg] - nth)  # windows at one offset from the anchor
    by = np.argsort(group, kind="stable")
    found = np.zeros(len(seg), bool)
    found[by] = SuffixSort(data, length, values).repeated(start[by], group[by])
    found &= ~rows["fixed"].to_numpy(bool)[seg]
    return _runs(rows, seg, nth, found, length)


_FOUND_SQL = "kind int, t1 long, t2 long, start long, stop long"


def _sorted_bucket(rows: pd.DataFrame, searches: list[Search]) -> pd.DataFrame:
    kind = int(rows["anchor"].iloc[0]) & 1
    out = sort_segments(rows, searches[kind].length)
    out.insert(0, "kind", kind)
    _POWERS.clear()
    give_back()
    return out


def _runs(rows: pd.DataFrame, seg: np.ndarray, nth: np.ndarray, found: np.ndarray, length: int) -> pd.DataFrame:
    i = np.flatnonzero(found)
    new = np.ones(len(i), bool)
    new[1:] = (seg[i[1:]] != seg[i[:-1]]) | (nth[i[1:]] != nth[i[:-1]] + 1)
    first, last = i[new], i[np.concatenate([new[1:], [True]])] if len(i) else i
    s = rows["s"].to_numpy(np.int64)
    out = {c: rows[c].to_numpy(np.int64)[seg[first]] for c in ("t1", "t2")}
    return pd.DataFrame(out | {"start": s[seg[first]] + nth[first], "stop": s[seg[last]] + nth[last] + length})


def keyed(docs: DataFrame, text_col: str) -> list[Column]:
    """Two independent 64-bit hashes of the text."""
    t = text_or_empty(F.col(text_col))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit("second"), t).alias("t2")]


_FETCHED_SQL = "anchor long, place int, t1 long, t2 long, s long, windows int, bytes binary, fixed boolean, hot boolean"


#: Bytes of fetched segments whose anchors are placed at a time.
FETCH_BYTES = 1 << 20


def _fetch(searches: list[Search]) -> object:
    """The bytes of the wanted segments of each text."""
    def placed(out: list[list[tuple]]) -> Iterator[pd.DataFrame]:
        for rows, (length, gram, _) in zip(out, searches):
            f = pd.DataFrame(rows, columns=["anchor", "t1", "t2", "s", "windows", "bytes", "fixed", "hot"])
            f["place"] = _places(f, length, gram) if len(f) else np.zeros(0, np.int32)
            rows.clear()
            yield f[[c.split()[0] for c in _FETCHED_SQL.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [[] for _ in searches], 0
        made = [_bytes_of(x.words) for x in searches]
        for b in batches:
            for t1, t2, text, wanted in zip(b["t1"], b["t2"], b["text"], b["wanted"]):
                raw = [of(text) if any(w["anchor"] & 1 == kind for w in wanted) else b"" for kind, of in enumerate(made)]
                for w in wanted:
                    kind = w["anchor"] & 1
                    piece = raw[kind][w["s"]:w["s"] + w["windows"] + searches[kind].length - 1]
                    out[kind].append((w["anchor"], t1, t2, w["s"], w["windows"], piece, w["fixed"], w["hot"]))
                    size += len(piece)
                    if size >= FETCH_BYTES:
                        yield from placed(out)
                        size = 0
        yield from placed(out)
        _POWERS.clear()
        give_back()
    return run


def _places(f: pd.DataFrame, length: int, gram: int) -> np.ndarray:
    """Where in its bytes each segment's anchor starts: the leftmost string
    with the anchor's hash. It lies in the first window."""
    data = np.frombuffer(b"".join(f["bytes"]), np.uint8)
    size = f["bytes"].str.len().to_numpy(np.int64)
    begin = np.cumsum(size) - size
    p = Prefixes(data)
    hashes = _mix((p.sums[gram:] - p.sums[:-gram]) * p.inverse[:len(data) - gram + 1]).view(np.int64) & ~1
    rows = begin[:, None] + np.arange(length - gram + 1)[None, :]
    last = f["windows"].to_numpy(np.int64) - 1  # the anchor lies in every window: from the last one's start on
    same = (hashes[rows] == (f["anchor"].to_numpy(np.int64) & ~1)[:, None]) & (np.arange(length - gram + 1)[None, :] >= last[:, None])
    return same.argmax(1).astype(np.int32)


_BLOCK_SQL = "anchor long, block int, c1 long, c2 long, p1 long, p2 long, t1 long, t2 long, s long, first int, windows int"


def _block_digests(length: int, size: int) -> object:
    """Blocks of windows at neighbouring offsets from the anchor: a digest of
    the bytes that all windows of such a block share (``c``), and one of the
    offsets and all bytes of those that the segment has (``p``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, core, piece = [], [], []
            for anchor, place, t1, t2, s, n, raw in zip(*(b[c] for c in ("anchor", "place", "t1", "t2", "s", "windows", "bytes"))):
                for k in range((place - n + 1) // size, place // size + 1):
                    first, last = max(0, place - k * size - size + 1), min(n - 1, place - k * size)
                    at = place - k * size
                    core.append(raw[at:at + length - size + 1])
                    piece.append(b"%d %d " % (place - first, place - last) + raw[first:last + length])
                    rows.append((anchor, k, t1, t2, s, first, last - first + 1))
            f = pd.DataFrame(rows, columns=["anchor", "block", "t1", "t2", "s", "first", "windows"])
            c, p = _digests(core), _digests(piece)
            f["c1"], f["c2"], f["p1"], f["p2"] = c[:, 0], c[:, 1], p[:, 0], p[:, 1]
            yield f[[x.split()[0] for x in _BLOCK_SQL.split(", ")]]
    return run


def _window_digests(length: int) -> object:
    """A digest of each window of the asked runs (``asked``: first, windows)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, chunks = [], []
            for t1, t2, s, raw, asked in zip(*(b[c] for c in ("t1", "t2", "s", "bytes", "asked"))):
                for r in asked:
                    for k in range(r["first"], r["first"] + r["windows"]):
                        chunks.append(raw[k:k + length])
                        rows.append((t1, t2, s + k))
            d = _digests(chunks)
            f = pd.DataFrame(rows, columns=["t1", "t2", "p"], dtype="int64")
            f["d1"], f["d2"] = d[:, 0], d[:, 1]
            yield f[["d1", "d2", "t1", "t2", "p"]]
    return run


def _hot_spans(hot: DataFrame, length: int, size: int = BLOCK) -> DataFrame:
    """Repeated ranges among the segments of anchors that have very many."""
    blocks = written(hot.mapInPandas(_block_digests(length, size), _BLOCK_SQL), "blocks")
    core, own = ["anchor", "block", "c1", "c2"], ["anchor", "block", "c1", "c2", "p1", "p2"]
    pieces = blocks.groupBy(*own).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("t1", "t2", "s", "first", "windows")])
    pieces = written(pieces, "pieces")
    start = F.col("s") + F.col("first")
    equal = blocks.join(pieces.filter("n > 1").select(*own), own).select(
        "t1", "t2", start.alias("start"), (start + F.col("windows") - 1 + length).alias("stop"))
    mixed = pieces.groupBy(*core).agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    mixed = pieces.join(mixed.filter("kinds > 1 AND single > 0").select(*core), core)
    asked = mixed.groupBy("t1", "t2", "s").agg(F.collect_list(F.struct("first", "windows")).alias("asked"))
    found = hot.join(asked, ["t1", "t2", "s"]).mapInPandas(_window_digests(length), "d1 long, d2 long, t1 long, t2 long, p long")
    found = written(found, "windows")
    twice = found.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1").select("d1", "d2")
    runs = found.join(twice, ["d1", "d2"]).groupBy("t1", "t2").agg(F.collect_list("p").alias("p"))
    runs = runs.select("t1", "t2", F.explode(_merged(F.col("p"), length)).alias("r"))
    out = written(equal.unionByName(runs.select("t1", "t2", "r.start", "r.stop")), "hot")
    discard(blocks, pieces, found)
    return out


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int | None = None, group: int = GROUP) -> DataFrame:
    """(t1, t2, start, stop): byte ranges of texts that repeated strings
    cover; they may overlap. A text is known by the hashes of ``keyed``."""
    return _found(docs, text_col, [_search(length, gram)], group).drop("kind")


def repeated_words(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """(t1, t2, start, stop): ranges of words, from 0, of texts that repeated
    runs of ``words`` words cover; they may overlap."""
    return _whole_words(_found(docs, text_col, [_search(words * WORD, words=True)]).drop("kind"), words)


def _whole_words(found: DataFrame, words: int) -> DataFrame:
    whole = found.select("t1", "t2", F.ceil(F.col("start") / WORD).alias("start"), F.floor(F.col("stop") / WORD).alias("stop"))
    return whole.filter(F.col("stop") - F.col("start") >= words)


def _search(length: int, gram: int | None = None, words: bool = False) -> Search:
    return Search(length, gram or min(GRAM, max(1, length // 4)), words)


def _found(docs: DataFrame, text_col: str, searches: list[Search], group: int = GROUP) -> DataFrame:
    """(kind, t1, t2, start, stop), written: what each search, known by its
    place in the list (two at most), finds."""
    small_batches(docs.sparkSession)
    texts = docs.select(*keyed(docs, text_col), text_or_empty(F.col(text_col)).alias("text"))
    least = min(2 * (x.length // WORD) - 1 if x.words else x.length for x in searches)
    kind = F.col("anchor").bitwiseAND(F.lit(1)).cast("int")
    length = F.element_at(F.array(*[F.lit(x.length) for x in searches]), kind + 1)
    segment = ["anchor", "g1", "g2"]

    scanned = written(texts.filter(F.octet_length("text") >= least).mapInArrow(_scan(searches), _SEGMENT_SQL), "segments")
    same = scanned.groupBy(*segment).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("t1", "t2", "s", "windows")])
    same = written(same, "classes")
    kinds = same.groupBy("anchor").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    shared = written(same.join(kinds.filter("kinds > 1 AND single > 0"), "anchor").select(
        "anchor", "t1", "t2", "s", "windows", (F.col("n") > 1).alias("fixed"), (F.col("kinds") > group).alias("hot")), "shared")
    twice = written(same.filter("n > 1").select(*segment), "twice")
    discard(same)
    whole = scanned.join(twice, segment).select(
        kind.alias("kind"), "t1", "t2", F.col("s").alias("start"), (F.col("s") + F.col("windows") - 1 + length).alias("stop"))
    whole = written(whole, "whole")
    discard(scanned, twice)

    wanted = shared.groupBy("t1", "t2").agg(F.collect_list(F.struct("anchor", "s", "windows", "fixed", "hot")).alias("wanted"))  # of one text: bounded by its length
    once = texts.groupBy("t1", "t2").agg(F.first("text").alias("text"))  # copies meet before the shuffle
    fetched = written(once.join(wanted, ["t1", "t2"]).mapInPandas(_fetch(searches), _FETCHED_SQL), "fetched")
    discard(shared)
    sizes = fetched.agg(F.count_if(~F.col("hot")).alias("cold"), *[
        F.count_if(F.col("hot") & (kind == k)).alias(f"hot{k}") for k in range(len(searches))]).first()
    buckets = 1 + sizes["cold"] // SORT_ROWS
    out = fetched.filter("NOT hot").groupBy(kind.alias("kind"), F.pmod("anchor", F.lit(buckets)).alias("bucket")).applyInPandas(
        lambda f: _sorted_bucket(f, searches), _FOUND_SQL)
    out, hot = whole.unionByName(out), []
    for k, x in enumerate(searches):
        if sizes[f"hot{k}"]:
            hot.append(_hot_spans(fetched.filter(F.col("hot") & (kind == k)), x.length))
            out = out.unionByName(hot[-1].withColumn("kind", F.lit(k)))
    out = written(out, "found")
    discard(fetched, whole, *hot)
    return out


def _merge_windows(starts: pd.Series, length: pd.Series) -> pd.Series:
    out = []
    for p, n in zip(starts, length):
        p = np.unique(np.asarray(p, np.int64))
        cut = np.flatnonzero(np.diff(p) > 1)
        out.append([{"start": int(a), "stop": int(b) + int(n)} for a, b in zip(p[np.concatenate([[0], cut + 1])], p[np.concatenate([cut, [len(p) - 1]])])])
    return pd.Series(out)


def _merged(starts: Column, length: int) -> Column:
    return pandas_udf(_merge_windows, "array<struct<start: long, stop: long>>")(starts, F.lit(length))


def merge(ranges: list) -> list[tuple[int, int]]:
    """Maximal runs of some overlapping or touching (start, stop) ranges."""
    out: list[list[int]] = []
    for a, b in sorted((r["start"], r["stop"]) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def word_bytes(text: str, ranges: list) -> list[dict[str, int]]:
    """The byte ranges of some ranges of words, from the first letter to the last."""
    at = np.array([m.span() for m in re.finditer(r"\S+", text)], np.int64)
    raw = np.frombuffer(_raw(text), np.uint8)
    first = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))  # where each character starts
    return [{"start": int(first[at[r["start"], 0]]), "stop": int(first[at[r["stop"] - 1, 1]])} for r in ranges]


def _cut(as_text: bool) -> object:
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ranges, words in batches:
            out = []
            for t, r, w in zip(texts, ranges, words):
                raw = _raw(t)
                r = list(r) if r is not None else []
                runs = merge(r + word_bytes(t, w) if w is not None else r)
                at, kept = 0, []
                for a, b in runs:
                    kept.append(raw[at:a])
                    at = b
                left = b"".join(kept) + raw[at:]
                out.append((len(raw), sum(b - a for a, b in runs), len(runs), left.decode("utf-8", "ignore") if as_text else left))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])
    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    return run


def remove_repeats(docs: DataFrame, text_col: str = "text", result: str = "result", length: int = LENGTH, group: int = GROUP,
                   as_text: bool = False, words: int | None = None) -> DataFrame:
    """``docs`` and a struct column: n_bytes, n_removed, n_spans (maximal
    removed runs) and kept (the bytes that are left; with ``as_text`` the
    characters that are left whole). With ``words`` repeated runs of so many
    words go as well."""
    a, b, s, w = (fresh(docs, c) for c in ("_t1", "_t2", "_spans", "_words"))
    k1, k2 = keyed(docs, text_col)
    d = docs.withColumn(a, k1).withColumn(b, k2)

    def with_spans(d: DataFrame, spans: DataFrame, name: str) -> DataFrame:
        spans = spans.distinct().groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
        return d.join(spans.select(F.col("t1").alias(a), F.col("t2").alias(b), F.col("spans").alias(name)), [a, b], "left")
    found = _found(docs, text_col, [_search(length)] + ([_search(words * WORD, words=True)] if words else []), group)
    d = with_spans(d, found.filter("kind = 0").drop("kind"), s)
    if words:
        d = with_spans(d, _whole_words(found.filter("kind = 1").drop("kind"), words), w)
    else:
        d = d.withColumn(w, F.lit(None).cast("array<struct<start: long, stop: long>>"))
    cut = pandas_udf(_cut(as_text), f"n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
    return d.select(*columns(docs), cut(text_or_empty(F.col(text_col)), F.col(s), F.col(w)).alias(result))


def remove_from_texts(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", length: int = LENGTH,
                      words: int | None = None) -> DataFrame:
    """``docs`` with the repeated strings of ``length`` bytes cut out of the
    texts, and with ``words`` the repeated runs of so many words too. A
    character that is cut in the middle goes altogether. A null text stays null."""
    r = fresh(docs, "_repeats")
    d = remove_repeats(docs, text_col, r, length, as_text=True, words=words)
    t = F.when(F.col(text_col).isNull() | (F.col(r)["n_removed"] == 0), F.col(text_col)).otherwise(F.col(r)["kept"])
    d = d.withColumn(text_col, t)
    if chars_col and chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        d = d.withColumn(chars_col, F.when(F.col(r)["n_removed"] == 0, F.col(chars_col)).otherwise(F.length(text_col).cast(kind)))
    return d.select(*columns(docs))
