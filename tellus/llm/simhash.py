"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A text's fingerprint has a bit set where over half of its shingles' hashes
have it set. Fingerprints link where at most ``MAX_BITS`` (3) bits differ.

Keys: the 64 bits are cut into three segments, each padded to a word of the
binary Golay code [23, 12], whose spheres of radius 3 fill the whole space,
so every word decodes to exactly one of 4096 codewords. Three errors over
three segments leave two segments with at most one error each. A segment one
bit away decodes to one of the codewords that the word or its one-bit
neighbours decode to (one or six). A fingerprint is filed under the codeword
pair of each two segments (3 keys) and looks under the neighbour keys, so no
link is lost; every candidate pair is verified by counting the differing bits.

Only distinct fingerprints take part, so copies cost nothing, and a bucket
that holds very many fingerprints is cut into blocks whose pairs are verified
block by block and handed on as a spanning forest, never as all pairs.
Components of the links are found by star contraction in written rounds.

Defined cases: a null or empty text, or one of white space, has fingerprint
zero and links like any other; fewer words than a shingle make one shingle;
null ids are kept, and a component's id is its smallest non-null id (null if
there is none); repeated rows are answered alike; extra columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm.common import fresh, small_batches, text_or_empty, written
from tellus.llm.components import components

WORDS = 3
MAX_BITS = 3
SEED = 42
#: Bits of the three segments, from the lowest.
SEGMENTS = (22, 21, 21)
#: Fingerprints filed under one key above which it is worked on in blocks.
BLOCK = 2048
_CHUNK = 1 << 18

# Fixed value: a generator polynomial of the binary Golay code [23, 12].
GENERATOR = 0b110001110101


def simhash(text: str, words: int = WORDS) -> int:
    """The fingerprint of a text, as an unsigned number."""
    parts = text.encode("utf-8").lower().split()  # bytes: A-Z, and the six white-space bytes
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(parts) - words + 1)
    starts, ends = starts[:n].tolist(), ends[min(words, len(parts)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    h = xxhash.xxh64_intdigest
    for i in range(0, n, _CHUNK):
        hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a long (its 64 bits)."""
    @pandas_udf("long")
    def bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64))
    return bits(text_or_empty(text))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of each 12-bit codeword index; the index to xor to the high
    bits of a word, by its syndrome."""
    check = np.zeros(4096, np.int64)
    for i in range(4096):
        r = i << 11
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= GENERATOR << (bit - 11)
        check[i] = r
    fix = np.zeros(2048, np.int64)
    one = [1 << b for b in range(23)]
    errors = [0, *one, *(a | b for a in one for b in one if a < b), *(a | b | c for a in one for b in one if a < b for c in one if b < c)]
    for e in errors:  # 2048 errors of up to three bits, one for each syndrome
        fix[(e & 2047) ^ check[e >> 11]] = e >> 11
    return check, fix


def decode(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each 23-bit word."""
    check, fix = golay()
    high = words >> 11
    return high ^ fix[(words & 2047) ^ check[high]]


def segment_keys(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each segment: the codeword index of every fingerprint, and a table
    of the distinct indices of the word and its one-bit neighbours, -1 beyond."""
    out, at = [], 0
    for bits in SEGMENTS:
        w = (fps.view(np.uint64) >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64)
        at += bits
        near = np.sort(np.stack([decode(w), *(decode(w ^ (1 << b)) for b in range(bits))], 1), 1)
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        width = int(new.sum(1).max(initial=1))
        near = np.take_along_axis(np.where(new, near, -1), np.argsort(~new, 1, kind="stable"), 1)[:, :width]
        out.append((decode(w), near))
    return out


def _key(pair: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return pair << 24 | a << 12 | b


PAIRS = ((0, 1), (0, 2), (1, 2))


def filed_keys(fps: np.ndarray) -> np.ndarray:
    """The three keys under which each fingerprint is filed."""
    s = segment_keys(fps)
    return np.stack([_key(p, s[a][0], s[b][0]) for p, (a, b) in enumerate(PAIRS)], 1)


def searched_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys under which a fingerprint looks. One error in
    each of two segments is left to the first pair: if all three segments
    have one, it is among them; else some pair has a segment without error."""
    s, rows, keys = segment_keys(fps), [], []
    for p, (a, b) in enumerate(PAIRS):
        if p == 0:
            x, y = s[a][1][:, :, None], s[b][1][:, None, :]
            key, ok = _key(p, x, y), (x >= 0) & (y >= 0)
            key, ok = key.reshape(len(fps), -1), ok.reshape(len(fps), -1)
        else:
            x, y, xs, ys = s[a][0][:, None], s[b][0][:, None], s[a][1], s[b][1]
            key = np.concatenate([_key(p, x, ys), _key(p, xs, y)], 1)
            ok = np.concatenate([ys >= 0, (xs >= 0) & (xs != x)], 1)
        r, c = np.nonzero(ok)
        rows.append(r)
        keys.append(key[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def _spread(kind: str) -> object:
    """A map over batches of fingerprints: (key, fp) rows."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 1 << 14):
                fps = batch["fp"].to_numpy()[i:i + (1 << 14)]
                if kind == "filed":
                    keys = filed_keys(fps)
                    yield pd.DataFrame({"key": keys.ravel(), "fp": np.repeat(fps, keys.shape[1])})
                else:
                    row, keys = searched_keys(fps)
                    yield pd.DataFrame({"key": keys, "fp": fps[row]})
    return rows


def _forest(searched: pd.DataFrame, filed: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a bucket that join what is not joined yet."""
    a, b = searched["fp"].to_numpy(), filed["fp"].to_numpy()
    label, out = np.arange(len(b)), []
    for x in a:
        near = np.flatnonzero((np.bitwise_count((b ^ x).view(np.uint64)) <= MAX_BITS) & (b != x))
        if len(near):
            groups, first = np.unique(label[near], return_index=True)
            out += [(x, y) for y in b[near[first]]]
            label[np.isin(label, groups)] = groups[0]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps`` (column
    ``fp``): at most ``MAX_BITS`` bits differ. Links of buckets with over
    ``block`` fingerprints are a spanning forest of that bucket's links."""
    filed = fps.mapInPandas(_spread("filed"), "key long, fp long")
    searched = fps.mapInPandas(_spread("searched"), "key long, fp long")
    near = F.expr(f"bit_count(s.fp ^ f.fp) <= {MAX_BITS}") & (F.col("s.fp") < F.col("f.fp"))
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > block)
    hot = written(sizes, "hot_keys")
    if hot.isEmpty():
        pairs = searched.alias("s").join(filed.alias("f"), (F.col("s.key") == F.col("f.key")) & near)
        return pairs.select(F.col("s.fp").alias("a"), F.col("f.fp").alias("b"))
    cold_s, cold_f = (x.join(hot, "key", "left_anti") for x in (searched, filed))
    pairs = cold_s.alias("s").join(cold_f.alias("f"), (F.col("s.key") == F.col("f.key")) & near)
    hot_s, hot_f = (x.join(hot, "key") for x in (searched, filed))
    more = hot_s.groupBy("key").agg(F.count("*").alias("ns"))
    hot_s, hot_f = hot_s.join(more, "key"), hot_f.join(more, "key")
    blocks_f, blocks_s = (F.ceil(F.col(c) / block).cast("int") for c in ("n", "ns"))
    own_f, own_s = (F.pmod(F.xxhash64("fp"), x).cast("int") for x in (blocks_f, blocks_s))
    hot_f = hot_f.select("key", "fp", own_f.alias("i"), F.explode(F.sequence(F.lit(0), blocks_s - 1)).alias("j"))
    hot_s = hot_s.select("key", "fp", own_s.alias("j"), F.explode(F.sequence(F.lit(0), blocks_f - 1)).alias("i"))
    forest = hot_s.groupBy("key", "i", "j").cogroup(hot_f.groupBy("key", "i", "j")).applyInPandas(_forest, "a long, b long")
    return pairs.select(F.col("s.fp").alias("a"), F.col("f.fp").alias("b")).unionByName(forest)


def roots(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``fps``."""
    distinct = written(fps.select("fp").distinct(), "fingerprints")
    linked = components(links(distinct, block))
    return distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, fp, component_id): every row's fingerprint and the
    smallest doc_id that can be reached from it by links."""
    small_batches(docs.sparkSession)
    d = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), words).alias("fp")), "simhash")
    groups = written(roots(d), "roots")
    least = d.groupBy("fp").agg(F.min("doc_id").alias("least")).join(groups, "fp")
    ids = groups.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return d.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (a null id is the largest); of equal ids, whichever was written first."""
    small_batches(docs.sparkSession)
    row, fp = fresh(docs, "_row"), fresh(docs, "_fp")
    d = written(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(fp, fingerprint(F.col(text_col), words)), "simhash")
    narrow = d.select(F.col(id_col).alias("doc_id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    best = narrow.groupBy("fp").agg(first).join(roots(narrow), "fp").groupBy("root").agg(F.min("first").alias("first"))
    return d.join(best.select(F.col("first.row").alias(row)), row, "left_semi").drop(row, fp)
