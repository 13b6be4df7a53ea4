"""Token counts of whole texts by a sentencepiece model, with two tiers of
look-ups on the map side and no shuffle.

A merge of the model joins two neighbouring characters only if some piece of
the vocabulary has them side by side. Where no piece does, a text can be cut
and the tokens of the parts add up: these parts are the pre-tokens. Tier one
is a compact hash table of frequent pre-tokens and their lengths, broadcast
once; tier two is a cache in each Python worker, and what is in neither goes
to the library. Counts are the same whatever the tables hold.

Parameters: the frequent pre-tokens come from ``SAMPLE_TEXTS`` texts (the
first that the scan yields, ``SAMPLE_KINDS`` pre-tokens of each), at most
``TABLE_ROWS`` of at most ``KEY_BYTES`` bytes; a cache holds ``CACHE_ROWS``.

Defined cases: a null or empty text has no tokens and no bytes; control
strings in a text (``<s>``) are ordinary text, as the library has them; rows
are independent, so repeated rows and null ids pass through; a text of any
length is counted whole, in bounded blocks; extra columns of any name are not
read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm import spans
from tellus.llm.common import fresh, small_batches, text_or_empty

SAMPLE_TEXTS = 2000
SAMPLE_KINDS = 400
TABLE_ROWS = 1 << 16
KEY_BYTES = 48
CACHE_ROWS = 200_000

#: The space as the model's vocabulary writes it.
_SPACE = "▁"
#: A character that no piece holds stands before a pre-token, so nothing merges with it.
_GUARDS = "\n\r\x00\x01\x02"


class Pieces:
    """A sentencepiece model that neither normalizes texts nor drops spaces,
    and the pairs of bytes that its merges may join."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        ordinary = [lib.id_to_piece(i) for i in range(lib.get_piece_size()) if not (lib.is_control(i) or lib.is_byte(i) or lib.is_unknown(i))]
        self.guard = next(g for g in _GUARDS if not any(g in p for p in ordinary))
        self.ahead = len(lib.encode(self.guard, num_threads=1))
        probe = "    ﬁ "
        if lib.decode(lib.encode(probe, num_threads=1)) != probe:
            raise ValueError("the model normalizes its texts: pre-tokens can't be cut from them")
        self.joins = np.zeros((256, 256), bool)
        for p in ordinary:
            b = np.frombuffer(p.replace(_SPACE, " ").encode(), np.uint8)
            self.joins[b[:-1], b[1:]] = True
        # a text may hold the vocabulary's own sign for a space, which merges like one
        sign = _SPACE.encode()
        self.joins[sign[-1]] |= self.joins[0x20]
        self.joins[:, sign[0]] |= self.joins[:, 0x20]
        self.joins[:, 0x80:0xC0] = True  # never inside a character
        self.cache: dict[bytes, int] = {}

    def edges(self, previous: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Whether a text may be cut between two bytes."""
        return ~self.joins[previous, byte]

    def cut(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the pre-tokens of parts that begin at ``starts``."""
        n = int(starts[-1])
        first = np.ones(n, bool)
        first[1:] = self.edges(buf[:n - 1], buf[1:n])
        first[starts[:-1]] = True
        begin = np.flatnonzero(first)
        return begin, np.diff(begin, append=n)

    def lengths(self, keys: list[bytes]) -> list[int]:
        """Tokens of each pre-token, by the worker's cache or the library."""
        found = [self.cache.get(k) for k in keys]
        miss = [i for i, n in enumerate(found) if n is None]
        for lo in range(0, len(miss), 4096):
            part = miss[lo:lo + 4096]
            for i, ids in zip(part, self.library.encode([self.guard + keys[i].decode() for i in part], num_threads=1)):
                found[i] = len(ids) - self.ahead
        if len(self.cache) + len(miss) > CACHE_ROWS:
            self.cache.clear()
        self.cache.update((keys[i], found[i]) for i in miss[:CACHE_ROWS] if len(keys[i]) <= KEY_BYTES)
        return found

    def count(self, data: np.ndarray, offsets: np.ndarray, table: spans.LengthTable) -> np.ndarray:
        """Tokens of each row."""
        out = np.zeros(len(offsets) - 1, np.int64)
        for buf, starts, row, _ in spans.blocks(data, offsets, self.edges):
            begin, length = self.cut(buf, starts)
            n = table.find(buf, begin, length)
            miss = np.flatnonzero(n < 0)
            if miss.size:
                entry, _, _ = spans.insert(buf, begin[miss], length[miss])
                kinds, which = np.unique(entry, return_inverse=True)
                keys = [buf[begin[i]:begin[i] + length[i]].tobytes() for i in miss[kinds]]
                n[miss] = np.array(self.lengths(keys), np.int64)[which]
            sums = np.add.reduceat(n, np.searchsorted(begin, starts[:-1]))
            np.add.at(out, row, sums)
        return out


@lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    """The model, loaded once in each Python process."""
    return Pieces(model_file)


def with_prefix(text):
    """The library puts a space before a text that is not empty."""
    return F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).otherwise(F.lit(""))


def frequent(docs: DataFrame, model_file: str, text_col: str = "text") -> spans.LengthTable:
    """The table of frequent pre-tokens: bounded by the parameters above,
    on the driver too, and read from as few partitions as hold the sample."""
    @pandas_udf("struct<keys: array<binary>, n: array<int>>")
    def kinds(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = pieces(model_file)
        for texts in batches:
            rows = []
            for t in texts:
                data = np.frombuffer(t.encode(), np.uint8)
                seen: Counter[bytes] = Counter()
                for buf, starts, _, _ in spans.blocks(data, np.array([0, len(data)]), model.edges):
                    begin, length = model.cut(buf, starts)
                    raw = buf.tobytes()
                    seen.update(raw[a:a + n] for a, n in zip(begin.tolist(), length.tolist()) if n <= KEY_BYTES)
                    if len(seen) > 50 * SAMPLE_KINDS:
                        seen = Counter(dict(seen.most_common(SAMPLE_KINDS)))
                top = seen.most_common(SAMPLE_KINDS)
                rows.append(([k for k, _ in top], [n for _, n in top]))
            yield pd.DataFrame(rows, columns=["keys", "n"])

    small_batches(docs.sparkSession, 64)
    total: Counter[bytes] = Counter()
    for r in docs.select(kinds(with_prefix(text_or_empty(F.col(text_col)))).alias("k")).head(SAMPLE_TEXTS):
        total.update(dict(zip(map(bytes, r.k["keys"]), r.k["n"])))
    keys = [k for k, _ in total.most_common(TABLE_ROWS)]
    return spans.LengthTable(keys, pieces(model_file).lengths(keys))


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row; ``model_file`` is readable on
    every executor under the same path."""
    held = docs.sparkSession.sparkContext.broadcast(frequent(docs, model_file, text_col))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_file)
        for b in batches:
            n = model.count(*spans.utf8(b.column(2)), held.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n)], [id_col, "n_bytes", "n_tokens"])

    text = text_or_empty(F.col(text_col))
    size = fresh(docs.select(id_col), "n_bytes")
    d = docs.select(F.col(id_col), F.octet_length(text).cast("long").alias(size), with_prefix(text).alias("_text"))
    small_batches(docs.sparkSession)
    return d.mapInArrow(count, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long")
