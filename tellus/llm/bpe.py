"""Byte-level BPE encoding and decoding with the tiktoken library.

Texts are encoded by a local rank file. A long text is first cut at places
where the split pattern always ends a match, whatever follows, so a piece can
be encoded alone and the ids of the pieces add up to the ids of the text.
Decoding returns raw bytes, since one token may hold part of a character.

Packed ids are ``binary`` columns: little-endian unsigned 32-bit integers.

Defined cases: a null text is empty; an empty text has no ids and decodes to
no bytes; rows are independent, so repeated rows and extra columns pass
through unchanged; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from tellus.llm.common import small_batches, text_or_empty

# Fixed value: the split pattern whose safe boundaries are known.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts above this many code points are cut before they are encoded.
PIECE_CHARS = 32768
#: Runs of so much white space are encoded without the library's pattern engine.
RUN_CHARS = 10_000

# A match of the split pattern never runs on from a letter, number or mark of
# punctuation into a space or line feed, nor from a letter into a number or
# back: only the start of a match may be a space.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}\p{P}])(?=[ \n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once in each Python process."""
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Cut ``text`` into pieces of ``size`` code points or a little more, at
    safe boundaries only. A run without one stays whole."""
    start = 0
    while len(text) - start > size:
        m = _SAFE.search(text, start + size)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def blank_runs(text: str, run: int) -> Iterator[tuple[int, int]]:
    """Start and end of the matches of ``\\s+(?!\\S)`` that hold ``run`` code
    points or more: a whole run of white space at the end of the text, all
    but its last code point before another one."""
    for m in regex.finditer(r"\p{White_Space}{%d,}+" % (run + 1), text):
        yield m.start(), m.end() - (m.end() < len(text))


def encode_text(enc: tiktoken.Encoding, text: str, size: int = PIECE_CHARS, run: int = RUN_CHARS) -> list[int]:
    if len(text) <= min(size, run) or enc._pat_str != SPLIT:
        return enc.encode_ordinary(text)
    ids, start = [], 0
    for a, b in [*blank_runs(text, run), (len(text), len(text))]:
        for piece in safe_pieces(text[start:a], size):
            ids += enc.encode_ordinary(piece)
        if a < b:
            ids += enc._encode_single_piece(text[a:b].encode())
        start = b
    return ids


def encode(text: Column, rank_file: str, pattern: str) -> Column:
    """Packed ids of ``text``."""
    @pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for texts in batches:
            yield pd.Series([np.array(encode_text(enc, t), "<u4").tobytes() for t in texts])
    return ids(text_or_empty(text))


def decode(ids: Column, rank_file: str, pattern: str) -> Column:
    """The raw bytes of packed ids."""
    @pandas_udf("binary")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(rank_file, pattern)
        for packed in batches:
            yield pd.Series([enc.decode_bytes(np.frombuffer(p, "<u4").tolist()) for p in packed])
    return raw(F.coalesce(ids, F.lit(b"")))


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, packed ids and decoded bytes of every row; both steps run in one
    Python process, so the vocabulary is held once."""
    @pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoding(rank_file, pattern)
        for texts in batches:
            ids = [np.array(encode_text(enc, t), "<u4").tobytes() for t in texts]
            yield pd.DataFrame({"ids": ids, "decoded": [enc.decode_bytes(np.frombuffer(p, "<u4").tolist()) for p in ids]})
    small_batches(docs.sparkSession)
    d = docs.select(F.col(id_col).alias(id_col), both(text_or_empty(F.col(text_col))).alias("r"))
    return d.select(id_col, "r.ids", "r.decoded")
