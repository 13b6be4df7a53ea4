"""Spans of bytes in UTF-8 columns: finite-state passes and a verified hash table.

A batch's texts lie one after the other in one Arrow buffer. A pass marks
spans in it (words, pre-tokens) by a table over byte classes; the spans are
hashed and compared eight bytes at a time, all at once, without a Python
object for any of them.

Memory is bounded by bytes, not rows: ``blocks`` deals out ``BLOCK_BYTES`` at
a time and cuts a longer text where the caller's table says that no span
runs on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that one pass works on at a time.
BLOCK_BYTES = 1 << 20
#: Spans above this many bytes are hashed and compared one by one.
LONG_SPAN = 64

_WINDOW = 1 << 16
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(29)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the place where each row starts (one
    more at the end). A null row is empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    if places is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _last_edge(data: np.ndarray, a: int, b: int, edges: Callable[[np.ndarray, np.ndarray], np.ndarray], end: int) -> int:
    """The last place in ``a + 1 .. b`` before which a text may be cut, or
    else the first one behind ``b``, or else ``end``."""
    hi = b
    while hi > a + 1:
        lo = max(a + 1, hi - _WINDOW)
        found = np.flatnonzero(edges(data[lo - 1:hi - 1], data[lo:hi]))
        if found.size:
            return lo + int(found[-1])
        hi = lo
    lo = max(b, a + 1)
    while lo < end:
        hi = min(end, lo + _WINDOW)
        found = np.flatnonzero(edges(data[lo - 1:hi - 1], data[lo:hi]))
        if found.size:
            return lo + int(found[0])
        lo = hi
    return end


def blocks(data: np.ndarray, offsets: np.ndarray, edges: Callable[[np.ndarray, np.ndarray], np.ndarray],
           limit: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """``(bytes, starts, rows, base)`` of consecutive parts of texts, up to
    ``limit`` bytes (``BLOCK_BYTES``) together: where each part starts in ``bytes`` (one more
    at the end), the row it belongs to, and the place of ``bytes`` in
    ``data``. ``edges(previous, byte)`` tells before which bytes a text
    longer than ``limit`` may be cut. Eight zeros follow the bytes."""
    limit = limit or BLOCK_BYTES
    parts: list[tuple[int, int, int]] = []
    size = 0

    def block():
        base, end = parts[0][1], parts[-1][2]
        held = np.zeros(end - base + 8, np.uint8)
        held[:end - base] = data[base:end]
        starts = np.array([p[1] for p in parts] + [end], np.int64) - base
        return held, starts, np.array([p[0] for p in parts], np.int64), base

    for row in range(len(offsets) - 1):
        a, end = int(offsets[row]), int(offsets[row + 1])
        while a < end:
            b = end if end - a <= limit else _last_edge(data, a, a + limit, edges, end)
            if parts and size + b - a > limit:
                yield block()
                parts, size = [], 0
            parts.append((row, a, b))
            size += b - a
            a = b
    if parts:
        yield block()


def owners(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The number of the part that each place lies in."""
    return np.searchsorted(starts, places, side="right") - 1


def _eights(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number each."""
    return np.ndarray((len(buf) - 7,), np.dtype("<u8"), buf, strides=(1,))


def hashes(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray | int = 0) -> np.ndarray:
    """A 64-bit hash of each span and its seed; ``buf`` ends with eight spare bytes."""
    at = _eights(buf)
    h = (lengths.astype(np.uint64) + np.uint64(1) + (np.asarray(seeds).astype(np.uint64) << np.uint64(32))) * _MIX
    live, done = np.flatnonzero(lengths <= LONG_SPAN), 0
    while live.size:
        left = lengths[live] - done
        x = (h[live] ^ (at[starts[live] + done] & _LOW[np.minimum(left, 8)])) * _MIX
        h[live] = x ^ (x >> _TURN)
        live, done = live[left > 8], done + 8
    for i in np.flatnonzero(lengths > LONG_SPAN):
        x = np.array([xxhash.xxh64_intdigest(buf[starts[i]:starts[i] + lengths[i]].tobytes())], np.uint64)
        h[i] ^= (x * _MIX)[0]
    return h


def equal(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of ``a`` and ``b`` of the same lengths hold the same bytes."""
    x, y = _eights(a), _eights(b)
    same = np.ones(len(lengths), bool)
    live, done = np.flatnonzero(lengths <= LONG_SPAN), 0
    while live.size:
        left = lengths[live] - done
        low = _LOW[np.minimum(left, 8)]
        ok = (x[a_starts[live] + done] & low) == (y[b_starts[live] + done] & low)
        same[live] = ok
        live, done = live[ok & (left > 8)], done + 8
    for i in np.flatnonzero(lengths > LONG_SPAN):
        n = lengths[i]
        same[i] = np.array_equal(a[a_starts[i]:a_starts[i] + n], b[b_starts[i]:b_starts[i] + n])
    return same


def slots_for(n: int) -> int:
    """Slots of an open table that ``n`` entries fill to a half at most."""
    return 1 << max(4, int(2 * n - 1).bit_length())


def insert(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Put all spans into an open hash table. Returns for each span the
    number of the span that holds its entry (itself, when it is the first of
    its kind), the hashes and the table. Spans share an entry only when
    their seeds and bytes are equal; bytes are compared, not just hashes."""
    h = hashes(buf, starts, lengths, seeds)
    seeds = np.broadcast_to(np.asarray(seeds), lengths.shape)
    table = np.full(slots_for(len(h)), -1, np.int64)
    last = np.uint64(len(table) - 1)
    slot = (h & last).astype(np.int64)
    entry = np.empty(len(h), np.int64)
    wait = np.arange(len(h))
    while wait.size:
        at = slot[wait]
        free = table[at] < 0
        table[at[free]] = wait[free]  # of several spans in one free slot the last one written stays
        held = table[at]
        same = (h[held] == h[wait]) & (lengths[held] == lengths[wait]) & (seeds[held] == seeds[wait])
        ask = np.flatnonzero(same & (held != wait))
        same[ask] = equal(buf, starts[held[ask]], buf, starts[wait[ask]], lengths[wait[ask]])
        entry[wait[same]] = held[same]
        wait = wait[~same]
        slot[wait] = (slot[wait] + 1) & int(last)
    return entry, h, table


class LengthTable:
    """A compact read-only table from byte strings to small numbers: flat
    arrays only, so it is broadcast as it is. A look-up compares bytes."""

    def __init__(self, keys: list[bytes], values: list[int]):
        self.blob = np.frombuffer(b"".join(keys) + bytes(8), np.uint8).copy()
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.values = np.array(values, np.int64)
        _, self.hashes, self.table = insert(self.blob, self.starts, self.lengths)

    def find(self, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The value of each span, -1 where it is not in the table."""
        out = np.full(len(lengths), -1, np.int64)
        if not len(self.values) or not len(lengths):
            return out
        h = hashes(buf, starts, lengths)
        last = len(self.table) - 1
        slot = (h & np.uint64(last)).astype(np.int64)
        wait = np.arange(len(h))
        while wait.size:
            held = self.table[slot[wait]]
            wait, held = wait[held >= 0], held[held >= 0]
            same = (self.hashes[held] == h[wait]) & (self.lengths[held] == lengths[wait])
            ask = np.flatnonzero(same)
            same[ask] = equal(self.blob, self.starts[held[ask]], buf, starts[wait[ask]], lengths[wait[ask]])
            out[wait[same]] = self.values[held[same]]
            wait = wait[~same]
            slot[wait] = (slot[wait] + 1) & last
        return out
