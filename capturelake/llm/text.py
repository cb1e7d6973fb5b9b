"""Vectorised words, shingles and hashes over Arrow string columns.

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR. All
functions work on whole texts. Memory is a small multiple of the text: bytes are
hashed in pieces of about ``PIECE`` bytes, cut only between words.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SHORT = 16  # bytes of a word that are hashed place by place


def released(run):
    """run over batches; what allocators of the worker still hold afterwards goes back to the system, as workers live on."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def release() -> None:
    """Gives what allocators hold without need back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, cache: dict[str, np.ndarray] = {}) -> np.ndarray:  # noqa: B006
    have = cache.get("p")
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        p = np.full(size, _MULT, np.uint64)
        p[0] = 1
        cache["p"] = have = np.multiply.accumulate(p)
    return have


@functools.cache
def _codes(lower: bool) -> np.ndarray:
    """What each byte adds to a word's sum at each of its first places."""
    byte = (_LOWER if lower else np.arange(256)).astype(np.uint64) + np.uint64(1)
    return _powers(SHORT)[:SHORT, None] * byte


def string_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    if hi == lo:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8, hi - lo, lo), offsets - lo


def slices(batch: pa.RecordBatch, text: str, size: int = 2 * PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each; a longer text is alone in its slice."""
    n = batch.num_rows
    if n == 0:
        return
    _, offs = string_bytes(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = min(to, n)


class Words:
    """hash, row, and byte span of every word of a slice."""

    __slots__ = ("doc", "end", "hash", "start")

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool = True):
        solid = ~_SPACE[buf]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        edges = offs[:-1][offs[:-1] < len(buf)]
        first[edges] = solid[edges]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        edges = offs[1:][offs[1:] > 0] - 1
        last[edges] = solid[edges]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(np.searchsorted(self.start, offs)))
        self.hash = self._hash(buf, lower)

    def _hash(self, buf: np.ndarray, lower: bool) -> np.ndarray:
        """The sum of (byte + 1) times the power of its place, mixed with the length."""
        out = np.empty(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + PIECE, "right")))
            start, sizes = self.start[at:to], self.end[at:to] - self.start[at:to]
            # one place of all words after the other, the longest words first, as most are short
            order = np.argsort(np.maximum(SHORT + 1 - sizes, 0).astype(np.uint8), kind="stable")
            first, codes, h = start[order], _codes(lower), np.zeros(to - at, np.uint64)
            for k, n in enumerate(len(sizes) - np.cumsum(np.bincount(np.minimum(sizes, SHORT), minlength=SHORT))[:SHORT]):
                h[:n] += codes[k][buf[first[:n] + k]]
            h[order] = h.copy()
            longer = np.flatnonzero(sizes > SHORT)
            if len(longer):
                h[longer] += self._rest(buf, start[longer] + SHORT, sizes[longer] - SHORT, lower)
            out[at:to] = mix(h + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = to
        return out

    @staticmethod
    def _rest(buf: np.ndarray, start: np.ndarray, sizes: np.ndarray, lower: bool) -> np.ndarray:
        """The sum from the place SHORT on, of words that have one."""
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        code = buf[np.repeat(start, sizes) + place]
        code = (_LOWER[code] if lower else code).astype(np.uint64) + np.uint64(1)
        return np.add.reduceat(code * _powers(int(sizes.max()) + SHORT)[place + SHORT], first)

    def __len__(self) -> int:
        return len(self.start)

    def bounds(self, rows: int) -> np.ndarray:
        """The first word of each row, and the number of words."""
        return np.searchsorted(self.doc, np.arange(rows + 1))


def _coefficients(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of k hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i, c in enumerate(_coefficients(k)):
        total += h[i : i + n] * c
    return mix(total)


def shingles(words: Words, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's k-word shingles in order, and the bounds of the rows.

    A row of 1 to k-1 words has one shingle, its whole sequence; one without words has none.
    """
    first = words.bounds(rows)
    sizes = np.diff(first)
    every = windows(words.hash, k)
    counts = np.where(sizes >= k, sizes - k + 1, (sizes > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    where = np.repeat(first[:-1] - bounds[:-1], counts) + np.arange(bounds[-1])
    out = np.empty(bounds[-1], np.uint64)
    inside = where < len(every)
    out[inside] = every[where[inside]]
    for row in np.flatnonzero((sizes > 0) & (sizes < k)):
        some = words.hash[first[row] : first[row + 1]]
        out[bounds[row]] = windows(some, len(some))[0] ^ np.uint64(len(some))
    return out, bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values of each row, and the new bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return (
        np.concatenate(parts) if parts else np.zeros(0, np.uint64),
        np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64),
    )


_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def plain(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text without ASCII punctuation and with A-Z and the capitals of Latin-1 folded, and its offsets."""
    if not len(buf):
        return buf, offs
    out = _LOWER[buf]
    second = np.flatnonzero(buf[:-1] == 0xC3) + 1
    second = second[(buf[second] >= 0x80) & (buf[second] <= 0x9E) & (buf[second] != 0x97)]
    out[second] += 0x20
    keep = ~_PUNCT[buf]
    place = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], place[offs]


def lookup(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of values in the sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(keys, values)
    at[at == len(keys)] = 0
    return np.where(keys[at] == values, at, -1)


class Table:
    """Places of 64-bit keys that are hashes already: open addressing, at most half full. Picklable."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self._build()

    def _build(self) -> None:
        self.bits = max(4, int(4 * max(len(self.keys), 1) - 1).bit_length())
        self.place = np.full(1 << self.bits, -1, np.int32)
        self._insert(0)

    def _insert(self, first: int) -> None:
        wait = np.arange(first, len(self.keys))
        slot = self._slot(self.keys[first:])
        while len(wait):
            free = self.place[slot] < 0
            self.place[slot[free]] = wait[free]
            rest = self.place[slot] != wait
            wait, slot = wait[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def add(self, keys: np.ndarray) -> None:
        """More keys, at the places after those there are."""
        n = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > len(self.place):
            self._build()
        else:
            self._insert(n)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value among the keys, -1 where absent."""
        if not len(self.keys):
            return np.full(len(values), -1, np.int32)
        slot = self._slot(values)
        out = self.place[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != values))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = self.place[slot[open_]]
            out[open_] = at
            open_ = open_[(at >= 0) & (self.keys[at] != values[open_])]
        return out


def byte_hashes(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A hash of every run buf[offs[i]:offs[i + 1]]; runs are not empty."""
    out = np.empty(len(offs) - 1, np.uint64)
    at = 0
    while at < len(out):
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + PIECE, "right")) - 1)
        lo, hi = int(offs[at]), int(offs[to])
        n = np.diff(offs[at : to + 1])
        code = buf[lo:hi].astype(np.uint64)
        code += np.uint64(1)
        place = np.arange(hi - lo, dtype=np.int64)
        place -= np.repeat(offs[at:to] - lo, n)
        code *= _powers(int(n.max()) + 1)[place]
        out[at:to] = mix(np.add.reduceat(code, offs[at:to] - lo) + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = to
    return out
