"""Words of many texts at once, in numpy: where they lie, and a 64-bit hash of each.

Used inside tasks.  A batch of texts is one byte buffer with offsets, as Arrow delivers it; nothing here loops over words.
Memory is bounded: batches are cut into slices of at most :data:`SLICE_BYTES` (or one text, where that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Small, as the arrays over a slice take many times its bytes, and a worker keeps most of the memory that it once had.
SLICE_BYTES = 1 << 18
U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every output bit depends on every input bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
with np.errstate(over="ignore"):
    _CODE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95)) | U(1)


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown when a longer buffer comes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, _BASE, U)]), dtype=U)
                self.down = np.cumprod(np.concatenate([np.ones(1, U), np.full(n, _INVERSE, U)]), dtype=U)
        return self.up, self.down


_POWERS = _Powers()


class Hasher:
    """Hashes of any stretches of one buffer, from one running sum over it; equal bytes give equal hashes."""

    def __init__(self, data: np.ndarray, code: np.ndarray | None = None) -> None:
        """``code``: a 64-bit code for each element; by default that of its byte."""
        up, self._down = _POWERS.upto(len(data) + 1)
        self._sum = np.zeros(len(data) + 1, U)
        with np.errstate(over="ignore"):
            np.cumsum((_CODE[data] if code is None else code) * up[: len(data)], dtype=U, out=self._sum[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(U))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty.  No copy where there are no nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, bytes, offsets) of runs of texts of at most SLICE_BYTES together, or of one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


@dataclass
class Words:
    """Words of a run of texts: those of text t are number ``bounds[t]`` to ``bounds[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def per_text(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.per_text())

    def hashes(self) -> np.ndarray:
        return Hasher(self.data)(self.start, self.end)


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    """Maximal runs of elements for which ``inside`` holds; none crosses the border of a text."""
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def lower_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words between ASCII white space, A-Z in lower case."""
    low = LOWER[data]
    return find_words(low, offsets, ~SPACE[low])


def single_spaced(words: Words) -> Words:
    """The same words in a new buffer with one space between words of a text and none elsewhere."""
    size = words.end - words.start
    last = np.zeros(len(size), bool)
    ends = words.bounds[1:][np.diff(words.bounds) > 0] - 1
    last[ends] = True
    step = size + ~last
    start = np.cumsum(step) - step
    total = int(step.sum())
    data = np.full(total, 32, np.uint8)
    source = np.repeat(words.start - start, size) + ragged(start, size)
    data[ragged(start, size)] = words.data[source]
    return Words(data, start, start + size, words.bounds)


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, … (size[0] of them), start[1], …"""
    total = int(size.sum())
    shift = np.cumsum(size) - size
    return np.arange(total, dtype=np.int64) + np.repeat(start - shift, size)


def lookup(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted table, or -1."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A UTF-8 buffer with its offsets as code points."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, before[offsets]


class Tally:
    """Counts of 64-bit keys, gathered bit by bit; memory follows the number of distinct keys."""

    #: Keys that wait to be added up, beyond as many as there are distinct ones.
    WAITING = 1 << 15

    def __init__(self) -> None:
        self._parts: list[tuple[np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._parts.append((keys, counts))
        self._waiting += len(keys)
        if self._waiting > self.WAITING + len(self._parts[0][0]):
            self._parts = [self.total()]
            self._waiting = 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and their counts."""
        if not self._parts:
            return np.zeros(0, U), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self._parts])
        counts = np.concatenate([c for _, c in self._parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
        return keys[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def sliding(values: np.ndarray, window: int, least: bool) -> np.ndarray:
    """Smallest (or largest) value of every full window, by doubling."""
    pick, width = (np.minimum if least else np.maximum), 1
    while 2 * width <= window:
        values, width = pick(values[:-width], values[width:]), 2 * width
    return pick(values[: len(values) - (window - width)], values[window - width :]) if width < window else values


def winnowed(h: np.ndarray, window: int) -> np.ndarray:
    """Marks the values that are smallest in some window; equal stretches of ``window`` values choose the same of them."""
    if len(h) < window:
        return h == h.min() if len(h) else np.zeros(0, bool)
    low = sliding(h, window, True)
    edge = np.zeros(window - 1, h.dtype)
    return sliding(np.concatenate([edge, low, edge]), window, False) == h
