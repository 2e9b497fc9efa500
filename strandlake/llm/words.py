"""Words and shingles of Arrow string columns as numpy arrays.

A word is a run of bytes other than \\x20 and \\x09-\\x0D. These are ASCII, so the UTF-8 bytes of a text can be cut
without decoding it. Hashes are 64 bits wide; the constants are arbitrary odd numbers and a seeded table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_LOW = 12
#: _STEP to the powers 0 .. 2^_LOW - 1.
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full((1 << _LOW) - 1, _STEP)]), dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes whose hash terms are held at once, unless one word is longer.
CHUNK = 400_000


def _power(place: np.ndarray) -> np.ndarray:
    """_STEP to the power of each place; the tables stay small for words of any length."""
    if not len(place) or int(place.max()) < len(_POWERS):
        return _POWERS[place]
    out = _POWERS[place & ((1 << _LOW) - 1)]
    far = np.flatnonzero(place >> _LOW)
    with np.errstate(over="ignore"):
        leap = _POWERS[-1] * _STEP
        high = place[far] >> _LOW
        table = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(high.max()), leap)]), dtype=np.uint64)
        out[far] *= table[high]
    return out


def byte_hashes(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; the spans, of at least one byte, lie side by side and are all of data."""
    out, ends, i = np.zeros(len(length), np.uint64), np.cumsum(length), 0
    while i < len(length):
        low = int(ends[i] - length[i])
        j = max(int(np.searchsorted(ends, low + CHUNK, "right")), i + 1)
        begin = ends[i:j] - length[i:j] - low
        part = data[low : int(ends[j - 1])]
        place = np.arange(len(part), dtype=np.int64) - np.repeat(begin, length[i:j])
        out[i:j] = np.add.reduceat(_BYTE[part] * _power(place), begin)
        i = j
    return mix(out + length.astype(np.uint64))


@dataclass
class Words:
    """Words of consecutive documents: doc (index of each word's document), first (index of each document's first word, and the end)."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    length: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most so many bytes, or of one row."""
    size = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += int(n)
    if begin < len(size):
        yield begin, len(size)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(what, np.uint8)[offsets[0] : offsets[-1]] if what is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = raw(column)
    n = len(offsets) - 1
    inside = IS_WORD[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    before[edges] = False
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    length = np.flatnonzero(inside & ~after) + 1 - start
    doc = np.searchsorted(offsets, start, "right") - 1
    first = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int64)
    if not len(start):
        return Words(data, offsets, start, length, doc, first, np.zeros(0, np.uint64))
    inner = (_LOWER if lower else _SAME)[data[inside]]
    return Words(data, offsets, start, length, doc, first, byte_hashes(inner, length))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * _GRAM + h[k : k + m]
    return mix(out + np.uint64(n))


def shingle_sets(column: pa.Array, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each document's n-word shingles over lower-cased (A-Z) words; a shorter document is one shingle, an empty one none."""
    w = split(column, lower=True)
    every = grams(w.hash, n)
    out = []
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        out.append(np.unique(every[a : b - n + 1]) if b - a >= n else grams(w.hash[a:b], int(b - a)) if b > a else every[:0])
    return out
