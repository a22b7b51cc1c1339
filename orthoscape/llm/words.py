"""Words of whole Arrow string columns as 64-bit hashes, by numpy.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 that
equals the runs of ``[^\\x20\\x09-\\x0D]+``.  A text is read in full; chunks end
at document borders only, so that a very long text forms a chunk by itself.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_rng = np.random.Generator(np.random.PCG64(20240117))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Class of each byte: 0 separates words.
WORD = np.ones(256, np.uint8)
WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
#: Letters, digits and bytes over 0x7F apart from signs.
TOKEN = WORD * 2
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


@functools.lru_cache(1)
def _kept_tables() -> list[np.ndarray]:
    return _made_tables(CHUNK_BYTES + 1)


def _made_tables(n: int) -> list[np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        table = np.full(n, base, np.uint64)
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    return out


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers 0 to n - 1 at least; those for a text over CHUNK_BYTES aren't kept."""
    return _kept_tables() if n <= CHUNK_BYTES + 1 else _made_tables(n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


class Words:
    """Words of documents lo..hi-1 of a batch: hash, byte span, and word offsets of each document.

    A word is a run of bytes of one class that isn't 0.
    """

    def __init__(self, lo: int, hi: int, data: np.ndarray, bounds: np.ndarray, lower: bool, classes):
        self.lo, self.hi, self.data, self.bounds = lo, hi, data, bounds
        kind = classes(data, bounds) if callable(classes) else classes[data]
        solid = kind > 0
        first, last = solid.copy(), solid.copy()
        if len(data):
            turn = kind[1:] != kind[:-1]
            first[1:] &= turn
            last[:-1] &= turn
            full = bounds[:-1] < bounds[1:]
            heads, tails = bounds[:-1][full], bounds[1:][full] - 1
            first[heads] = solid[heads]
            last[tails] = solid[tails]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        power, inverse = _power_tables(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER if lower else _BYTE)[data] * power[: len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))
        self.offsets = np.searchsorted(self.start, bounds)

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def word_chunks(column: pa.Array, lower: bool = False, classes=WORD) -> Iterator[Words]:
    """Words of all texts of the column, in chunks of about CHUNK_BYTES.

    classes: a table by byte, or a function of a chunk's bytes and text borders.
    """
    data, offsets = utf8(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1)
        hi = min(hi, n)
        yield Words(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower, classes)
        lo = hi


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each document's distinct shingles, ascending, and their offsets.

    A text of 1 to width-1 words has its whole sequence as its only shingle;
    one without words has none.
    """
    n, h = words.counts(), words.hash
    odd = np.uint64(0xD6E8FEB86659FD93)
    rolled = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for j in range(width):
        rolled = mix(rolled * odd + h[j : j + len(rolled)]) if j else mix(h[: len(rolled)] + np.uint64(width))
    parts = []
    sizes = np.zeros(len(n), np.int64)
    for d, (a, b) in enumerate(zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True)):
        if b - a >= width:
            own = np.sort(rolled[a : b - width + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif b > a:
            one = np.uint64(b - a)
            for x in h[a:b]:
                one = mix(np.array([one], np.uint64) * odd + x)[0]
            own = np.array([one], np.uint64)
        else:
            continue
        sizes[d] = len(own)
        parts.append(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])
