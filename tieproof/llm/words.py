"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A batch is handled in chunks of a few megabytes, so memory follows the chunk and
the longest single text, not the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 2 << 20
PIECE = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mix of 64 bits, so that close numbers end far apart."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_UP = _powers(_BASE, PIECE)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), PIECE)


@dataclass
class Words:
    """``data`` folded bytes; word ``i`` is ``data[start[i]:end[i]]``; text ``d`` has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, the same wherever the word stands."""
        out = np.empty(len(self.start), np.uint64)
        lo = 0
        while lo < len(out):
            at = self.start[lo]
            hi = max(lo + 1, int(np.searchsorted(self.end, at + PIECE, side="right")))
            piece = self.data[at:self.end[hi - 1]]
            if len(piece) > PIECE:
                out[lo] = int.from_bytes(hashlib.blake2b(piece.tobytes(), digest_size=8).digest(), "little")
            else:
                total = np.zeros(len(piece) + 1, np.uint64)
                np.cumsum(_BYTE[piece] * _UP[:len(piece)], out=total[1:])
                s, e = self.start[lo:hi] - at, self.end[lo:hi] - at
                out[lo:hi] = (total[e] - total[s]) * _DOWN[s]
            lo = hi
        return _mixed(out)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text each."""
    if len(texts) == 0:
        return
    bounds = text_bytes(texts)[1]
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


def split(texts: pa.Array, fold: np.ndarray = LOWER, space: np.ndarray = SPACE) -> Words:
    """Words of each text: the longest runs of bytes that are no ``space``."""
    raw, bounds = text_bytes(texts)
    inside = ~space[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(raw)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(fold[raw], bounds, start, end, np.searchsorted(start, bounds))


def shingles(words: Words, size: int = 5) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its runs of ``size`` words.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    h = words.hashes()
    weight = _mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - size + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(size):
        runs += h[k:k + n] * weight[k]
    runs = _mixed(runs)
    out = []
    for lo, hi in zip(words.first[:-1], words.first[1:]):
        if hi - lo >= size:
            got = np.sort(runs[lo:hi - size + 1])
            out.append(got[np.concatenate(([True], got[1:] != got[:-1]))])
        elif hi > lo:
            short = (h[lo:hi] * weight[:hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(_mixed(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
