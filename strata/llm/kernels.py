"""Array kernels over batches of texts: word bounds, word and shingle hashes.

Texts are handled as UTF-8 bytes. Every function takes a bounded batch (see
``slices``) and works on arrays, so its memory follows the batch and not the
partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII white space: the complement of ``[^\\x20\\x09-\\x0D]``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_POW = np.cumprod(np.r_[np.uint64(1), np.full(65535, _BASE, np.uint64)], dtype=np.uint64)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 257, dtype=np.uint64) | np.uint64(1)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Row slices of at most ``max_bytes`` of text each, at least one row."""
    if batch.num_rows == 0:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if i > start and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """Texts as bytes; null stays None."""
    return batch.column(column).cast(pa.binary()).to_pylist()


class Words:
    """Words of many texts: hashes in order, and each text's range of them."""

    def __init__(self, texts: list[bytes | None], lower: bool = True):
        parts = [t or b"" for t in texts]
        buf = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        if lower:
            buf = LOWER[buf]
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        begin = np.r_[0, np.cumsum(lens + 1)]
        gap = SPACE[buf]
        before = np.r_[True, gap[:-1]]
        self.buf = buf
        self.start = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(gap & ~before)
        self.first = np.searchsorted(self.start, begin[:-1])
        self.last = np.searchsorted(self.start, begin[1:])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        inside = np.repeat(self.start - np.r_[0, np.cumsum(length)[:-1]], length) + np.arange(length.sum())
        place = inside - np.repeat(self.start, length)
        value = _BYTE[self.buf[inside]] * _POW[place & 65535]
        if place.max(initial=0) > 65535:
            value *= ((place >> 16).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        at = np.r_[0, np.cumsum(length)[:-1]]
        return mix64(np.add.reduceat(value, at) + length.astype(np.uint64) * _BYTE[256])


def shingle_sets(texts: list[bytes | None], width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its word shingles.

    A text of fewer than ``width`` words has its whole sequence as its only
    shingle; without words (or null) the set is empty.
    """
    words = Words(texts)
    h = words.hashes()
    total = len(h)
    mult = [np.uint64(int(x) | 1) for x in _BYTE[:width]]
    # whole shingles at every start that has width - 1 words after it
    full = np.zeros(max(0, total - width + 1), np.uint64)
    for k in range(width):
        full += mix64(h[k : k + len(full)] + np.uint64(k)) * mult[k]
    full = mix64(full)
    out = []
    for a, b in zip(words.first.tolist(), words.last.tolist()):
        if b - a >= width:
            out.append(np.unique(full[a : b - width + 1]))
        elif b > a:
            part = h[a:b]
            acc = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for k in range(b - a):
                    acc = acc * mult[0] + mix64(part[k : k + 1] + np.uint64(k))[0]
            out.append(mix64(np.array([acc], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
