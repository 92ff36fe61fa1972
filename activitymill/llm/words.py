"""Words of whole Arrow columns as NumPy arrays: the shared inner loop of the text operators.

A word is a run of bytes other than space and 0x09 to 0x0D, with A-Z lower-cased unless asked otherwise. Texts are
cut into slices of some megabytes between documents, so a task holds a bounded piece besides its Arrow batch; hashing
goes over still smaller blocks. A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BLOCK = 1 << 18
_ODD = np.uint64(0x9E3779B97F4A7C15)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


# A byte's value in a hash; drawn from a rule, not from a list.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = 0x5851F42D4C957F2D
_POW = powers(_BASE, _BLOCK + 1)
_INV = powers(pow(_BASE, -1, 1 << 64), _BLOCK + 1)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; equal spans have equal hashes. Starts ascend."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, first + _BLOCK // 2)))
        last = int(ends[i:j].max())
        if last - first > _BLOCK:
            # Spans longer than what is left of the block are folded piece by piece.
            long = ends[i:j] - first > _BLOCK
            for k in np.flatnonzero(long) + i:
                out[k] = _hash_long(data[starts[k]:ends[k]])
            keep = np.flatnonzero(~long) + i
        else:
            keep = np.arange(i, j)
        if len(keep):
            last = int(ends[keep].max())
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(_BYTE[data[first:last]] * _POW[:last - first], out=sums[1:])
            s, e = starts[keep] - first, ends[keep] - first
            out[keep] = mix((sums[e] - sums[s]) * _INV[s] + (e - s).astype(np.uint64))
        i = j
    return out


def _hash_long(span: np.ndarray) -> np.uint64:
    """The same hash for a span of any length."""
    total, at = np.uint64(0), 1
    with np.errstate(over="ignore"):
        for k in range(0, len(span), _BLOCK):
            piece = span[k:k + _BLOCK]
            part = (_BYTE[piece] * _POW[:len(piece)]).sum(dtype=np.uint64)
            total = total + part * np.uint64(at)
            at = at * pow(_BASE, len(piece), 1 << 64) % (1 << 64)
        return mix(np.array([total + np.uint64(len(span))]))[0]


@dataclass
class Texts:
    """Some documents: their bytes end to end, and where each begins."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents
    first: int  # index of the first document in the batch

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, lower: bool = True) -> Words:
        data = _LOWER[self.data] if lower else self.data
        inside = ~_SPACE[self.data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return Words(data, starts, ends, np.searchsorted(starts, self.offsets))


@dataclass
class Words:
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # of each document's words, one more than documents

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)

    def documents(self) -> np.ndarray:
        """Index of the document of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def texts(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """Slices of a text column, none larger than ``max_bytes`` unless it is a single document."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        yield Texts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], i)
        i = j


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions are left out."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = total * _ODD + hashes[k:k + size]
    return mix(total)


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Word n-grams within documents, and the offsets of each document's. A document of fewer words, but some, has
    one shingle: all its words."""
    hashes = words.hashes()
    counts = np.diff(words.offsets)
    all_grams = ngrams(hashes, n)
    sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    short = np.flatnonzero((counts > 0) & (counts < n))
    place = np.repeat(words.offsets[:-1] - offsets[:-1], sizes) + np.arange(offsets[-1])
    out = all_grams[np.minimum(place, len(all_grams) - 1)] if len(all_grams) else np.zeros(offsets[-1], np.uint64)
    for d in short:
        own = hashes[words.offsets[d]:words.offsets[d + 1]]
        out[offsets[d]] = ngrams(own, len(own))[0] ^ np.uint64(len(own))
    return out, offsets


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each document in ascending order, their offsets, and how often each occurs."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(fresh)
    counts = np.diff(np.append(at, len(v)))
    return v[at], np.concatenate([[0], np.cumsum(np.bincount(o[at], minlength=len(offsets) - 1))]), counts
