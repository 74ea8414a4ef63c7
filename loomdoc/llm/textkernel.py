"""Vectorised word and shingle kernel over Arrow string buffers (numpy, no per-word Python).

A batch of texts is handled as one array of UTF-8 bytes with document offsets.  Both word
definitions used by the operators are byte classes, so no text is decoded: every byte of a
non-ASCII character is a word byte in either of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_BYTE = np.arange(256)
#: Separator bytes: white space of [^\x20\x09-\x0D]+, and all but digits, letters and non-ASCII.
SPACE = (_BYTE == 0x20) | ((_BYTE >= 0x09) & (_BYTE <= 0x0D))
NOT_WORD = ~(((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A)) | (_BYTE >= 0x80))

_R = 0x9E3779B97F4A7C15 | 1
_M = np.uint64(0xD6E8FEB86659FD93)
_LOW = 4096


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * base & 0xFFFFFFFFFFFFFFFF
    return out


_POW = _powers(_R, _LOW)
_POW_HIGH = _powers(pow(_R, _LOW, 1 << 64), 1024)

#: Texts are handled together up to so many bytes; a longer text goes alone.
CHUNK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: spreads a 64-bit value over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of row ranges of about CHUNK_BYTES; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    yield from _ranges(pc.fill_null(column.cast(pa.large_string()), ""))


def binary_chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As text_chunks, of a column of bytes without nulls."""
    yield from _ranges(column.cast(pa.large_binary()))


def _ranges(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    if not len(column):
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + CHUNK_BYTES, "right")) - 1)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def run_hashes(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of values between the bounds cut, none of them empty."""
    lens = np.diff(cut)
    place = np.arange(cut[-1], dtype=np.int64) - np.repeat(cut[:-1], lens)
    if int(lens.max()) <= _LOW:
        weight = np.take(_POW, place)
    else:  # very long runs without a separator
        high = place >> 12
        weight = _POW[place & (_LOW - 1)] * _POW_HIGH[high & 1023]
        weight += (high >> 10).astype(np.uint64)
    value = values.astype(np.uint64)
    value += np.uint64(1)
    value *= weight
    return mix(np.add.reduceat(value, cut[:-1]) + lens.astype(np.uint64) * _M)


class Words:
    """Words of a chunk: body (folded bytes of all words), cut (their bounds in body),
    counts and bounds per document, 64-bit hashes."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, separators: np.ndarray, hashed: bool = True, fold: bool = True):
        keep = ~separators[data]
        full = offs[:-1] < offs[1:]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[1:-1] = keep[:-1]
        edge[offs[:-1][full]] = False
        starts = np.flatnonzero(keep & ~edge[:-1])
        edge[:-1] = keep
        edge[-1] = False
        edge[offs[:-1][full]] = False
        ends = np.flatnonzero(keep & ~edge[1:]) + 1
        self.starts, self.ends = starts, ends
        self.bounds = np.searchsorted(starts, offs)
        self.counts = np.diff(self.bounds)
        lens = ends - starts
        self.lens = lens
        self.cut = np.zeros(len(starts) + 1, dtype=np.int64)
        np.cumsum(lens, out=self.cut[1:])
        body = data[keep]
        self.body = _FOLD[body] if fold else body
        self.hash = self._hash() if hashed else None

    def __len__(self) -> int:
        return len(self.starts)

    def _hash(self) -> np.ndarray:
        if not len(self):
            return np.empty(0, np.uint64)
        return run_hashes(self.body, self.cut)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def text(self, i: int, j: int) -> bytes:
        """Words i to j, space between."""
        return b" ".join(bytes(self.body[self.cut[k] : self.cut[k + 1]]) for k in range(i, j))


def sequence_hash(words: Words, seed: int) -> np.ndarray:
    """64-bit hash of each document's word sequence; no words: 0."""
    out = np.zeros(len(words.counts), dtype=np.uint64)
    if len(words):
        place = np.arange(len(words)) - np.repeat(words.bounds[:-1], words.counts)
        value = mix(words.hash + mix(place.astype(np.uint64) * _M + np.uint64(seed)))
        full = words.counts > 0
        out[full] = mix(np.add.reduceat(value, words.bounds[:-1][full]) + words.counts[full].astype(np.uint64))
    return out


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles, document by document, and their bounds.

    A document of 1 to k-1 words has one: the whole sequence."""
    n = words.counts
    sizes = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    bounds = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(sizes, out=bounds[1:])
    out = np.empty(int(bounds[-1]), dtype=np.uint64)
    h = words.hash
    if len(h) >= k:
        acc = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for j in range(k):
            acc = acc * _M + h[j : len(h) - k + 1 + j]
        first = np.repeat(words.bounds[:-1], np.where(n >= k, sizes, 0))
        whole = np.repeat(bounds[:-1], np.where(n >= k, sizes, 0))
        if len(first):
            dest = np.flatnonzero(np.repeat(n >= k, sizes))
            out[dest] = mix(acc[first + (dest - whole)])
    for length in range(1, k):
        docs = np.flatnonzero(n == length)
        if len(docs):
            s = words.bounds[:-1][docs]
            acc = np.full(len(docs), length, dtype=np.uint64)
            for j in range(length):
                acc = acc * _M + h[s + j]
            out[bounds[:-1][docs]] = mix(acc)
    return out, bounds
