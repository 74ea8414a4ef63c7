"""Hashed bags of words and the likeness of a document's chunks, on Arrow batches.

A vector belongs to one row, so it is made where the row is, without a shuffle.  Chunks are compared where their
document's come together (one shuffle by document): products of blocks of BLOCK chunks, of which only running
maxima are kept, so a long document costs memory for its words and one block, and no pair becomes a row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from .terms import changes, coded, one, whole_groups

BLOCK = 256


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Arrow batches of so many rows at most from now on: these rows are whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "0")) <= rows:
        spark.conf.set(key, rows)


#: Places of words met by this worker.
_PLACES: dict[str, int] = {}


def _place(words: pa.Array, size: int) -> np.ndarray:
    """Hashed place of each word."""
    if len(_PLACES) > 500_000:
        _PLACES.clear()
    listed = words.to_pylist()
    for w in listed:
        if w not in _PLACES:
            _PLACES[w] = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
    return np.array([_PLACES[w] for w in listed], dtype=np.int64) % size


def _bags(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, weight) of the unit vectors of a column of word lists, in order of row and place."""
    row, number, told = coded(column)
    key, n = np.unique(row * size + _place(told, size)[number], return_counts=True) if len(number) else (number, number)
    row, place = key // size, key % size
    length = np.sqrt(np.bincount(row, weights=n.astype(np.float64) ** 2, minlength=len(column)))
    return row, place, n / length[row]


def vectors(batches: Iterator[pa.RecordBatch], keys: int, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """keys, bucket, w: a row per non-zero place of every row's vector; the column after the keys holds its words."""
    for batch in batches:
        row, place, w = _bags(batch.column(keys), size)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays([*(batch.column(i).take(take) for i in range(keys)), pa.array(place.astype(np.int32)), pa.array(w)], schema=schema)


def encoded(batches: Iterator[pa.RecordBatch], load, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The last column, texts, by a model's encode(), size at a time."""
    model = None
    for batch in batches:
        model = load() if model is None else model
        texts = batch.column(batch.num_columns - 1).to_pylist()
        made = [np.asarray(v, dtype=np.float64).tolist() for i in range(0, len(texts), size) for v in model.encode(texts[i : i + size])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, schema.field("embedding").type)], schema=schema)


def _blocks(row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, dense rows) of a sparse matrix of n rows, sorted by row, BLOCK at a time."""
    width = int(column.max()) + 1 if len(column) else 1
    for a in range(0, n, BLOCK):
        lo, hi = np.searchsorted(row, [a, a + BLOCK])
        dense = np.zeros((min(BLOCK, n - a), width))
        dense[row[lo:hi] - a, column[lo:hi]] = value[lo:hi]
        yield a, dense


def _largest(row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int, near) -> np.ndarray:
    """Largest near(products, rows, other rows) of every row with another one; 0 for a single row."""
    out = np.zeros(n)
    for a, x in _blocks(row, column, value, n):
        for b, y in [(a, x)] if n <= BLOCK else _blocks(row, column, value, n):
            s = near(x @ y.T, np.arange(a, a + len(x)), np.arange(b, b + len(y)))
            if a == b:
                np.fill_diagonal(s, 0.0)
            out[a : a + len(x)] = np.maximum(out[a : a + len(x)], s.max(axis=1))
    return out


class _Parts:
    """Cells (row, place) of a sparse matrix, sorted by row, whose rows fall into documents: places numbered within each document."""

    def __init__(self, row: np.ndarray, place: np.ndarray, width: int, first: np.ndarray):
        self.row, self.first = row, first
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        key, self.at = np.unique(doc[row] * width + place, return_inverse=True)
        self.doc, self.begin = key // width, np.searchsorted(key, np.arange(len(first)) * width)
        self.cell = np.searchsorted(row, first)

    def largest(self, d: int, value: np.ndarray, near) -> np.ndarray:
        a, (lo, hi) = self.first[d], self.cell[d : d + 2]
        return _largest(self.row[lo:hi] - a, self.at[lo:hi] - self.begin[d], value[lo:hi], self.first[d + 1] - a, near)


def _dots(row: np.ndarray, place: np.ndarray, w: np.ndarray, n: int, registry: np.ndarray | None) -> np.ndarray:
    dots = [np.bincount(row, weights=w * v[place], minlength=n) for v in registry] if registry is not None else []
    return np.stack(dots, axis=1) if len(dots) else np.zeros((n, 0))


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def products(batches: Iterator[pa.RecordBatch], registry: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The columns but the last, words, and a row's products with the registry's vectors."""
    for batch in batches:
        row, place, w = _bags(batch.column(batch.num_columns - 1), registry.shape[1])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _lists(_dots(row, place, w, batch.num_rows, registry))], schema=schema)


def _likeness(words: pa.Array, tokens: pa.Array, size: int, first: np.ndarray, registry: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """For chunks whose documents begin at the rows first (and end at its last): length of the sum of the document's vectors, cohesion
    with it, largest cosine and largest Jaccard similarity to another chunk of the document, products with the registry's vectors."""
    n, docs = len(words), len(first) - 1
    doc = np.repeat(np.arange(docs), np.diff(first))
    row, place, w = _bags(words, size)
    cells = _Parts(row, place, size, first)
    mean = np.bincount(cells.at, weights=w) if len(w) else w
    length = np.sqrt(np.bincount(cells.doc, weights=mean * mean, minlength=docs))[doc]
    cohesion = np.bincount(row, weights=w * mean[cells.at], minlength=n)
    cohesion = np.divide(cohesion, length, out=np.zeros(n), where=length > 0)
    owner, number, told = coded(tokens)
    width = max(1, len(told))
    key = np.unique(owner * width + number)
    owner, number = key // width, key % width
    sizes, ones = np.bincount(owner, minlength=n).astype(np.float64), np.ones(len(owner))
    sets = _Parts(owner, number, width, first)
    cos, jac = np.zeros(n), np.zeros(n)
    for d in np.flatnonzero(np.diff(first) > 1):
        a, b = first[d], first[d + 1]
        own = sizes[a:b]

        def jaccard(both, i, j, own=own):
            union = own[i][:, None] + own[j][None, :] - both
            return np.where(union > 0, both / np.maximum(union, 1), 1.0)

        cos[a:b] = cells.largest(d, w, lambda s, i, j: s)
        jac[a:b] = sets.largest(d, ones, jaccard)
    return length, cohesion, cos, jac, _dots(row, place, w, n, registry)


def likeness(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema, registry: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """doc_id, chunk_seq, char_len and more, mean_len and doc_length (of the document), cohesion_vs_doc, redundancy_cos_max, redundancy_jaccard_max
    (and dots) of chunks (doc_id, chunk_seq, char_len, more, words, tokens) that come document by document."""
    for t in whole_groups(batches, 1):
        k = t.num_columns - 2
        first = np.append(np.flatnonzero(changes(one(t, 0))), t.num_rows)
        chars, n = one(t, 2).to_numpy(zero_copy_only=False).astype(np.float64), np.diff(first)
        *found, dots = _likeness(one(t, k), one(t, k + 1), size, first, registry)
        made = [pa.array(np.repeat(np.add.reduceat(chars, first[:-1]) / n, n)), *map(pa.array, found)]
        made += [_lists(dots)] * (registry is not None)
        yield pa.RecordBatch.from_arrays([*(one(t, i) for i in range(k)), *made], schema=schema)


def near_topics(batches: Iterator[pa.RecordBatch], blend: float, size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """doc_id, chunk_seq, topic_ids, near: of rows (doc_id, chunk_seq, topic_ids, words, tokens, and by topic the words of each keyword and the
    keywords) blend * cosine to the mean of a topic's keywords' vectors and (1 - blend) * Jaccard of tokens and keywords."""
    for batch in batches:
        n, said, listed = batch.num_rows, batch.column(5), batch.column(6)
        if not n:
            continue
        owner = np.repeat(np.arange(n), said.value_lengths().to_numpy(zero_copy_only=False))  # of topics
        of = np.repeat(np.arange(len(owner)), said.flatten().value_lengths().to_numpy(zero_copy_only=False))  # topics of keywords
        kw, place, w = _bags(said.flatten().flatten(), size)
        key, at = np.unique(of[kw] * size + place, return_inverse=True)
        mean, topic, place = np.bincount(at, weights=w) if len(w) else w, key // size, key % size
        length = np.sqrt(np.bincount(topic, weights=mean * mean, minlength=len(owner)))
        row, own, v = _bags(batch.column(3), size)
        cells, want = row * size + own, owner[topic] * size + place
        found = np.minimum(np.searchsorted(cells, want), max(0, len(cells) - 1))
        both = np.where(cells[found] == want, v[found], 0.0) if len(cells) else np.zeros(len(want))
        cos = np.divide(np.bincount(topic, weights=both * mean, minlength=len(owner)), length, out=np.zeros(len(owner)), where=length > 0)
        tokens = [set(x or ()) for x in batch.column(4).to_pylist()]
        near = np.empty(len(owner))
        for i, (r, words) in enumerate(zip(owner, listed.flatten().to_pylist(), strict=True)):
            same = sum(x in tokens[r] for x in words)
            union = len(tokens[r]) + len(words) - same
            near[i] = same / union if union else 1.0
        bounds = np.concatenate([[0], np.cumsum(said.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(bounds), pa.array(blend * cos + (1 - blend) * near))], schema=schema)
