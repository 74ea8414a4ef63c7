"""Terms of groups of texts, on Arrow batches.

Rows come group by group (one shuffle of the texts, sorted within partitions), so that no term is a row of a shuffle: a batch's
terms are counted by one stable sort.  A group is held until its last row, so a long one costs memory for its tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def changes(*columns: pa.Array) -> np.ndarray:
    """Whether a row differs from the one before it in any of the columns; the first row does."""
    n = len(columns[0])
    out = np.zeros(n, dtype=bool)
    out[:1] = True
    for c in columns:
        if pa.types.is_nested(c.type):
            values = c.to_pylist()
            code = np.array([0, *(a != b for a, b in zip(values, values[1:], strict=False))][:n]).cumsum()
        else:
            code = pc.dictionary_encode(c, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= code[1:] != code[:-1]
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups: the rows of a batch's last group wait for the next batch.  The first columns are the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(np.flatnonzero(changes(*batch.columns[:keys]))[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = []
        elif held and any(batch.column(i)[0].as_py() != held[-1].column(i)[0].as_py() for i in range(keys)):
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def one(table: pa.Table, i: int) -> pa.Array:
    """A column in one piece."""
    c = table.column(i)
    return c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type)


def coded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, number of the word) of every word of a column of word lists, and the words by number."""
    lists = pc.if_else(lists.is_valid(), lists, pa.scalar([], lists.type)) if lists.null_count else lists
    told = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return row, told.indices.to_numpy(zero_copy_only=False).astype(np.int64), told.dictionary


def top(batches: Iterator[pa.RecordBatch], keys: int, k: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """keys, terms, scores (lists in order of rank) of rows (keys, order, whether the text counts, its tokens) in that order."""
    for t in whole_groups(batches, keys):
        named = [one(t, i) for i in range(keys)]
        begins = changes(*named)
        group, text = np.cumsum(begins) - 1, np.cumsum(begins | changes(one(t, keys))) - 1
        total = np.bincount(group, weights=one(t, keys + 1).to_numpy(zero_copy_only=False))
        row, number, words = coded(one(t, keys + 2))
        if not len(row):
            continue
        key = group[row] * len(words) + number
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[row[order]]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        at = np.flatnonzero(new)
        tf, first = np.diff(np.append(at, len(key))), order[at]
        df = np.add.reduceat(new | np.concatenate([[True], text[1:] != text[:-1]]), at, dtype=np.int64)
        group, number = key[at] // len(words), key[at] % len(words)
        score = tf * (np.log((total[group] + 1) / (df + 1)) + 1)
        best = np.lexsort((first, -score, group))
        group = group[best]
        start = np.concatenate([[True], group[1:] != group[:-1]])
        place = np.arange(len(group)) - np.maximum.accumulate(np.where(start, np.arange(len(group)), 0))
        best, group = best[place < k], group[place < k]
        start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        bounds = pa.array(np.append(start, len(group)).astype(np.int32))
        rows = pa.array(np.flatnonzero(begins)[group[start]])
        made = pa.ListArray.from_arrays(bounds, words.take(pa.array(number[best]))), pa.ListArray.from_arrays(bounds, pa.array(score[best]))
        yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in named), *made], schema=schema)
