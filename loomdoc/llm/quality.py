"""Quality classifier: supervised subword embeddings.

A document is the mean of the learned vectors of its words and of its words' byte n-grams
(3 and 4, with word ends), hashed into BUCKETS, and of a token for each word repeated within REPEATS
places (vectors of single words cannot show that); a softmax layer gives the two classes.  Vectors and layer
are trained together by numpy stochastic gradient descent on the driver, on a bounded
sample: TRAIN_ROWS labelled documents, those with the smallest hashes of their ids, as far as TRAIN_BYTES of text go (in
that order; one that no longer fits is passed over).  Its features are made in tasks and reach the driver packed, to be
widened a document at a time.  As the
layer is linear, a trained bucket reduces to one number, so scoring gathers one float per feature.

Scale.  The sample is found with a top-k over slim labels, and its ids (TRAIN_ROWS at most)
are broadcast; of rows of one id one text is taken, before anything is shuffled; scoring reads each document once, without a shuffle, from a table of 1 MB.

Cases: null and wordless texts get the score of the bias alone; without labelled rows of both classes all
scores are the share of label 1 (0.5 without any); rows with null ids are scored and never
trained on; repeated rows are judged each by itself; of other columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, small_batches, written
from .textkernel import SPACE, Words, text_chunks

TRAIN_ROWS, TRAIN_BYTES, BUCKET_BITS, DIM, EPOCHS, RATE = 4000, 32 << 20, 18, 8, 6, 4.0
BUCKETS = 1 << BUCKET_BITS
REPEATS = (1, 2, 3)


def _hashed(values: np.ndarray, salt: int) -> np.ndarray:
    return (((values.astype(np.uint32) ^ np.uint32(salt)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def _features(data: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets of words, 3-grams and 4-grams of a chunk, each with its bounds per document."""
    words = Words(data, offs, SPACE, fold=False)
    n = len(words)
    line = np.full(len(words.body) + n + 1, 0x20, dtype=np.uint8)
    line[np.arange(len(words.body)) + np.repeat(np.arange(n), words.lens) + 1] = words.body
    inner = line != 0x20
    # the first place of every document in line
    firsts = words.cut[words.bounds] + words.bounds
    parts = [(words.hash >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)]
    bounds = [words.bounds]
    doc = words.doc_of()
    for back in REPEATS:  # a token of its own wherever a word is that of so many places before
        same = np.flatnonzero((words.hash[back:] == words.hash[:-back]) & (doc[back:] == doc[:-back])) + back
        parts.append(np.full(len(same), back, np.int32))
        bounds.append(np.searchsorted(same, words.bounds))
    wide = line.astype(np.uint32)
    for size in (3, 4):
        if len(line) < size:
            at = np.empty(0, np.int64)
            value = np.empty(0, np.uint32)
        else:
            m = len(line) - size + 1
            ok = inner[1 : m + 1] & inner[size - 2 : size - 2 + m]
            at = np.flatnonzero(ok)
            value = sum((wide[at + j] << np.uint32(8 * j) for j in range(size)), np.zeros(len(at), np.uint32))
        parts.append(_hashed(value, size * 0x51ED27))
        bounds.append(np.searchsorted(at, firsts))
    return parts, bounds


def _slim(values: np.ndarray) -> bytes:
    """Whole numbers as the smallest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}") if n else np.empty(0, np.uint8)


_COUNTED = "label int, n int, gaps binary, counts binary"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document (text, label): the number of its buckets, the gaps between them in order, and their counts."""
    for batch in batches:
        sizes, gaps, counts = [], [], []
        for a, b, data, offs in text_chunks(batch.column(0)):
            parts, bounds = _features(data, offs)
            for i in range(b - a):
                u, c = np.unique(np.concatenate([p[x[i] : x[i + 1]] for p, x in zip(parts, bounds, strict=True)]), return_counts=True)
                sizes.append(len(u))
                gaps.append(_slim(np.diff(u, prepend=0)))
                counts.append(_slim(c))
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sizes, pa.int32()), pa.array(gaps, pa.binary()), pa.array(counts, pa.binary())], names=[x.split()[0] for x in _COUNTED.split(", ")])


class Sample(Sequence):
    """(label, buckets, counts) of the documents that _counted() gives, widened one at a time as they are read; in the order of the bytes of all three."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.combine_chunks()
        self.order = range(len(rows))
        head, whole = (lambda i: (self[i][0], self[i][1][:64].tobytes())), (lambda i: tuple(x.tobytes() for x in self[i][1:]))
        heads = [head(i) for i in self.order]
        alike = groupby(sorted(self.order, key=heads.__getitem__), heads.__getitem__)
        self.order = [i for same in [list(g) for _, g in alike] for i in (sorted(same, key=whole) if len(same) > 1 else same)]

    def __len__(self) -> int:
        return self.rows.num_rows

    def __getitem__(self, i: int) -> tuple[int, np.ndarray, np.ndarray]:
        label, n, gaps, counts = (c[self.order[i]].as_py() for c in self.rows.columns)
        return label, np.cumsum(_wide(gaps, n), dtype=np.int32), _wide(counts, n).astype(np.float32)


def learned(rows: Sequence[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> tuple[np.ndarray, float]:
    """(weight per bucket, bias) of the log odds of label 1, by stochastic gradient descent."""
    labels = np.array([r[0] for r in rows], dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-6, 1 - 1e-6))
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer = np.zeros((2, DIM), dtype=np.float32)
    bias = np.log(np.bincount(labels, minlength=2) / len(labels)).astype(np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            label, buckets, counts = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ layer
            layer -= 0.1 * rate * np.outer(p, mean)
            bias -= 0.01 * rate * p
            vectors[buckets] -= rate * share[:, None] * back
    return vectors @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES) -> tuple[np.ndarray, float]:
    """Model from the labelled documents outside the held-out third, train_rows of them and train_bytes of text at most."""
    small_batches(docs.sparkSession)
    chosen = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"))
    chosen = chosen.where(~held_out("_id")).distinct().orderBy(F.xxhash64("_id"), "_id", "label").limit(train_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    found = written(found.groupBy("_id", "label").agg(F.min("text").alias("text")), "quality-sample")
    left, fit = train_bytes, []
    for id_, label, size in found.select("_id", "label", F.coalesce(F.octet_length("text"), F.lit(0))).orderBy(F.xxhash64("_id"), "_id", "label").collect():  # train_rows at most
        if size <= left:
            left -= size
            fit.append((id_, label))
    fit = F.broadcast(docs.sparkSession.createDataFrame(fit, found.select("_id", "label").schema))
    rows = Sample(found.join(fit, ["_id", "label"]).select("text", "label").mapInArrow(_counted, _COUNTED).toArrow())  # less than twice the bytes of the texts
    removed(found)
    model = learned(rows)
    del rows
    pa.default_memory_pool().release_unused()  # else the driver keeps that memory through all that follows
    return model


def held_out(column: str):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 3 == 1


def _scores(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    out = []
    for a, b, data, offs in text_chunks(column):
        total, count = np.zeros(b - a), np.zeros(b - a)
        for buckets, bounds in zip(*_features(data, offs), strict=True):
            n = np.diff(bounds)
            full = n > 0
            if full.any():
                total[full] += np.add.reduceat(weights[buckets].astype(np.float64), bounds[:-1][full])
            count += n
        out.append(1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -700, 700))))
    return np.concatenate(out) if out else np.empty(0)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(_scores(batch.column(2), *shared.value))], names=["doc_id", "held_out", "score"])

    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are predicted to be of label 1."""
    small_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    names, arrow = docs.columns, to_arrow_schema(docs.schema)
    at = names.index("text")

    def run(batches):
        for batch in batches:
            kept = batch.filter(pa.array(_scores(batch.column(at), *shared.value) >= 0.5))
            yield pa.RecordBatch.from_arrays(kept.columns, schema=arrow)

    return docs.mapInArrow(run, docs.schema)
