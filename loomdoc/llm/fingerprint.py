"""Document fingerprints by one-permutation MinHash.

Shingles of five words are hashed once; the leading bits of a hash name one of BINS bins, each
bin keeps its smallest hash.  An empty bin takes the value of the first filled bin in its own
random order of all bins (optimal densification), the same order for every document.  The low
BITS bits of each bin are packed to a hexadecimal string.  The share of equal bins, corrected for
equal bits by chance, estimates the Jaccard similarity of the shingle sets.

Scale.  For pairs of neighbours in the order of ids, texts are dealt once to id ranges of about RANGE_BYTES of text (bounds
from approximate quantiles of the ids, weighed by text length), every range its own partition; a range also gets the first
document of the range after it, so no task needs another's rows.  A range is sorted (Spark spills it) and read row by row.
Past MOST_RANGES ranges (3 TB of text) they grow instead.  Own fingerprints are made before that shuffle.

Cases: null text is empty; a text of fewer than five words is one shingle; a wordless text has
the empty fingerprint, alike (1.0) to another such and unlike (0.0) all else; rows of one id are
neighbours in the order of their texts; null ids come last; the only document is its own
neighbour; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .textkernel import SPACE, Words, mix, shingle_hashes, text_chunks

SHINGLE, BINS, BITS = 5, 512, 4
RANGE_BYTES, MOST_RANGES, WEIGH_BYTES = 32 << 20, 100_000, 8192
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_ROWS = 2048


def _orders() -> np.ndarray:
    """Every bin's own random order of all bins."""
    i = np.arange(BINS, dtype=np.uint64)
    return np.argsort(mix((i[:, None] << np.uint64(32)) + i[None, :] + np.uint64(1)), axis=1)


_ORDER = _orders()
_RANK = np.argsort(_ORDER, axis=1)


def _densified(low: np.ndarray) -> np.ndarray:
    """low (documents x bins, _FULL where empty) with empty bins filled."""
    filled, out = low != _FULL, low.copy()
    doc, bin_ = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for t in range(16):
        if not len(doc):
            return out
        other = _ORDER[bin_, t]
        hit = filled[doc, other]
        out[doc[hit], bin_[hit]] = low[doc[hit], other[hit]]
        doc, bin_ = doc[~hit], bin_[~hit]
    cuts = np.flatnonzero(np.diff(doc)) + 1
    for d, bins in zip(doc[np.concatenate([[0], cuts])] if len(doc) else (), np.split(bin_, cuts), strict=False):
        have = np.flatnonzero(filled[d])
        out[d, bins] = low[d, have[np.argmin(_RANK[bins][:, have], axis=1)]]
    return out


def _packed(texts: pa.Array) -> list[bytes]:
    """Packed fingerprints; b'' where there are no words."""
    out: list[bytes] = []
    step = np.uint64(64 - int(np.log2(BINS)))
    for _, _, data, offs in text_chunks(texts):
        for a in range(0, len(offs) - 1, _ROWS):
            o = offs[a : a + _ROWS + 1]
            hashes, bounds = shingle_hashes(Words(data[o[0] : o[-1]], o - o[0], SPACE), SHINGLE)
            low = np.full((len(o) - 1) * BINS, _FULL, dtype=np.uint64)
            place = np.repeat(np.arange(len(o) - 1, dtype=np.int64) * BINS, np.diff(bounds)) + (hashes >> step).astype(np.int64)
            np.minimum.at(low, place, hashes)
            low = _densified(low.reshape(-1, BINS))
            bits = (mix(low) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
            packed = bits[:, ::2] << 4 | bits[:, 1::2]
            out += [packed[i].tobytes() if n else b"" for i, n in enumerate(np.diff(bounds))]
    return out


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity of two packed fingerprints."""
    if not a or not b:
        return float(a == b)
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    equal = (np.count_nonzero(x & 15 == 0) + np.count_nonzero(x >> 4 == 0)) / BINS
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (equal - chance) / (1 - chance))))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row of docs."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.hex() for x in _packed(batch.column(1))], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def _range_of(ids: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """0 for the largest ids; null ids last."""
    x = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = len(bounds) - np.searchsorted(bounds, x, "left")
    out[ids.is_null().to_numpy(zero_copy_only=False)] = len(bounds) + 1
    return out


_DEALT = "range int, ghost int, doc_id long, text string, packed binary"


def _deal(batches: Iterator[pa.RecordBatch], bounds: np.ndarray, first: dict, place: dict) -> Iterator[pa.RecordBatch]:
    """Rows with their range's place among those with rows; the first documents of a range also as ghosts of the one before it."""
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).fill_null("")
        at = _range_of(ids, bounds)
        packed = pa.array(_packed(texts), pa.binary())
        rows = list(range(len(ids)))
        ghosts = [i for i, (r, x) in enumerate(zip(at.tolist(), ids.to_pylist(), strict=True)) if first[r] == x]
        take = pa.array(rows + ghosts, pa.int64())
        own = [place[r] for r in at.tolist()]
        ranges = pa.array(own + [(own[i] - 1) % len(place) for i in ghosts], pa.int32())
        ghost = pa.array([0] * len(rows) + [1] * len(ghosts), pa.int32())
        yield pa.RecordBatch.from_arrays([ranges, ghost, ids.take(take), texts.take(take), packed.take(take)], names=["range", "ghost", "doc_id", "text", "packed"])


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def result(rows: list) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(7)]
        edited = []
        for (_, _, _, text, _), (_, _, _, after, _) in rows:
            half = len(text) // 2
            edited.append(text[: len(text) - half] + after[:half])
        marks = _packed(pa.array(edited, pa.large_string()))
        for ((_, _, id_, text, own), (_, _, _, _, other)), new, mark in zip(rows, edited, marks, strict=True):
            values = id_, len(text), hashlib.sha256(new.encode()).hexdigest(), own.hex(), mark.hex(), likeness(own, mark), likeness(own, other)
            for c, v in zip(cols, values, strict=True):
                c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in _RESULT.split(", ")])

    last, waiting, size = None, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if last is not None and not last[1]:
                waiting.append((last, row))
                size += len(last[3])
                if size > 4 << 20:
                    yield result(waiting)
                    waiting, size = [], 0
            last = row
    if waiting:
        yield result(waiting)


def with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprint of every document and of its text edited with the document next in descending order of ids."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bytes_ = F.coalesce(F.octet_length("text"), F.lit(0))
    size = docs.agg(F.sum(bytes_)).first()[0] or 0
    n = int(np.clip(size // min(range_bytes, max(1, size)), 1, MOST_RANGES))
    weighed = docs.select(F.explode(F.array_repeat("doc_id", 1 + F.floor(bytes_ / min(WEIGH_BYTES, range_bytes)).cast("int"))).alias("doc_id"))
    cuts = weighed.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0] if n > 1 else None
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))

    def ranges(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_range_of(batch.column(0), bounds).astype(np.int32)), batch.column(0)], names=["range", "doc_id"])

    # one row per range, MOST_RANGES + 2 at most
    first = {r["range"]: r["top"] for r in docs.select("doc_id").mapInArrow(ranges, "range int, doc_id long").groupBy("range").agg(F.max("doc_id").alias("top")).collect()}
    there = sorted(first)
    place = {r: i for i, r in enumerate(there)}
    dealt = docs.mapInArrow(lambda b: _deal(b, bounds, first, place), _DEALT)
    dealt = dealt.repartitionById(max(1, len(there)), "range").sortWithinPartitions("range", "ghost", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.mapInArrow(_neighbours, _RESULT)
