"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the 13-word windows of the benchmark items (an item of fewer words is one
pattern).  The alphabet is words, a block is two of them.  A block shift table says how far
an alignment can move on without missing a pattern; hashes of the patterns' last words
select the test strings of an alignment with shift 0; words are compared byte for byte.
All alignments of a batch are run side by side in numpy: a document's alignments are cut in
stretches of the largest shift, so that where no block is known one look decides a stretch.

Equal windows are one pattern with a list of its items, so an occurrence costs one comparison however
many items hold it.

Scale.  Documents are read once and never shuffled.  The benchmark is a query set: it is
taken through the driver in blocks of at most ``block_bytes`` of text, each broadcast and
searched for in all rows, so neither side grows with the other.

Cases: null or wordless texts have no words, no hits and are clean; null item ids are the empty
string; items without words have no pattern; an empty benchmark finds nothing; repeated rows are
judged each by itself; other columns are carried, those of a result's name replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, written
from .textkernel import NOT_WORD, Words, mix, text_chunks

WINDOW = 13
BLOCK_BYTES = 4 << 20
_K = np.uint64(0x9FB21C651E98DF25)
_SUFFIX = 8


def _tail(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words before each position of at."""
    acc = np.full(len(at), n, dtype=np.uint64)
    for j in range(n):
        acc = acc * _K + h[at - n + j]
    return mix(acc)


def _different(words: Words, length: int, starts: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Start of one of each different window, and the items that hold it.  Windows of one hash are compared byte for byte."""
    content = lambda i: (words.body[words.cut[i] : words.cut[i + length]].tobytes(), words.lens[i : i + length].tobytes())
    hashes = _tail(words.hash, starts + length, length)
    order = np.argsort(hashes, kind="stable")
    starts, item, hashes = starts[order], item[order], hashes[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    if any(content(starts[i]) != content(starts[first[i]]) for i in np.flatnonzero(~new).tolist()):  # two windows of one hash
        kind: dict[tuple, int] = {}
        of = np.array([kind.setdefault(content(i), len(kind)) for i in starts.tolist()])
        order = np.argsort(of, kind="stable")
        starts, item, of = starts[order], item[order], of[order]
        new = np.concatenate([[True], of[1:] != of[:-1]])
    cuts = np.flatnonzero(new)
    return starts[cuts], [np.unique(x) for x in np.split(item, cuts[1:])]


class Patterns:
    """Search tables for all different patterns of one length, in words; items: numbers of the items of each."""

    def __init__(self, words: Words, length: int, starts: np.ndarray, item: np.ndarray):
        self.length, self.width = length, min(2, length)
        starts, self.items = _different(words, length, starts, item)
        self.most = length - self.width + 1
        blocks_at = np.concatenate([starts + j for j in range(self.most)])
        shift = np.repeat(np.arange(self.most)[::-1], len(starts)).astype(np.uint8)
        self.bits = int(np.clip(np.ceil(np.log2(16 * len(blocks_at) + 1)), 10, 24))
        self.shift = np.full(1 << self.bits, self.most, dtype=np.uint8)
        np.minimum.at(self.shift, self.block(words.hash, blocks_at), shift)
        self.suffix = min(length, _SUFFIX)
        tails = _tail(words.hash, starts + length, self.suffix)
        order = np.argsort(tails, kind="stable")
        self.tails, self.starts, self.number = tails[order], starts[order], order
        self.words = words

    def block(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        acc = h[at]
        if self.width == 2:
            acc = mix(acc * _K + h[at + 1])
        return (acc >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, text: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern number) of every occurrence in a chunk of documents."""
        n = text.counts
        stretches = np.where(n >= self.length, -(-(n - self.length + 1) // self.most), 0)
        if not stretches.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.repeat(text.bounds[:-1] + self.length - self.width, stretches)
        number = np.arange(len(at)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        at = at + number * self.most
        end = np.minimum(at + self.most, np.repeat(text.bounds[1:] - self.width + 1, stretches))
        found, items = [], []
        while len(at):
            shift = self.shift[self.block(text.hash, at)].astype(np.int64)
            here = at[shift == 0] + self.width
            if len(here):
                tails = _tail(text.hash, here, self.suffix)
                low, high = np.searchsorted(self.tails, tails, "left"), np.searchsorted(self.tails, tails, "right")
                while (more := low < high).any():
                    here, low, high = here[more], low[more], high[more]
                    for stop, k in zip(here.tolist(), low.tolist(), strict=True):
                        if self.same(text, stop - self.length, int(self.starts[k])):
                            found.append(stop - self.length)
                            items.append(int(self.number[k]))
                    low = low + 1
            at = at + np.maximum(shift, 1)
            more = at < end
            at, end = at[more], end[more]
        return np.array(found, dtype=np.int64), np.array(items, dtype=np.int64)

    def same(self, text: Words, i: int, j: int) -> bool:
        own, n = self.words, self.length
        if not np.array_equal(text.lens[i : i + n], own.lens[j : j + n]):
            return False
        return text.body[text.cut[i] : text.cut[i + n]].tobytes() == own.body[own.cut[j] : own.cut[j + n]].tobytes()


def patterns(texts: list[str], window: int = WINDOW) -> list[Patterns]:
    """Tables for the items' windows, by length."""
    out: list[Patterns] = []
    data = [t.encode("utf-8", "replace") for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in data])]).astype(np.int64)
    words = Words(np.frombuffer(b"".join(data), dtype=np.uint8), offs, NOT_WORD)
    n = words.counts
    for length in sorted({min(int(x), window) for x in n if x}):
        docs = np.flatnonzero(n >= window) if length == window else np.flatnonzero(n == length)
        counts = n[docs] - length + 1
        starts = np.repeat(words.bounds[:-1][docs], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        out.append(Patterns(words, length, starts, np.repeat(docs, counts)))
    return out


_BUILT: dict = {}


def _search(batches: Iterator[pa.RecordBatch], block, window: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    token, ids, texts = block.value
    if _BUILT.get("of") != (token, window):  # once a worker, which runs many tasks
        _BUILT.clear()
        _BUILT.update({"of": (token, window), "tables": patterns(texts, window)})
    tables, names = _BUILT["tables"], np.array(ids, dtype=object)
    for batch in batches:
        columns: dict[str, list] = {"n_words": [], "n_hit": [], "items": [], "spans": []}
        old_items, old_spans = batch.column("items"), batch.column("spans")
        for a, b, data, offs in text_chunks(batch.column("text")):
            words = Words(data, offs, NOT_WORD)
            edge = np.zeros(len(words) + 1, dtype=np.int32)
            by_doc: dict[int, set] = {}
            for p in tables:
                first, number = p.find(words)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + p.length, -1)
                for d, x in set(zip((np.searchsorted(words.bounds, first, "right") - 1).tolist(), number.tolist(), strict=True)):
                    by_doc.setdefault(d, set()).update(names[p.items[x]])
            for d in range(b - a):
                for span in old_spans[a + d].as_py() or ():
                    edge[words.bounds[d] + span["start"]] += 1
                    edge[words.bounds[d] + span["start"] + span["length"]] -= 1
                if len(old := old_items[a + d]):
                    by_doc.setdefault(d, set()).update(old.as_py())
            hit = np.zeros(len(words) + 2, dtype=np.int8)
            hit[1:-1] = np.cumsum(edge[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(hit[1:-1], dtype=np.int64)])
            per_doc = total[words.bounds[1:]] - total[words.bounds[:-1]]
            columns["n_words"] += words.counts.tolist()
            columns["n_hit"] += per_doc.tolist()
            for d in range(b - a):
                columns["items"].append(sorted(by_doc.get(d, ())))
                spans = []
                if per_doc[d]:
                    lo, hi = words.bounds[d], words.bounds[d + 1]
                    own = np.concatenate([[0], hit[1 + lo : 1 + hi], [0]])
                    step = np.diff(own)
                    spans = [{"start": int(s), "length": int(e - s)} for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
                columns["spans"].append(spans)
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name) for f in schema], schema=schema)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    ids, texts, total = [], [], 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").where("text IS NOT NULL").toLocalIterator():
        if texts and total + len(row[1]) > block_bytes:
            yield ids, texts
            ids, texts, total = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        total += len(row[1])
    yield ids, texts


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, n_hit, items (ids whose windows occur, sorted as strings), spans
    (hit words as start and length) and contaminated.  docs needs text."""
    small_batches(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_hit", "items", "spans", "contaminated")
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]))
    extra = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", span)]
    schema = T.StructType(docs.schema.fields + extra)
    empty = {"n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>"), "spans": F.array().cast(span)}
    out = docs.withColumns(empty)
    arrow = to_arrow_schema(schema)
    for number, block in enumerate(_blocks(benchmark, block_bytes)):
        if number and number % 4 == 0:  # so that a task never runs more than four searches at once
            out = written(out, "decontaminate")
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, *block))
        out = out.mapInArrow(lambda batches, shared=shared: _search(batches, shared, window, arrow), schema)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of scan(): doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that no window of the benchmark occurs in, with their own columns.  How long a document is
    counts for nothing here: one passage in 20,000 words is as bad as in 200 (column contaminated does weigh it)."""
    kept = scan(docs.select(F.struct(*docs.columns).alias("_row"), "text"), benchmark).where("n_hit = 0")
    return kept.select("_row.*")
