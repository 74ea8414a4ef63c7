"""Line dedup by a deletion-neighbourhood join over words.

A line (text between newlines) is its sequence of lower-cased words.  Two lines are near when one
word inserted, deleted or replaced turns one into the other.  Of all copies of a line the earliest
stays (smallest doc_id, then line number), and it goes too where any near line is earlier.
Lines of fewer than MIN_WORDS words are near none: of them only exact copies go.  An earlier near line counts
whether or not it stays itself, so of a chain of lines each one edit off the one before only the first stays.

1. Equal lines are grouped (128-bit hash) under their first position.
2. One edit leaves the first or the last (n-1)/2 words as they are, so only lines that share such a
   half with another line can have a near one; the others emit nothing.
3. A remaining line emits hashed keys: itself, each variant with one word deleted, and each variant with
   the place of the deletion; where it shares one half only, just those with the deletion outside that half.  Equal (variant, place) keys are replacements of one word; a line equal to
   a variant is an insertion.  Within such a key all lines are near, so every key is aggregated to
   its earliest line: a key of k lines costs k rows and no pairs.
4. Every line and its earliest candidate are compared word for word.

Scale.  Shuffled are slim hashes of lines; texts leave their partition only for lines that may have a
near one, found by a bit filter of fixed size (2**28 bits at most) whose false positives the
next join removes.

The joins that give every line and variant its group's decision have on their smaller side the groups that hold a copy or
a near line, dealt anew, so that both sides are plain exchanges and a line or variant that very many rows share is
split over tasks (AQE's skew join does not see through an aggregate).  They are merge joins: neither side is known to be small.

Cases: null text is empty and stays as it is; rows of one doc_id with different texts are told apart by a hash
of the text, equal ones share their positions, so all or none of them keep a line; null ids come first; a text whose
every line goes becomes empty; an empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, small_batches, written
from .textkernel import SPACE, Words, mix, text_chunks

MIN_WORDS = 5
_A, _B = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def line_offsets(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all lines of a chunk and the number of lines of each document."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offs[:-1], breaks + 1]), kind="stable")
    counts = np.diff(np.searchsorted(breaks, offs)) + 1
    return np.concatenate([starts, offs[-1:]]), counts


def _sum_before(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=out[1:])
    return out


class Lines:
    """Lines of a chunk with at least min_words words: numbers in the chunk, hashes, half keys."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, min_words: int):
        bounds, self.per_doc = line_offsets(data, offs)
        w = self.words = Words(data, bounds, SPACE)
        self.at = np.flatnonzero(w.counts >= min_words)
        place = (np.arange(len(w)) - np.repeat(w.bounds[:-1], w.counts)).astype(np.uint64)
        left = np.repeat(w.counts, w.counts).astype(np.uint64) - place
        self.front = _sum_before(mix(w.hash + place * _A))
        self.back = _sum_before(mix(w.hash + left * _B))
        s, e = w.bounds[:-1][self.at], w.bounds[1:][self.at]
        n = w.counts[self.at]
        self.n = n
        self.h1 = mix((self.front[e] - self.front[s]) + n.astype(np.uint64))
        self.h2 = mix((self.back[e] - self.back[s]) ^ _A)
        keys = []
        for more in (0, 1):
            c = (n - 1 + more) // 2
            salt = c.astype(np.uint64)
            keys += [mix((self.front[s + c] - self.front[s]) + salt * _B), mix((self.back[e] - self.back[e - c]) + salt * _A + np.uint64(1))]
        self.keys = keys


_LINE = "doc_id long, line int, mark long, h1 long, h2 long, n int, a long, b long, c long, d long"


def _lines(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks = batch.column(0), batch.column(1)
        for a, b, data, offs in text_chunks(batch.column(2)):
            x = Lines(data, offs, min_words)
            doc = np.repeat(np.arange(a, b), x.per_doc)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(x.per_doc) - x.per_doc, x.per_doc)
            own = pa.array(doc[x.at])
            columns = [ids.take(own), pa.array(number[x.at].astype(np.int32)), marks.take(own), *(pa.array(y.view(np.int64)) for y in (x.h1, x.h2)), pa.array(x.n.astype(np.int32)), *(pa.array(y.view(np.int64)) for y in x.keys)]
            yield pa.RecordBatch.from_arrays(columns, names=[y.split()[0] for y in _LINE.split(", ")])


def _bits(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << bits, dtype=bool)
    for batch in batches:
        table[(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)] = True
    packed = np.packbits(table)
    cuts = np.split(packed, max(1, len(packed) >> 13))
    found = [(i, x.tobytes()) for i, x in enumerate(cuts) if x.any()]
    if found:
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["slice", "bits"])


def _or(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(c, dtype=np.uint8)
            total[s] = total[s] | x if s in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["slice", "bits"])


def bit_filter(hashes: DataFrame, rows: int) -> np.ndarray:
    """A bit for the leading bits of every hash (long column), 16 bits a row, 2**28 at most."""
    bits = int(np.clip(np.ceil(np.log2(16 * max(rows, 1))), 16, 28))
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    parts = hashes.mapInArrow(lambda b: _bits(b, bits), "slice int, bits binary").repartition("slice").mapInArrow(_or, "slice int, bits binary")
    for s, x in parts.collect():
        x = np.frombuffer(bytes(x), dtype=np.uint8)
        out[s * len(x) : (s + 1) * len(x)] = x
    return out


def _texts(batches: Iterator[pa.RecordBatch], min_words: int, shared) -> Iterator[pa.RecordBatch]:
    """h1, h2 and words of the lines whose bit is set; a task tells a line once while it remembers it."""
    table, told = shared.value, set()
    shift = np.uint64(64 - int(np.log2(len(table) * 8)))
    for batch in batches:
        h1, h2, out = [], [], []
        for _, _, data, offs in text_chunks(batch.column(0)):
            x = Lines(data, offs, min_words)
            bit = (x.h1 >> shift).astype(np.int64)
            for i in np.flatnonzero(table[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).tolist():
                if (key := (int(x.h1[i]), int(x.h2[i]))) not in told:
                    if len(told) >= 1 << 18:
                        told.clear()
                    told.add(key)
                    k = x.at[i]
                    h1.append(key[0])
                    h2.append(key[1])
                    out.append(x.words.text(x.words.bounds[k], x.words.bounds[k + 1]))
        yield pa.RecordBatch.from_arrays([*(pa.array(np.array(y, dtype=np.uint64).view(np.int64)) for y in (h1, h2)), pa.array(out, pa.binary())], names=["h1", "h2", "words"])


_VARIANT = "h1 long, h2 long, doc_id long, line int, mark long, tag int, key long"
SELF, DELETED, PLACED = 0, 1, 2


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each line itself, of its one-word deletions, and of those with their place."""
    for batch in batches:
        for a, b, data, offs in text_chunks(batch.column(0).cast(pa.string())):
            w = Words(data, offs, SPACE)
            n, first = w.counts, np.repeat(w.bounds[:-1], w.counts)
            place = (np.arange(len(w)) - first).astype(np.uint64)
            own = _sum_before(mix(w.hash + place * _A))
            moved = _sum_before(mix(w.hash + (place - np.uint64(1)) * _A))
            i = np.arange(len(w))
            last = np.repeat(w.bounds[1:], n)
            count = np.repeat(n, n).astype(np.uint64)
            without = (own[i] - own[first]) + (moved[last] - moved[i + 1])
            whole = mix((own[w.bounds[1:]] - own[w.bounds[:-1]]) + n.astype(np.uint64))
            deleted = mix(without + count - np.uint64(1))
            placed = mix(without * _B + place * _A + count)
            half, at = np.repeat((n - 1) // 2, n), i - first
            front, back = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False)[a:b], n) for c in (6, 7))
            where = np.flatnonzero((front & (at >= half)) | (back & (at < np.repeat(n, n) - half)))
            row = np.concatenate([np.arange(a, b), w.doc_of()[where] + a, w.doc_of()[where] + a])
            tag = np.concatenate([np.full(b - a, SELF), np.full(len(where), DELETED), np.full(len(where), PLACED)]).astype(np.int32)
            key = np.concatenate([whole, deleted[where], placed[where]]).view(np.int64)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in range(1, 6)), pa.array(tag), pa.array(key)], names=[x.split()[0] for x in _VARIANT.split(", ")])


def near(a: list, b: list) -> bool:
    """Whether one insertion, deletion or replacement at most turns sequence a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [near(x.split(b" "), y.split(b" ")) for x, y in zip(batch.column("words").to_pylist(), batch.column("other_words").to_pylist(), strict=True)]
        yield batch.select(["h1", "h2", "of_doc", "of_line"]).filter(pa.array(keep, pa.bool_()))


def decide(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, line, n_words, kept, of_doc, of_line of every line that is judged (all with a word: min_words 1); see _decide()."""
    return _decide(docs, min_words)[0].drop("mark")


def _marked(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), *columns)


def _decide(docs: DataFrame, min_words: int) -> tuple[DataFrame, list[DataFrame]]:
    """Decisions, and the written tables that they are read from: doc_id, mark (hash of the text), line, n_words, kept, of_doc, of_line (the
    earlier line that a dropped one repeats) of every line of docs (doc_id, text) with at least min_words words; those of fewer than MIN_WORDS repeat equal ones only."""
    near_words = max(min_words, MIN_WORDS)
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = written(_marked(docs, "text").mapInArrow(lambda b: _lines(b, min_words), _LINE), "lines")
    at_columns = "doc_id", "line", "mark"
    at = F.struct(*at_columns)
    kinds = rows.groupBy("h1", "h2").agg(F.min(at).alias("f"), F.count("*").alias("m"), *[F.first(c).alias(c) for c in "nabcd"])
    kinds = written(kinds, "line-kinds")
    half = lambda c, front: F.struct(F.col(c).alias("key"), F.lit(front).alias("front"))
    halves = kinds.where(F.col("n") >= near_words).select("h1", "h2", F.explode(F.array_distinct(F.array(half("a", True), half("b", False), half("c", True), half("d", False)))).alias("k"))
    halves = halves.select("h1", "h2", "k.key", "k.front")
    shared_half = halves.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    sides = halves.join(shared_half, "key").groupBy("h1", "h2").agg(F.max("front").alias("front"), F.max(~F.col("front")).alias("back"))
    maybe = written(sides.join(kinds.select("h1", "h2", "f"), ["h1", "h2"]), "lines-maybe")
    found = spark.createDataFrame([], "h1 long, h2 long, of struct<of_doc:long,of_line:int>")
    tables, n_parts = [rows, kinds], int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n := maybe.count():
        bits = spark.sparkContext.broadcast(bit_filter(maybe.select("h1"), n))
        texts = docs.select("text").mapInArrow(lambda b: _texts(b, near_words, bits), "h1 long, h2 long, words binary")
        texts = texts.join(maybe, ["h1", "h2"]).groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("words", "f", "front", "back")])
        texts = written(texts.select("words", "h1", "h2", "f.doc_id", "f.line", "f.mark", "front", "back"), "line-texts")
        variants = written(texts.mapInArrow(_variants, _VARIANT), "line-variants")
        kind = (F.col("tag") == PLACED).alias("kind")
        me = F.struct(*at_columns, "h1", "h2")
        least = variants.groupBy(kind, "key").agg(F.count("*").alias("m"), *[F.min(F.when(F.col("tag") == t, me)).alias(f"m{t}") for t in (SELF, DELETED, PLACED)])
        least = least.where("m > 1 AND (kind OR (m0 IS NOT NULL AND m1 IS NOT NULL))").drop("m").repartition(n_parts)
        other = F.when(F.col("tag") == SELF, F.col("m1")).when(F.col("tag") == DELETED, F.col("m0")).otherwise(F.col("m2"))
        pairs = variants.withColumn("kind", F.col("tag") == PLACED).join(least.hint("merge"), ["kind", "key"]).withColumn("o", other)
        pairs = pairs.where(F.struct("o.doc_id", "o.line", "o.mark") < at).select("h1", "h2", "o").distinct()
        mine, theirs = texts.select("h1", "h2", "words"), texts.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.col("words").alias("other_words"))
        pairs = pairs.select("h1", "h2", F.col("o.doc_id").alias("of_doc"), F.col("o.line").alias("of_line"), F.col("o.h1").alias("_1"), F.col("o.h2").alias("_2"))
        pairs = pairs.join(mine, ["h1", "h2"]).join(theirs, ["_1", "_2"]).select("h1", "h2", "of_doc", "of_line", "words", "other_words")
        checked = pairs.mapInArrow(_checked, "h1 long, h2 long, of_doc long, of_line int")
        found = written(checked.groupBy("h1", "h2").agg(F.min(F.struct("of_doc", "of_line")).alias("of")), "lines-near")
        tables.append(found)
        removed(texts, variants)
    # groups that decide something: with copies, or near an earlier line
    moved = kinds.select("h1", "h2", "f", "m").join(found, ["h1", "h2"], "left").where("m > 1 OR of IS NOT NULL").drop("m").repartition(n_parts)
    removed(maybe)
    out = rows.select(*at_columns, "n", "h1", "h2").join(moved.hint("merge"), ["h1", "h2"], "left")
    first = F.col("f").isNull() | at.eqNullSafe(F.col("f"))
    of = F.when(~first, F.struct(F.col("f.doc_id").alias("of_doc"), F.col("f.line").alias("of_line"))).otherwise(F.col("of"))
    out = out.select("doc_id", "mark", "line", F.col("n").alias("n_words"), (first & F.col("of").isNull()).alias("kept"), of.alias("of"))
    return out.select("doc_id", "mark", "line", "n_words", "kept", "of.of_doc", "of.of_line"), tables


def _without(batches: Iterator[pa.RecordBatch], text: int, chars: int | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The batches' rows without the lines that their last column lists, and without rows that lose all their words so."""
    for batch in batches:
        gone = batch.column(batch.num_columns - 1)
        columns = list(batch.columns[:-1])
        at = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
        keep = np.ones(len(batch), dtype=bool)
        if len(at):
            lines, texts = gone.take(pa.array(at)).to_pylist(), columns[text].take(pa.array(at)).to_pylist()
            left = ["\n".join(x for n, x in enumerate(t.split("\n")) if n not in out) for t, out in zip(texts, map(set, lines), strict=True)]
            keep[at] = [bool(x.strip(" \t\n\v\f\r")) for x in left]
            mask = np.zeros(len(batch), dtype=bool)
            mask[at] = True
            columns[text] = pc.replace_with_mask(columns[text], pa.array(mask), pa.array(left, columns[text].type))
            if chars is not None:
                columns[chars] = pc.replace_with_mask(columns[chars], pa.array(mask), pa.array([len(x) for x in left], columns[chars].type))
        yield pa.RecordBatch.from_arrays(columns, schema=schema).filter(pa.array(keep))


def dedup(docs: DataFrame, min_words: int = 1) -> DataFrame:
    """docs without the lines that decide() drops (n_chars set anew), and without documents that lose all their words so."""
    from pyspark.sql.pandas.types import to_arrow_schema

    decisions, tables = _decide(docs, min_words)
    gone = decisions.where("NOT kept").groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set("line").alias("_gone"))
    gone = written(gone, "lines-gone")
    removed(*tables)
    same = docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_mark"])
    joined = docs.join(gone, same, "left").select(*[docs[c] for c in docs.columns], "_gone")
    text, chars = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    schema = to_arrow_schema(docs.schema)
    return joined.mapInArrow(lambda b: _without(b, text, chars, schema), docs.schema)
