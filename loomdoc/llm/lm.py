"""Language-model scoring: a causal self-attention model on subword ids, beside an add-one word model.

The text is its lower-cased words; each word (with the space before it) is coded by a public byte-level
BPE vocabulary, and one end follows.  One pass over the texts codes them and writes the ids of every document to the shared folder;
training and scoring read ids only, in which the words can be told apart.  In the same pass, from all training documents
(crc32 of the id mod 7 not 2), are counted: words, and pairs of successive subwords.  The pairs give the model's frozen part (bigram rows and shares of
rare subwords).  The attention part (see attention.py) is trained in numpy on all training documents: these are dealt
by a hash of id and text to parts of about PART_TOKENS subwords, each in the order of another hash, so that the
model does not depend on how files or partitions are laid out.  The first part's, run EPOCHS times, are the start; from
there every part is trained once, side by side, and the parts' parameters are averaged by their steps.  Scoring cuts each whole text in overlapping windows; each
token is scored once, with at least OVERLAP tokens before it where there are so many.

Scale.  Ids (two bytes a subword) are shuffled once, to the parts; a part is read batch by batch.  Past MOST_PARTS parts they grow instead.  No text
reaches the driver.  Counts are summed in each task, packed by buckets of keys, shuffled and summed bucket by bucket.  The
commonest words, FREQUENT at most, are broadcast; the few other words of the texts are joined by hash.
Pair counts are mapped to CLASSES x CLASSES before they are collected.

Cases: null and wordless texts are the end alone; without training documents the word model
has N = V = 0 and the subword model is even; rows with null ids count as crc32 of the empty
string; repeated rows are scored each by itself; an empty table gives an empty result; only doc_id and
text are read.  Words are counted by 64-bit hashes of their subwords' ids.
Bytes that are no UTF-8 are coded as bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attention import Model, windows
from .common import small_batches, written
from .textkernel import SPACE, Words, binary_chunks, mix, run_hashes, text_chunks

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EPOCHS, CLASSES, GROUPS, BANDS, FREQUENT = 3, 1024, 32, 16, 500_000
PART_TOKENS, MOST_PARTS = 4_000_000, 10_000
_START_BATCH, _BATCH = 128, 256
END_WORD = 0  # stands for the end among word hashes
WORD, PAIR, DOCUMENT = 0, 1, 2
SLOTS, KEPT = 1 << 18, 8
BUCKET_BITS = 10  # counts are packed and summed by buckets of keys


def ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def is_held_out(column: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 7 == 2


_CODERS: dict[str, Coder] = {}


def coder_of(name: str, shared) -> Coder:
    """The coder of the vocabulary name, whose ranks are broadcast; one a worker, which runs many tasks."""
    if name not in _CODERS:
        _CODERS.clear()
        _CODERS[name] = Coder(shared.value)
    return _CODERS[name]


def leads_of(table: dict[bytes, int]) -> np.ndarray:
    """Which ids are subwords with the space before a word: the first of each word, and no other.  The last place is the end's."""
    leads = np.zeros(max(table.values()) + 2, bool)
    leads[[i for subword, i in table.items() if subword.startswith(b" ")]] = True
    return leads


class Coder:
    """Subword ids of words.  Words of up to KEPT subwords are kept by their hash until another takes their slot."""

    def __init__(self, table: dict[bytes, int]):
        import tiktoken

        self.own = tiktoken.Encoding("own", pat_str=r" ?[^ ]+", mergeable_ranks=table, special_tokens={})
        self.end = max(table.values()) + 1
        self.leads = leads_of(table)
        self.keys, self.sizes, self.kept = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int8), np.zeros((SLOTS, KEPT), np.int32)

    def words(self, w: Words, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the different words at the places where, and bounds; those not kept are coded in one call."""
        keys = np.take(w.hash, where)
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        n = np.where(np.take(self.keys, slot) == keys, np.take(self.sizes, slot), 0).astype(np.int64)
        is_new = n == 0
        known, new = np.flatnonzero(~is_new), np.flatnonzero(is_new)
        ids, cut = self.encoded(w, where[new])
        n[new] = np.diff(cut)
        start = np.concatenate([[0], np.cumsum(n)])
        out, is_new = np.empty(int(start[-1]), np.int32), np.repeat(is_new, n)
        out[is_new] = ids
        out[~is_new] = np.take(self.kept, slot[known], axis=0)[np.arange(KEPT) < n[known][:, None]]
        short = new[n[new] <= KEPT]
        self.keys[slot[short]] = keys[short]
        short = short[self.keys[slot[short]] == keys[short]]  # of words for one slot the one that has it
        self.sizes[slot[short]] = n[short]
        at = np.minimum(start[short][:, None] + np.arange(KEPT), max(len(out) - 1, 0))
        self.kept[slot[short]] = out[at] if len(short) else 0
        return out, start

    def encoded(self, w: Words, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of the words at the places where, coded in one call, and bounds."""
        lens = w.cut[where + 1] - w.cut[where]
        upto = np.concatenate([[0], np.cumsum(lens)])
        line = np.full(int(upto[-1]) + len(where), 0x20, np.uint8)
        at = np.arange(upto[-1])
        line[at + np.repeat(np.arange(len(where)), lens) + 1] = w.body[at + np.repeat(w.cut[where] - upto[:-1], lens)]
        line = line.tobytes()
        try:
            ids = self.own.encode_ordinary(line.decode())
        except UnicodeDecodeError:  # bytes that are no text are coded as they are, word by word, so that words stay apart
            ids = [i for word in line.split(b" ")[1:] for i in self.own._encode_single_piece(b" " + word)]
        ids = np.array(ids, np.int32)
        return ids, np.append(np.flatnonzero(self.leads[ids]), len(ids))

    def tokens(self, w: Words, unique: np.ndarray, where: np.ndarray, inverse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids of all documents of a chunk, an end after each, and bounds.
        unique, where, inverse: _unique() of the word hashes."""
        return self.laid(w, inverse, *self.words(w, where))

    def laid(self, w: Words, inverse: np.ndarray, flat: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """tokens() from the subwords of the unique words."""
        first = np.take(start, inverse)
        n = np.take(start, inverse + 1) - first
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = np.take(flat, np.repeat(first - upto[:-1], n) + np.arange(upto[-1]))
        bounds = upto[w.bounds] + np.arange(len(w.bounds))
        out = np.full(int(bounds[-1]), self.end, np.int32)
        inside = np.ones(len(out), bool)
        inside[bounds[1:] - 1] = False
        out[inside] = ids
        return out, bounds


def _before(ids: np.ndarray, end: int) -> np.ndarray:
    """The token before each one; end before the first."""
    return np.concatenate([np.array([end], ids.dtype), ids[:-1]])


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where a new key stands in sorted ones."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, sorted, a place of each, and the number of every key among them; np.unique would take a slower, stable sort."""
    order = np.argsort(keys)
    keys = np.take(keys, order)
    first, inverse, new = _starts(keys), np.empty(len(keys), np.int64), np.zeros(len(keys), np.int64)
    new[first[1:]] = 1
    inverse[order] = np.cumsum(new)
    return keys[first], order[first], inverse


def _uniques(w: Words):
    return _unique(w.hash)


class _Sums:
    """Counts by key, merged when many."""

    def __init__(self):
        self.keys, self.counts, self.size = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0

    def add(self, keys, counts):
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def merged(self):
        keys = np.concatenate(self.keys)
        order = np.argsort(keys)
        keys = np.take(keys, order)
        first = _starts(keys)
        counts = np.add.reduceat(np.take(np.concatenate(self.counts), order), first) if len(first) else np.empty(0, np.int64)
        keys = keys[first]
        self.keys, self.counts, self.size = [keys], [counts], 0
        return keys, counts


_COUNT = "kind int, key long, n long"
_TEXT = "doc_id long, held_out boolean, lot long, place long, size int"
_CODED = f"{_TEXT}, kind int, bucket int, ids binary, times binary"


def _rows(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*columns], names=[x.split()[0] for x in names.split(", ")])


def _cells(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of the values between the bounds cut."""
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int64) * values.itemsize), pa.py_buffer(values)])
    return found.cast(pa.binary())


def _code(batches: Iterator[pa.RecordBatch], shared, name: str = VOCABULARY) -> Iterator[pa.RecordBatch]:
    """From the columns of _TEXT and the text: rows of kind DOCUMENT, a row's own with its ids, and of kinds WORD and PAIR,
    the counts of those that are not held out: in ids the keys of a bucket, in times how often each was met."""
    coder, sums = coder_of(name, shared), (_Sums(), _Sums())
    number = np.uint16 if coder.end < 1 << 16 else np.int32
    kinds = dict(zip([x.split()[0] for x in _TEXT.split(", ")], (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()), strict=True))

    def counted():
        for kind, s in enumerate(sums):
            keys, counts = s.merged()
            bucket = (mix(keys) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
            order = np.argsort(bucket, kind="stable")
            first = _starts(np.take(bucket, order))
            cut = np.append(first, len(keys))
            cells = (_cells(np.take(x, order), cut) for x in (keys, counts))
            yield _rows(_CODED, *(pa.nulls(len(first), x) for x in kinds.values()), pa.array(np.full(len(first), kind, np.int32)), pa.array(bucket[order[first]].astype(np.int32)), *cells)
            s.__init__()

    for batch in batches:
        learn = ~np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
        for a, b, data, offs in text_chunks(batch.column("text")):
            w = Words(data, offs, SPACE)
            _, where, inverse = _uniques(w)
            flat, start = coder.words(w, where)
            ids, bounds = coder.laid(w, inverse, flat, start)
            own = [batch.column(x)[a:b].cast(kind) for x, kind in kinds.items()]
            yield _rows(_CODED, *own, pa.array(np.full(b - a, DOCUMENT, np.int32)), pa.nulls(b - a, pa.int32()), _cells(ids.astype(number), bounds), pa.nulls(b - a, pa.binary()))
            some = learn[a:b]
            if not some.any():
                continue
            before = _before(ids, coder.end)
            if not some.all():
                inverse, real = inverse[np.repeat(some, w.counts)], np.repeat(some, np.diff(bounds))
                ids, before = ids[real], before[real]
            times = np.bincount(inverse, minlength=len(where))
            if len(used := np.flatnonzero(times)):
                sums[WORD].add(run_hashes(flat, start)[used], times[used])
            sums[WORD].add(np.array([END_WORD], np.uint64), np.array([some.sum()]))
            pair = np.sort((before.astype(np.uint64) << np.uint64(20)) | ids.astype(np.uint64))
            first = _starts(pair)
            sums[PAIR].add(pair[first], np.diff(first, append=len(pair)))
            for s in sums:
                if s.size > 1 << 21:
                    s.merged()
        if sum(len(s.keys[0]) for s in sums) > 1 << 22:
            yield from counted()
    yield from counted()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by key from the buckets (kind, bucket, ids, times), which come one after another."""
    now, sums = None, _Sums()

    def rows():
        keys, counts = sums.merged()
        sums.__init__()
        if len(keys):
            yield _rows(_COUNT, pa.array(np.full(len(keys), now[0], np.int32)), pa.array(keys.view(np.int64)), pa.array(counts))

    for batch in batches:
        for kind, bucket, keys, times in zip(*batch.columns, strict=True):
            if (new := (kind.as_py(), bucket.as_py())) != now:
                yield from rows()
                now = new
            sums.add(np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(times.as_buffer(), np.int64))
            if sums.size > 1 << 21:
                sums.merged()
    yield from rows()


def _count(batches: Iterator[pa.RecordBatch], shared, name: str = VOCABULARY) -> Iterator[pa.RecordBatch]:
    """The counts alone, of the texts in the first column, all of them training texts."""
    nothing = lambda n: [pa.nulls(n, pa.int64()), pa.array(np.zeros(n, bool)), *(pa.nulls(n, x) for x in (pa.int64(), pa.int64(), pa.int32()))]
    found = _code((_rows(f"{_TEXT}, text string", *nothing(len(b)), b.column(0)) for b in batches), shared, name)
    yield from _merge(x.select(["kind", "bucket", "ids", "times"]) for x in found if len(x) and x.column("kind")[0].as_py() != DOCUMENT)


def coded(docs: DataFrame, shared, name: str = VOCABULARY) -> DataFrame:
    """The rows of _code() for docs (doc_id, text).  lot and place deal and order training documents."""
    docs = docs.select("doc_id", is_held_out().alias("held_out"), F.xxhash64("doc_id", "text").alias("lot"), F.xxhash64("text", "doc_id").alias("place"), F.octet_length("text").alias("size"), "text")
    return docs.mapInArrow(lambda b: _code(b, shared, name), _CODED)


class Scorer:
    """All that scoring a chunk needs: model, classes of subwords, which of them begin a word."""

    def __init__(self, model: Model, code: np.ndarray, place: np.ndarray, share: np.ndarray, leads: np.ndarray):
        self.model, self.code, self.share, self.leads = model, code, share, leads
        self.target, self.end = place[code], len(code) - 1

    def chunks(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, bounds) of row ranges of a column of ids."""
        number = np.dtype(np.uint16 if self.end < 1 << 16 else np.int32)
        for a, b, data, offs in binary_chunks(column):
            yield a, b, np.frombuffer(data, number), offs // number.itemsize

    def words(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the words of a chunk, and how many each document has."""
        inside = ids != self.end
        leads = np.take(self.leads, ids)
        cut = np.flatnonzero(leads[inside])
        n = np.add.reduceat(leads, bounds[:-1], dtype=np.int64)
        return (run_hashes(ids[inside], np.append(cut, inside.sum())) if len(cut) else np.empty(0, np.uint64)), n

    def stream(self, ids: np.ndarray, bounds: np.ndarray):
        """windows() of a chunk."""
        x = np.take(self.code, _before(ids, self.end))
        x[bounds[:-1]] = CLASSES  # the unit before a document
        return windows(x, np.take(self.target, ids), bounds)

    def logprobs(self, ids: np.ndarray, bounds: np.ndarray, tables: tuple) -> np.ndarray:
        """log10 probability of each document; tables: of the model."""
        x, valid, target, places = self.stream(ids, bounds)
        out, done = np.take(self.share, ids), 0
        for i in range(0, len(x), 512):
            real = places[i : i + 512] >= 0
            told = self.model.logprob(x[i : i + 512], valid[i : i + 512], target[i : i + 512], tables)[real]
            out[done : done + len(told)] += told  # windows and their places are in the order of the tokens
            done += len(told)
        return np.add.reduceat(out, bounds[:-1]) / np.log(10)


def _coded(pairs: DataFrame, size: int) -> tuple[Model, np.ndarray, np.ndarray, np.ndarray]:
    """Untrained model from pair counts (key, n), class of every subword, place of every class, log share in its class."""
    spark = pairs.sparkSession
    single = pairs.groupBy(F.col("key").bitwiseAND((1 << 20) - 1).alias("id")).agg(F.sum("n").alias("n")).toPandas()  # a row per subword at most
    n = np.zeros(size, np.float64)
    n[single["id"].to_numpy().astype(np.int64)] = single["n"].to_numpy()
    order = np.lexsort((np.arange(size), -n))
    code = CLASSES - BANDS + np.arange(size) % BANDS
    code[order[: CLASSES - BANDS]] = np.arange(CLASSES - BANDS)
    mass = np.bincount(code, weights=n + 1, minlength=CLASSES)
    share = np.log((n + 1) / mass[code])
    share[order[: CLASSES - BANDS]] = 0.0
    mapped = spark.createDataFrame([(i, int(c)) for i, c in enumerate(code)], "id long, c int")  # the vocabulary
    left, right = mapped.select(F.col("id").alias("i"), F.col("c").alias("x")), mapped.select(F.col("id").alias("j"), F.col("c").alias("y"))
    both = pairs.withColumn("i", F.shiftright("key", 20)).withColumn("j", F.col("key").bitwiseAND((1 << 20) - 1))
    found = both.join(F.broadcast(left), "i").join(F.broadcast(right), "j").groupBy("x", "y").agg(F.sum("n").alias("n")).toPandas()  # CLASSES**2 rows at most
    big = np.zeros((CLASSES + 1, CLASSES), np.float64)
    big[found["x"].to_numpy().astype(np.int64), found["y"].to_numpy().astype(np.int64)] = found["n"].to_numpy()
    big[CLASSES] = big[code[size - 1]]  # before a document as after its end
    even = (big[:CLASSES].sum(0) + 1) / (big[:CLASSES].sum() + CLASSES)
    # classes in the order of the first direction in which their left neighbours differ, then cut in groups
    rows = np.sqrt(big[:CLASSES] / (big[:CLASSES].sum(0, keepdims=True) + 1)).astype(np.float32)
    rows -= rows.mean(1, keepdims=True)
    perm = np.argsort(np.linalg.svd(rows, full_matrices=False)[2][0], kind="stable")
    place = np.empty(CLASSES, np.int64)
    place[perm] = np.arange(CLASSES)
    big, even = big[:, perm], even[perm]
    kinds = (big > 0).sum(1, keepdims=True) + 1
    p = (big + kinds * even) / (big.sum(1, keepdims=True) + kinds)
    group = p.reshape(CLASSES + 1, GROUPS, -1).sum(2)
    return Model(np.log(group), np.log(p / np.repeat(group, CLASSES // GROUPS, 1))), code, place, share


def _batches(scorer: Scorer, columns: Iterator[pa.Array], seed: int, size: int):
    """Shuffled training batches of size windows, chunk by chunk of the ids."""
    random = np.random.default_rng(seed)
    for column in columns:
        for _, _, ids, bounds in scorer.chunks(column):
            x, valid, target, places = scorer.stream(ids, bounds)
            order = random.permutation(len(x))
            for i in range(0, len(order), size):
                j = order[i : i + size]
                yield np.take(x, j, axis=0), np.take(valid, j, axis=0), np.take(target, j, axis=0), np.take(places, j, axis=0) >= 0


def _flat(model: Model) -> np.ndarray:
    return np.concatenate([model.p[k].ravel() for k in sorted(model.p)]).astype(np.float64)


def _unflat(model: Model, flat: np.ndarray) -> None:
    at = 0
    for k in sorted(model.p):
        n = model.p[k].size
        model.p[k] = flat[at : at + n].reshape(model.p[k].shape).astype(np.float32)
        at += n


_FITTED = "part int, sums binary, steps long"


def _fitted(part: int, total: np.ndarray, steps: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary()), pa.array([steps], pa.int64())], names=["part", "sums", "steps"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, steps, part = None, 0, None
    for batch in batches:
        for p, data, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x = np.frombuffer(data, np.float64)
            total, steps, part = (x.copy() if total is None else total + x), steps + n, p if part is None else part
    if steps:
        yield _fitted(part, total, steps)


def train(docs: DataFrame, pairs: DataFrame, table: dict[bytes, int], shared, name: str = VOCABULARY) -> Scorer:
    """docs: the training documents, coded() or (doc_id, text); pairs: their pair counts (key, n)."""
    spark = docs.sparkSession
    if "ids" not in docs.columns:
        docs = coded(docs, shared, name).where(F.col("kind") == DOCUMENT)
    leads = leads_of(table)
    scorer = Scorer(*_coded(pairs, len(leads)), leads)
    model, tokens = scorer.model, pairs.agg(F.sum("n")).first()[0] or 0
    parts = int(np.clip(-(-tokens // PART_TOKENS), 1, MOST_PARTS))
    dealt = docs.select(F.pmod("lot", F.lit(parts)).cast("int").alias("part"), "place", "size", "ids")

    def fit(batches, begun, epochs: int, size: int, rate: float):
        own = begun.value
        copy = Model(own.model.first, own.model.then)
        _unflat(copy, _flat(own.model))
        ids = (b.column(0) for b in batches)
        if epochs > 1:
            held = list(ids)  # of one part
            ids = (c for _ in range(epochs) for c in held)
        if steps := len(copy.fit(_batches(own, ids, 2, size), rate=rate)):
            yield _fitted(TaskContext.get().partitionId(), steps * _flat(copy), steps)

    def take(rows) -> None:
        if steps := sum(r["steps"] for r in rows):
            _unflat(model, sum(np.frombuffer(bytes(r["sums"]), np.float64) for r in rows) / steps)

    in_order = ("place", "size")
    begun = spark.sparkContext.broadcast(scorer)
    first = dealt.where("part = 0").repartition(1).sortWithinPartitions(*in_order).select("ids")
    take(first.mapInArrow(lambda b: fit(b, begun, EPOCHS, _START_BATCH, 0.005), _FITTED).collect())  # one row
    ready = spark.sparkContext.broadcast(scorer)
    each = dealt.repartitionById(parts, "part").sortWithinPartitions(*in_order).select("ids").mapInArrow(lambda b: fit(b, ready, 1, _BATCH, 0.001), _FITTED)
    sums = each.repartitionById(16, F.pmod("part", F.lit(16))).sortWithinPartitions("part").mapInArrow(_sum, _FITTED)
    take(sorted(sums.collect(), key=lambda r: r["part"]))  # 16 rows at most
    return scorer


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, rare array<long>, row long"


def _score(batches: Iterator[pa.RecordBatch], model, common) -> Iterator[pa.RecordBatch]:
    scorer = model.value
    hashes, logs = common.value
    tables = scorer.model.tables()
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        sizes = []
        for a, b, ids, bounds in scorer.chunks(batch.column(2)):
            keys, n = scorer.words(ids, bounds)
            unique, _, inverse = _unique(keys)
            at = np.minimum(np.searchsorted(hashes, unique), max(len(hashes) - 1, 0))
            known = hashes[at] == unique if len(hashes) else np.zeros(len(unique), bool)
            value = np.where(known, logs[at], 0.0) if len(hashes) else np.zeros(len(unique))
            is_known = np.take(known, inverse)
            first = np.concatenate([[0], np.cumsum(n)])[:-1]
            sums, found = np.zeros(b - a), np.zeros(b - a, np.int64)
            if (full := n > 0).any():
                sums[full] = np.add.reduceat(np.take(value, inverse), first[full])
                found[full] = np.add.reduceat(is_known, first[full], dtype=np.int64)
            rare = keys[~is_known]
            sizes.append(n - found)
            for c, x in zip(out, (n + 1, found, sums, scorer.logprobs(ids, bounds, tables), rare.view(np.int64)), strict=True):
                c.append(x)
        if not out[0]:
            continue
        n, found, sums, score, rare = (np.concatenate(c) for c in out)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), pa.int32()), pa.array(rare))
        rows = pa.array(number + np.arange(len(n)))
        number += len(n)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), pa.array(found), pa.array(sums), pa.array(score), lists, rows], names=[x.split()[0] for x in _SCORED.split(", ")])


def score(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = ranks(vocabulary)
    shared = spark.sparkContext.broadcast(table)
    every = written(coded(docs, shared, vocabulary), "lm-coded")
    docs = every.where(F.col("kind") == DOCUMENT)
    counts = every.where(F.col("kind") != DOCUMENT).select("kind", "bucket", "ids", "times").repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    counts = written(counts.mapInArrow(_merge, _COUNT), "lm-counts")
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    scorer = train(docs.where("not held_out"), counts.where(F.col("kind") == PAIR).select("key", "n"), table, shared, vocabulary)
    # the commonest words: whole steps of a quarter power of two, FREQUENT words at most
    step = F.floor(4 * F.log2(F.col("n").cast("double")))
    by_step = sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("w"), F.sum("n").alias("n")).collect(), reverse=True)
    total, kinds = sum(r["n"] for r in by_step), sum(r["w"] for r in by_step)
    taken, least = 0, None
    for r in by_step:
        taken += r["w"]
        if taken > FREQUENT:
            break
        least = r["step"]
    often = words.where(step >= least).toPandas() if least is not None else None
    if often is not None:
        hashes = often["key"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        often = hashes[order], np.log10(often["n"].to_numpy()[order] + 1.0)
    common = spark.sparkContext.broadcast(often or (np.empty(0, np.uint64), np.empty(0)))
    end = words.where(F.col("key") == END_WORD).first()
    end = end["n"] if end else 0
    model = spark.sparkContext.broadcast(scorer)
    scored = docs.select("doc_id", "held_out", "ids").mapInArrow(lambda b: _score(b, model, common), _SCORED)
    scored = written(scored, "lm-scored")
    rare = scored.where(F.size("rare") > 0).select("row", F.explode("rare").alias("key")).join(words, "key").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("more_logs"))
    n = F.col("n_tokens")
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + float(np.log10(end + 1)) - n * float(np.log10(total + kinds + 1))
    known = F.col("n_known") + F.coalesce("more", F.lit(0)) + (1 if end else 0)
    return scored.join(rare, "row", "left").select("doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
