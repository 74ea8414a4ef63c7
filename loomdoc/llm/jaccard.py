"""N-gram Jaccard join with adaptive multi-match prefixes.

1. Copies of one word sequence are one node; its id is the smallest doc_id.
2. A node's shingles are put in one global order, rarest first by a table of hashed counts over
   all documents.  Documents with Jaccard similarity num/den share at least one token of their
   first n - ceil(num*n/den) + 1, and l tokens of prefixes longer by l - 1.  Each node lengthens
   its prefix to the l with the least estimated cost: tokens read plus candidates to verify.
3. Every token's list of nodes links them with one leader (the node with the fewest rarer
   tokens), not with each other, under the length and position filters.
4. A candidate pair must share l prefix tokens before its whole sets are compared.  (Lists hold the shortest
   prefixes: as a list costs a candidate a node, not a pair of nodes, the longer ones save verifications only.)
5. Where a list holds nodes outside its leader's component, those are compared with the others
   of the list outside their own component.  Pairs inside one component add nothing to a class,
   so no similar pair of different components is missed and a group of k copies costs about k.
6. Components of the links give the classes.

Scale.  Shuffled are one prefix per node (n/10 tokens at 0.9), slim links and the sets of nodes to verify; texts are
read in place.  The pairs of one leader are dealt in cells of about CELL, and its set is sent once a cell, so a
leader of any number of near copies costs neither one task nor a copy of its set per pair.
The count table has a fixed size (2**24 counters at most).

Cases: null and wordless texts have no shingles and are linked with nothing; a text shorter than a
shingle is one shingle; repeated rows and rows sharing a doc_id are one node; rows with a null id
join the class of their copies, else their component is null; an empty table gives an empty result;
only doc_id and text are read (keep_one() carries all columns; of equal rows it keeps one, also of wordless ones).  Shingles are compared as 64-bit hashes, sequences as 128-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, small_batches, written
from .graph import components
from .textkernel import SPACE, Words, sequence_hash, shingle_hashes, text_chunks

#: Prefixes are lengthened by LONGEST - 1 tokens at most; comparing one candidate's sets costs
#: as much as reading so many list entries.
LONGEST, VERIFY = 8, 16
#: Ids up to so many are broadcast (4 MB), more are joined by shuffle.
BROADCAST_ROWS = 1 << 18
#: Pairs of one leader that are verified together, about.
CELL = 2048
_SLICE = 1 << 14


def _counts(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    table = np.zeros(1 << bits, dtype=np.uint32)
    for batch in batches:
        for _, _, data, offs in text_chunks(batch.column(0)):
            hashes, _ = shingle_hashes(Words(data, offs, SPACE), k)
            np.add.at(table, (hashes >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
    if table.any():
        cuts = np.split(table, max(1, len(table) // _SLICE))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cuts)), pa.int32()), pa.array([x.tobytes() for x in cuts], pa.binary())], names=["slice", "counts"])


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(c, dtype=np.uint32)
            if s in total:
                total[s] += np.minimum(x, np.uint32(0xFFFFFFFF) - total[s])
            else:
                total[s] = x.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["slice", "counts"])


def shingle_counts(texts: DataFrame, k: int) -> np.ndarray:
    """Hashed occurrence counts of all shingles of all texts; size by the table's bytes, at most 2**24."""
    size = int(str(texts._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    bits = int(np.clip(np.ceil(np.log2(max(1, size / 256))), 16, 24))
    schema = "slice int, counts binary"
    parts = texts.mapInArrow(lambda b: _counts(b, k, bits), schema)
    table = np.zeros(1 << bits, dtype=np.uint32)
    for s, c in parts.repartition("slice").mapInArrow(_sum_counts, schema).collect():
        x = np.frombuffer(bytes(c), dtype=np.uint32)
        table[s * len(x) : (s + 1) * len(x)] = x
    return table


_NODE = "doc_id long, mark long, k1 long, k2 long, n int, level int, prefix array<long>"


def _prefixes(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, shared) -> Iterator[pa.RecordBatch]:
    table = shared.value
    shift = np.uint64(64 - int(np.log2(len(table))))
    usual = float(table.mean())
    levels = np.arange(1, LONGEST + 1)
    for batch in batches:
        k1, k2, sizes, chosen, parts = [], [], [], [], []
        for _, _, data, offs in text_chunks(batch.column(2)):
            words = Words(data, offs, SPACE)
            k1.append(sequence_hash(words, 1))
            k2.append(sequence_hash(words, 2))
            hashes, bounds = shingle_hashes(words, k)
            for i in range(len(bounds) - 1):
                h = np.sort(hashes[bounds[i] : bounds[i + 1]])
                if len(h) > 1:
                    h = h[np.concatenate([[True], h[1:] != h[:-1]])]
                n = len(h)
                sizes.append(n)
                if not n:
                    chosen.append(1)
                    parts.append(np.empty(0, np.int64))
                    continue
                order = np.minimum(table[(h >> shift).astype(np.int64)], 0x7FFF).astype(np.uint64)
                token = np.sort((order << np.uint64(48)) | (h >> np.uint64(16)))
                base = n - -(-num * n // den) + 1
                ends = np.minimum(base - 1 + levels, n)
                seen = np.cumsum(np.maximum((token[: ends[-1]] >> np.uint64(48)).astype(np.float64) - usual, 1.0))[ends - 1]
                level = int(np.argmin(seen * (1 + VERIFY / levels))) + 1
                level = min(level, n - base + 1)
                chosen.append(level)
                parts.append(token[: base - 1 + level].view(np.int64))
        lens = [len(x) for x in parts]
        flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
        prefix = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(flat))
        join = lambda x: pa.array(np.concatenate(x).view(np.int64) if x else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), join(k1), join(k2), pa.array(sizes, pa.int32()), pa.array(chosen, pa.int32()), prefix], names=["doc_id", "mark", "k1", "k2", "n", "level", "prefix"])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for _, _, data, offs in text_chunks(batch.column(1)):
            hashes, bounds = shingle_hashes(Words(data, offs, SPACE), k)
            out += [np.unique(hashes[bounds[i] : bounds[i + 1]]).tobytes() for i in range(len(bounds) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], names=["rep", "hashes"])


def _verify(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs (u, v) of rows (v, u, hashes), each cell of v led by its own set (u null)."""
    own = np.empty(0, np.uint64)
    for batch in batches:
        us, keep = batch.column(1), []
        for i, x in enumerate(batch.column(2)):
            h = np.frombuffer(x.as_buffer(), dtype=np.uint64)
            if not us[i].is_valid:
                own = h.copy()
                continue
            at = np.searchsorted(own, h)
            at[at == len(own)] = 0
            both = int(np.count_nonzero(own[at] == h))
            if den * both >= num * (len(own) + len(h) - both) and both > 0:
                keep.append(i)
        found = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([found.column(1), found.column(0)], names=["u", "v"])


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The written pairs (u, v) whose sets (rep, hashes) are similar."""
    cells = pairs.groupBy("v").agg(F.ceil(F.count("*") / CELL).alias("cells"))
    dealt = pairs.join(cells, "v").select("u", "v", F.pmod(F.xxhash64("u"), "cells").cast("int").alias("cell"))
    leading = dealt.select("v", "cell").distinct().join(sets, F.col("v") == F.col("rep")).select("v", "cell", F.lit(None).cast("long").alias("u"), "hashes")
    rows = leading.union(dealt.join(sets, F.col("u") == F.col("rep")).select("v", "cell", "u", "hashes"))
    rows = rows.repartition("v", "cell").sortWithinPartitions("v", "cell", F.col("u").asc_nulls_first()).select("v", "u", "hashes")
    return written(rows.mapInArrow(lambda b: _verify(b, num, den), "u long, v long").distinct(), "linked")


def _near(a: str, b: str, num: int, den: int):
    """Length and position filter for a token shared by postings a and b."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    least = F.ceil((num * (n + m)) / F.lit(num + den))
    return (den * F.least(n, m) >= num * F.greatest(n, m)) & (F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos")) >= least)


def _ids_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of docs with an id of the written table ids (rep)."""
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    return docs.join(ids, docs["doc_id"] == ids["rep"], "left_semi")


def _linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (u, v), v the one with more of them, that share enough prefix tokens and then enough shingles."""
    own = lambda x: nodes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("level").alias(f"l_{x}"), F.col("prefix").alias(f"p_{x}"))
    level = F.least("l_u", "l_v")
    part = lambda x: F.slice(f"p_{x}", F.lit(1), (F.col(f"n_{x}") - F.ceil(num * F.col(f"n_{x}") / F.lit(den)) + level).cast("int"))
    pairs = pairs.join(own("u"), "u").join(own("v"), "v").where(F.size(F.array_intersect(part("u"), part("v"))) >= level)
    pairs = written(pairs.select("u", "v").distinct(), "pairs")
    ids = written(pairs.select(F.explode(F.array("u", "v")).alias("rep")).distinct(), "pair-ids")
    if ids.isEmpty():
        removed(ids)
        return pairs
    sets = written(_ids_of(docs, ids).mapInArrow(lambda b: _sets(b, k), "rep long, hashes binary"), "pair-sets")
    found = _verified(pairs, sets, num, den)
    removed(pairs, ids, sets)
    return found


def classes(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, mark (xxhash64 of the text), n_shingles, component_id per row of docs (doc_id, text): documents link when
    den * |A and B| >= num * |A or B| over their sets of k-word shingles."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(shingle_counts(docs.select("text"), k))
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    rows = written(marked.mapInArrow(lambda b: _prefixes(b, k, num, den, shared), _NODE), "prefixes")
    nodes = rows.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first(F.struct("n", "level", "prefix")).alias("x"))
    nodes = written(nodes.where("rep IS NOT NULL").select("rep", "k1", "k2", "x.*"), "nodes")
    base = (F.col("n") - F.ceil(num * F.col("n") / F.lit(den)) + 1).cast("int")
    postings = nodes.select("rep", "n", F.posexplode(F.slice("prefix", F.lit(1), base)).alias("pos", "token"))
    leaders = postings.groupBy("token").agg(F.count("*").alias("size"), F.min(F.struct("pos", "rep", "n")).alias("lead")).where("size > 1")
    listed = postings.join(leaders, "token").select("token", "rep", "n", "pos", "size", F.col("lead.rep").alias("lead"), F.col("lead.n").alias("lead_n"), F.col("lead.pos").alias("lead_pos"))
    listed = written(listed, "lists")
    to_lead = listed.alias("a").select("a.*", F.struct(F.col("lead_n").alias("n"), F.col("lead_pos").alias("pos")).alias("b"))
    pairs = to_lead.where(_near("a", "b", num, den) & (F.col("rep") != F.col("lead"))).select(F.col("rep").alias("u"), F.col("lead").alias("v")).distinct()
    links = _linked(pairs, nodes, docs, k, num, den)
    label = components(links)
    # lists with nodes outside the leader's component
    of = lambda name: label.select(F.col("node").alias(f"_{name}"), F.col("component").alias(f"_c{name}"))
    more = listed.where("size > 2 AND rep <> lead").join(of("r"), F.col("rep") == F.col("_r"), "left").join(of("l"), F.col("lead") == F.col("_l"), "left")
    more = written(more.select("token", "rep", "n", "pos", F.coalesce("_cr", "rep").alias("c"), F.coalesce("_cl", "lead").alias("lead_c")), "lists-apart")
    odd, rest = more.where("c <> lead_c").alias("a"), more.alias("b")
    apart = (F.col("a.token") == F.col("b.token")) & (F.col("a.c") != F.col("b.c")) & _near("a", "b", num, den) & ((F.col("b.c") == F.col("b.lead_c")) | (F.col("a.rep") < F.col("b.rep")))
    pairs = odd.join(rest, apart).select(F.greatest("a.rep", "b.rep").alias("u"), F.least("a.rep", "b.rep").alias("v")).distinct()
    found = _linked(pairs, nodes, docs, k, num, den)
    removed(listed, more)
    if not found.isEmpty():
        label = components(found.union(label.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    by_key = nodes.select("k1", "k2", "rep")
    whole = rows.select("doc_id", "mark", "k1", "k2", "n").join(by_key, ["k1", "k2"], "left").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep", "doc_id"))
    out = written(whole.select("doc_id", "mark", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id")), "classes")
    removed(rows, nodes, links, found)
    return out


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs without the documents whose class has a smaller doc_id, or any where their own is null; of rows of one doc_id
    and one text, worded or not, one stays."""
    found = classes(docs, k, num, den)
    key = found.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "component_id")
    out = written(key.where("NOT (_id <=> component_id)").select("_id", "_mark").distinct(), "classes-out")
    again = written(key.groupBy("_id", "_mark").count().where("count > 1").select("_id", "_mark"), "classes-again")
    small = lambda t: F.broadcast(t) if t.count() <= BROADCAST_ROWS else t
    same = lambda t: docs["doc_id"].cast("long").eqNullSafe(t["_id"]) & (F.xxhash64(docs["text"]) == t["_mark"])
    out = small(out)
    kept = docs.join(out, same(out), "left_anti")
    if not again.isEmpty():  # else there is nothing to drop
        again = small(again)
        kept = kept.join(again, same(again), "left_anti").union(kept.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"]))
    removed(found)
    return kept
