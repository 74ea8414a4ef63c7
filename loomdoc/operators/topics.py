"""Vectors, clusters, topics and their metrics."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..sources.stage import staged
from . import bags
from . import chunks as C
from . import keywords as K
from .links import components


def centroids(vectors: DataFrame, group: str, vector: str = "embedding", normalize: bool = True) -> DataFrame:
    """group, centroid: mean vector of a group, of length 1 if normalize."""
    flat = vectors.select(group, F.posexplode(vector).alias("dim", "x"))
    mean = flat.groupBy(group, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    out = mean.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("v")).select(group, F.col("v.m").alias("centroid"))
    return out.withColumn("centroid", T.unit(F.col("centroid"))) if normalize else out


def exemplars(vectors: DataFrame, group: str, key: str, vector: str = "embedding") -> DataFrame:
    """group, key of the member with the largest mean cosine to all members (smallest key of equals).
    The mean of cosines to all members is the product with the mean unit vector: no pairs are made."""
    unit = vectors.select(group, key, T.unit(F.col(vector)).alias("u"))
    mean = centroids(unit, group, "u", normalize=False)
    near = unit.join(mean, group).select(group, key, T.dot(F.col("u"), F.col("centroid")).alias("s"))
    first = F.row_number().over(W.partitionBy(group).orderBy(F.desc("s"), key))
    return near.withColumn("r", first).where("r = 1").select(group, key, F.col("s").alias("mean_similarity"))


def semantic_variance(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Mean squared distance to the mean vector; 0 for fewer than two vectors."""
    flat = vectors.select(group, F.posexplode(vector).alias("dim", "x"))
    return flat.groupBy(group, "dim").agg(F.var_pop(F.col("x").cast("double")).alias("v")).groupBy(group).agg(F.sum("v").alias("semantic_variance"))


def coherence(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """Mean cosine of different members, for groups of two or more, from the sum of unit vectors."""
    flat = vectors.select(group, F.posexplode(T.unit(F.col(vector))).alias("dim", "x"))
    sums = flat.groupBy(group, "dim").agg(F.sum("x").alias("s"), F.count("*").alias("n"), F.sum(F.col("x") * F.col("x")).alias("own"))
    return sums.groupBy(group).agg(((F.sum(F.col("s") * F.col("s")) - F.sum("own")) / (F.max("n") * (F.max("n") - 1))).alias("coherence"), F.max("n").alias("n")).where("n > 1").drop("n")


def similar_pairs(vectors: DataFrame, group: str, thresholds: list[float], vector: str = "embedding", block: int = 1024) -> DataFrame:
    """group, n, p0, p1, ...: number of vectors, and of pairs with a cosine above each threshold.  A group's vectors are dealt in
    blocks; every pair of blocks is one row of the join and one matrix product, so a large group is spread over
    tasks and no pair of vectors becomes a row."""
    u = vectors.select(F.col(group).alias("_g"), T.unit(F.col(vector)).alias("u"))
    sizes = u.groupBy(F.col("_g").alias("_s")).agg(F.count("*").alias("n"))
    numbered = u.join(sizes, F.col("_g").eqNullSafe(F.col("_s"))).select("_g", "n", "u")
    dealt = numbered.withColumn("b", F.pmod(F.xxhash64("u"), F.ceil(F.col("n") / block)).cast("int"))
    blocks = dealt.groupBy("_g", "n", "b").agg(F.flatten(F.collect_list("u")).alias("x"), F.count("*").alias("m"))
    other = blocks.select(F.col("_g").alias("_h"), F.col("b").alias("c"), F.col("x").alias("y"), F.col("m").alias("k"))
    pairs = blocks.join(other, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("b") <= F.col("c"))).select("_g", "n", "b", "c", "m", "k", "x", "y")
    kind = vectors.schema[group].dataType.simpleString()
    names = [f"p{i}" for i in range(len(thresholds))]

    def count(batches):
        for batch in batches:
            found = []
            for b, c, m, k, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)), batch.column(6), batch.column(7), strict=True):
                s = x.values.to_numpy().reshape(m, -1) @ y.values.to_numpy().reshape(k, -1).T
                found.append([int(((s > t).sum() - (np.diagonal(s) > t).sum()) // 2 if b == c else (s > t).sum()) for t in thresholds])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([f[i] for f in found], pa.int64()) for i in range(len(thresholds)))], names=["_g", "n", *names])

    counted = pairs.mapInArrow(count, f"_g {kind}, n long, " + ", ".join(f"{x} long" for x in names))
    return counted.groupBy("_g", "n").agg(*[F.sum(x).alias(x) for x in names]).withColumnRenamed("_g", group)


def redundancy_penalty(vectors: DataFrame, group: str, thresholds: list[float] | float = 0.85, vector: str = "embedding") -> DataFrame:
    """group and for each threshold (column redundancy_penalty, or redundancy_penalty_0, ... of a list) the share of the group's
    pairs with a cosine above it; 0 for fewer than two."""
    listed = thresholds if isinstance(thresholds, list) else [thresholds]
    named = [f"redundancy_penalty_{i}" for i in range(len(listed))] if isinstance(thresholds, list) else ["redundancy_penalty"]
    all_ = F.col("n") * (F.col("n") - 1) / 2
    shares = [F.when(F.col("n") > 1, F.col(f"p{i}") / all_).otherwise(0.0).alias(x) for i, x in enumerate(named)]
    return similar_pairs(vectors, group, listed, vector).select(group, *shares)


def _dbscan(x: np.ndarray, eps: float, min_samples: int) -> np.ndarray:
    """Labels in the order of each cluster's first core point; -1 for noise."""
    n = len(x)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    near = [np.flatnonzero(1 - u @ u[i] <= eps) for i in range(n)]
    core = np.array([len(p) >= min_samples for p in near], dtype=bool)
    labels = np.full(n, -1)
    for i in np.flatnonzero(core):
        if labels[i] >= 0:
            continue
        label = labels.max() + 1
        labels[i] = label
        stack = [i]
        while stack:
            for q in near[stack.pop()]:
                if labels[q] < 0:
                    labels[q] = label
                    if core[q]:
                        stack.append(q)
    return labels


def clusters(points: DataFrame, doc: str, key: str, vector: str = "embedding", eps: float = 0.25, min_samples: int = 2) -> DataFrame:
    """doc, key, label by density in cosine distance within each doc (a document's points come together in a task)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        labels = _dbscan(np.array(pdf[vector].tolist(), dtype=np.float64).reshape(len(pdf), -1), eps, min_samples)
        return pd.DataFrame({doc: pdf[doc], key: pdf[key], "label": labels.astype(np.int32)})

    kind = lambda c: points.schema[c].dataType.simpleString()
    return points.select(doc, key, vector).groupBy(doc).applyInPandas(run, f"{doc} {kind(doc)}, {key} {kind(key)}, label int")


def _forest(near: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what near (rows i, columns j) joins: every row and column with the first row of its component, found by
    passing the least row number on until nothing changes."""
    far = len(i)
    row = np.where(near.any(axis=1), np.arange(far), far)
    while True:
        column = np.where(near, row[:, None], far).min(axis=0)
        least = np.minimum(row, np.where(near, column[None, :], far).min(axis=1))
        if np.array_equal(least, row):
            break
        row = least
    r, c = np.flatnonzero(row < far), np.flatnonzero(column < far)
    return np.concatenate([i[r], j[c]]), np.concatenate([i[row[r]], i[column[c]]])


#: A document's points are dealt in so many blocks, so that what is sent to tasks (every block to each other's) grows as the points do ...
BLOCKS = 32
#: ... unless blocks would hold more than so many points: those of which only links are sought, by tiles, and those of other passes.
LINKED, DENSE = 16_384, 2_048


def _dealt(points: DataFrame, block: int, most: int) -> DataFrame:
    """points (_d, ...) with g, the number of their document's blocks, and b, the own one."""
    n = F.col("n")
    sizes = points.groupBy(F.col("_d").alias("_e")).agg(F.count("*").alias("n"))
    sizes = sizes.select("_e", F.ceil(n / F.least(F.lit(max(block, most)), F.greatest(F.lit(block), F.ceil(n / BLOCKS)))).cast("int").alias("g"))
    return points.join(F.broadcast(sizes), F.col("_d").eqNullSafe(F.col("_e"))).drop("_e").withColumn("b", F.pmod(F.xxhash64("_id"), F.col("g")).cast("int"))


def _block_pairs(points: DataFrame, block: int) -> DataFrame:
    """Every two blocks of a document's points (_d, _id, _side, _rank, u): d, a, b, x, y, and ids and ranks i, j, s, t of points of
    side 0 and side 1 (both sides: side null)."""
    dealt = _dealt(points, block, DENSE)
    rows = F.sort_array(F.collect_list(F.struct("_id", "_rank", "u")))

    def side(k: int, names: str, own: str, other: str) -> DataFrame:
        g = dealt.where(f"_side IS NULL OR _side = {k}").groupBy("_d", "b").agg(rows.alias("r"), F.first("g").alias("g"))
        d, i, s, x = names
        g = g.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
        return g.select(F.col("_d").alias(d), F.col("b").alias(own), F.col("at").alias(other), F.col("r._id").alias(i), F.col("r._rank").alias(s), F.flatten("r.u").alias(x))

    left, right = side(0, "disx", "a", "b"), side(1, "ejty", "f", "c")
    met = F.col("d").eqNullSafe(F.col("e")) & (F.col("a") == F.col("c")) & (F.col("b") == F.col("f"))
    return left.join(right, met).select("i", "j", "s", "t", "x", "y")


def _least(eps: float) -> float:
    """The least cosine s for which 1 - s <= eps."""
    s = 1 - eps
    while 1 - s > eps:
        s = np.nextafter(s, 2)
    while 1 - np.nextafter(s, -2) <= eps:
        s = np.nextafter(s, -2)
    return float(s)


def _joined(x: np.ndarray, y: np.ndarray | None, own: np.ndarray, other: np.ndarray, least: float, tile: int = 1024) -> list[tuple[int, int]]:
    """Pairs of components (numbers own of the rows of x, other of those of y; y None: x itself) that points with a cosine of least join, a
    forest.  Tiles whose points are of one component by then are not multiplied; the rest is in single precision first, and what may reach
    the least cosine in double."""
    symmetric = y is None
    order = np.argsort(own, kind="stable")
    x, own = x[order], own[order]
    if symmetric:
        y, other = x, own
    else:
        order = np.argsort(other, kind="stable")
        y, other = y[order], other[order]
    x4, y4 = x.astype(np.float32), y.astype(np.float32)
    root, links = np.arange(max(own.max(initial=-1), other.max(initial=-1)) + 1), []
    near4 = np.float32(least - 4e-5)

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for a in range(0, len(x), tile):
        for b in range(a if symmetric else 0, len(y), tile):
            p, q = root[own[a : a + tile]], root[other[b : b + tile]]
            if (p == p[0]).all() and (q == p[0]).all():
                continue
            s = x4[a : a + tile] @ y4[b : b + tile].T
            if s.max() < near4:
                continue
            i, j = np.nonzero(s >= near4)
            while len(i):
                differ = root[p[i]] != root[q[j]]
                i, j = i[differ], j[differ]
                if not len(i):
                    break
                k, m = i[:16_384], j[:16_384]
                i, j = i[16_384:], j[16_384:]
                near = np.einsum("ij,ij->i", x[a + k], y[b + m]) >= least
                for u, v in set(zip(p[k[near]].tolist(), q[m[near]].tolist(), strict=True)):
                    f, g = find(u), find(v)
                    if f != g:
                        root[max(f, g)] = min(f, g)
                        links.append((f, g))
                while not np.array_equal(flat := root[root], root):
                    root[:] = flat
    return links


def _links_of_points(points: DataFrame, block: int, eps: float) -> DataFrame:
    """u, v: links that join all points (_d, _id, u) of a document with a cosine distance of eps at most, a forest for each block and
    each two blocks: first within blocks, then between the components that these have."""
    least = _least(eps)
    rows = F.sort_array(F.collect_list(F.struct("_id", "u")))
    blocks = _dealt(points, block, LINKED).groupBy("_d", "b").agg(rows.alias("r"), F.first("g").alias("g"))
    blocks = blocks.select("_d", "b", "g", F.col("r._id").alias("i"), F.flatten("r.u").alias("x"))

    def matrix(x, n):
        return x.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)

    def within(batches):
        for batch in batches:
            roots = []
            for i, x in zip(batch.column(3), batch.column(4), strict=True):
                n = len(i)
                root = np.arange(n)
                for f, g in _joined(matrix(x, n), None, np.arange(n), np.arange(n), least):
                    root[max(f, g)] = min(f, g)
                while not np.array_equal(flat := root[root], root):
                    root = flat
                roots.append(pa.array(root.astype(np.int32)))
            held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r) for r in roots])]).astype(np.int32)), pa.concat_arrays(roots) if roots else pa.array([], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, held], names=["_d", "b", "g", "i", "x", "root"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema.fields)
    blocks = staged(blocks.mapInArrow(within, f"{schema}, root array<int>"), "blocks")
    own = blocks.select(F.explode(F.arrays_zip("i", F.transform("root", lambda r: F.get("i", r)).alias("v"))).alias("z")).select(F.col("z.i").alias("u"), F.col("z.v").alias("v")).where("u <> v")
    left = blocks.where("b < g - 1").withColumn("c", F.explode(F.sequence(F.col("b") + 1, F.col("g") - 1)))
    right = blocks.where("b > 0").select(F.col("_d").alias("e"), F.col("b").alias("f"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("h"), F.col("i").alias("j"), F.col("x").alias("y"), F.col("root").alias("toor"))
    pairs = left.join(right, F.col("_d").eqNullSafe(F.col("e")) & (F.col("b") == F.col("h")) & (F.col("c") == F.col("f"))).select("i", "j", "x", "y", "root", "toor")

    def between(batches):
        for batch in batches:
            u, v = [], []
            for i, j, x, y, r, t in zip(*batch.columns, strict=True):
                ids = np.concatenate([i.values.to_numpy(), j.values.to_numpy()])
                r, t = r.values.to_numpy(), t.values.to_numpy() + len(i)
                for f, g in _joined(matrix(x, len(i)), matrix(y, len(j)), r, t, least):
                    u.append(ids[f])
                    v.append(ids[g])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return own.union(pairs.mapInArrow(between, "u long, v long"))


def _over_blocks(pairs: DataFrame, eps: float, emit, schema: str) -> DataFrame:
    """emit(near, i, j, s, t) of every pair of blocks, near being who is within eps of whom: lists of columns."""

    def run(batches):
        for batch in batches:
            out: list[list] = []
            for i, j, s, t, x, y in zip(*batch.columns, strict=True):
                i, j, s, t = (z.values.to_numpy(zero_copy_only=False) for z in (i, j, s, t))
                near = 1 - x.values.to_numpy().reshape(len(i), -1) @ y.values.to_numpy().reshape(len(j), -1).T <= eps
                out.append(emit(near, i, j, s, t))
            names = [z.split()[0] for z in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out]) if out else [], pa.int64()) for k in range(len(names))], names=names)

    return pairs.mapInArrow(run, schema)


def clusters_in_blocks(points: DataFrame, doc: str, key: str, vector: str = "embedding", eps: float = 0.25, min_samples: int = 2, block: int = 512) -> DataFrame:
    """clusters(), for documents of many points: every pair of blocks of a document is one matrix product in a task of its own, which gives
    numbers of neighbours, then links that join its core points (a forest, not all pairs), then the first cluster near
    every other point; the links' components are the clusters.  With min_samples of 2 a point with any neighbour is core, so the links
    alone tell all, and pairs of points that others have joined are not compared."""
    u = points.select(F.col(doc).alias("_d"), F.col(key).alias("_k"), T.unit(F.col(vector)).alias("u"), F.lit(None).cast("int").alias("_side"), F.lit(0).cast("long").alias("_rank"))
    u = staged(u.withColumn("_id", F.monotonically_increasing_id()), "points")
    if min_samples == 2 and eps > 1e-9:  # else a point might not be its own neighbour
        found = components(_links_of_points(u.select("_d", "_id", "u"), block, eps))
        named = u.select("_d", "_id", "_k").join(found, F.col("_id") == F.col("node"), "left").select("_d", "_k", F.col("component").alias("c"))
        first = named.where("c IS NOT NULL").groupBy("_d", "c").agg(F.min("_k").alias("k"))
        first = first.select(F.col("c").alias("_c"), (F.row_number().over(W.partitionBy("_d").orderBy("k")) - 1).alias("label"))
        out = named.join(first, F.col("c") == F.col("_c"), "left")
        return out.select(F.col("_d").alias(doc), F.col("_k").alias(key), F.coalesce("label", F.lit(-1)).cast("int").alias("label"))
    degree = _over_blocks(_block_pairs(u, block), eps, lambda near, i, j, s, t: (i, near.sum(axis=1)), "_id long, n long")
    core = staged(degree.groupBy("_id").agg(F.sum("n").alias("n")).where(F.col("n") >= min_samples).select("_id"), "cores")
    cores = u.join(core, "_id")

    found = components(_over_blocks(_block_pairs(cores, block), eps, lambda near, i, j, s, t: _forest(near, i, j), "u long, v long"))
    named = cores.join(found, F.col("_id") == F.col("node"), "left").select("_d", "_id", "_k", "u", F.coalesce("component", "_id").alias("c"))
    first = named.groupBy("_d", "c").agg(F.min("_k").alias("k"))
    first = first.select(F.col("_d").alias("_e"), F.col("c").alias("_c"), (F.row_number().over(W.partitionBy("_d").orderBy("k")) - 1).cast("long").alias("_rank"))
    named = staged(named.join(first, F.col("_d").eqNullSafe(F.col("_e")) & (F.col("c") == F.col("_c"))).select("_d", "_id", "_k", "u", "_rank"), "named")
    rest = u.join(core, "_id", "left_anti").select("_d", "_id", "_k", "u", F.lit(-1).cast("long").alias("_rank"))
    both = rest.withColumn("_side", F.lit(0)).unionByName(named.withColumn("_side", F.lit(1)))

    def border(near, i, j, s, t):
        least = np.where(near, t[None, :], np.iinfo(np.int64).max).min(axis=1)
        own = least < np.iinfo(np.int64).max
        return i[own], least[own]

    near = _over_blocks(_block_pairs(both, block), eps, border, "_id long, r long").groupBy("_id").agg(F.min("r").alias("r"))
    rest = rest.join(near, "_id", "left").select("_d", "_k", F.coalesce("r", F.lit(-1)).alias("_rank"))
    out = named.select("_d", "_k", "_rank").union(rest)
    return out.select(F.col("_d").alias(doc), F.col("_k").alias(key), F.col("_rank").cast("int").alias("label"))


def mmr(candidates: DataFrame, group: str, key: str, vector: str = "embedding", k: int = 10, weight: float = 0.7) -> DataFrame:
    """group, key, rank: k members chosen greedily by weight * cosine to the mean less (1 - weight) * largest cosine to
    those chosen (smallest key of equals); all in their order where k are there or fewer.
    Each step is an arg-max over all rows, aggregated in every task first; only the k chosen of each group are broadcast."""
    u = candidates.select(F.col(group).alias("_g"), F.col(key).alias("_k"), T.unit(F.col(vector)).alias("_u"))
    u = staged(u.withColumn("_row", F.monotonically_increasing_id()), "mmr")
    mean = centroids(u.select("_g", "_u"), "_g", "_u")
    at = F.col("_k").isNull().alias("last"), F.col("_k").alias("key"), F.col("_row").alias("row")
    sizes = u.groupBy("_g").agg(F.count("*").alias("n")).select(F.col("_g").alias("_s"), "n")
    mean = mean.join(sizes, F.col("_g").eqNullSafe(F.col("_s"))).select(F.col("_g").alias("_of"), "n", "centroid")

    def members(groups: DataFrame) -> DataFrame:
        return u.join(F.broadcast(groups), F.col("_g").eqNullSafe(F.col("_of")))

    none = u.select(F.array(F.struct(F.col("_k").alias("key"), F.col("_row").alias("row"), F.col("_u").alias("u")))).schema[0].dataType.simpleString()
    state = mean.where(F.col("n") > k).withColumn("chosen", F.array().cast(none))
    for _ in range(k):
        open_ = members(state).where(~F.exists("chosen", lambda c: c["row"] == F.col("_row")))
        most = F.coalesce(F.array_max(F.transform("chosen", lambda c: T.dot(F.col("_u"), c["u"]))), F.lit(0.0))
        score = weight * T.dot(F.col("_u"), F.col("centroid")) - (1 - weight) * most
        best = F.min(F.struct((-score).alias("score"), *at, F.col("_u").alias("u"))).alias("best")
        state = open_.groupBy("_of").agg(best, *[F.first(c).alias(c) for c in ("centroid", "chosen")])
        state = state.select("_of", "centroid", F.concat("chosen", F.array(F.struct("best.key", "best.row", "best.u"))).alias("chosen"))
    few = members(mean.where(F.col("n") <= k)).groupBy("_of").agg(F.array_sort(F.collect_list(F.struct(*at))).alias("chosen"))
    out = state.select("_of", F.col("chosen.key").alias("keys")).union(few.select("_of", F.col("chosen.key").alias("keys")))
    return out.select(F.col("_of").alias(group), F.posexplode("keys").alias("rank", key)).select(group, key, (F.col("rank") + 1).alias("rank"))


def keyword_mmr(words: DataFrame, keys: list[str], k: int = 10, weight: float = 0.7) -> DataFrame:
    """keys, keywords: k of each group's keywords (in order) by diversity of their hashed vectors; all of k or fewer as they are."""
    flat = words.where(F.size("keywords") > k).select(F.struct(*keys).alias("_of"), F.posexplode("keywords").alias("_i", "text"))
    dense = C.dense(C.vectors(flat, ["_of", "_i"], size=256), ["_of", "_i"], 256)
    chosen = mmr(dense, "_of", "_i", k=k, weight=weight).join(flat.select("_of", "_i", "text"), ["_of", "_i"])
    chosen = chosen.groupBy("_of").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("x")).select("_of.*", F.col("x.text").alias("keywords"))
    return words.where(F.size("keywords") <= k).select(*keys, "keywords").union(chosen.select(*keys, "keywords"))


def topic_items(texts: DataFrame, labels: DataFrame, k: int = 10, vectors: DataFrame | None = None, second: DataFrame | None = None) -> DataFrame:
    """doc_id, topic_id, count, keywords of clustered texts (doc_id, block_idx, text); a document without a
    cluster is one topic 0 of all its texts.  With vectors (doc_id, block_idx, embedding) also exemplar, the text nearest to
    all others of its topic (the first text where there is no cluster).  second: doc_id, topic_id, keywords of another
    extractor, fused behind the frequent ones; more than k are then thinned by diversity."""
    if second is not None or vectors is not None:
        plain = topic_items(texts, labels, k)
        keys = ["doc_id", "topic_id"]
        if second is not None:
            both = plain.join(second.select(*keys, F.col("keywords").alias("_more")), keys, "left")
            both = staged(both.withColumn("keywords", K.fused(F.col("keywords"), F.col("_more"), 2 * k)).drop("_more"), "topic-words")
            plain = both.drop("keywords").join(keyword_mmr(both, keys, k), keys)
        if vectors is None:
            return plain
        t = texts.select("doc_id", "block_idx", "text").join(labels.select("doc_id", "block_idx", "label"), ["doc_id", "block_idx"])
        v = t.where("label >= 0").join(vectors.select("doc_id", "block_idx", "embedding"), ["doc_id", "block_idx"])
        best = exemplars(v.select(F.struct("doc_id", F.col("label").alias("topic_id")).alias("_of"), "block_idx", "embedding"), "_of", "block_idx").select("_of.*", "block_idx")
        best = best.join(t.select("doc_id", "block_idx", F.col("text").alias("exemplar")), ["doc_id", "block_idx"])
        first = t.groupBy("doc_id").agg(F.max("label").alias("m"), F.min(F.struct("block_idx", "text")).alias("f")).where("m < 0")
        best = best.select(*keys, "exemplar").union(first.select("doc_id", F.lit(0).alias("topic_id"), F.col("f.text").alias("exemplar")))
        return plain.join(best, keys, "left")
    t = texts.join(labels.select("doc_id", "block_idx", "label"), ["doc_id", "block_idx"])
    none = F.max("label").over(W.partitionBy("doc_id")) < 0
    t = t.withColumn("topic_id", F.when(none, 0).otherwise(F.col("label"))).where("topic_id >= 0")
    count = t.groupBy("doc_id", "topic_id").agg(F.count("*").alias("count"))
    words = K.tfidf_lists(t, ["doc_id", "topic_id"], "block_idx", k).drop("scores")
    return count.join(words, ["doc_id", "topic_id"], "left")


def topic_of(labels: DataFrame, topics: DataFrame) -> DataFrame:
    """labels with the keywords of topic number label mod n of their document (noise, -1, gets the last one's)."""
    t = topics.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("topic_id", "keywords"))).alias("_ts"))
    found = labels.join(t, "doc_id", "left")
    return found.withColumn("keywords", F.get("_ts", F.pmod("label", F.size("_ts")).cast("int"))["keywords"]).drop("_ts")


def metrics(topics: DataFrame, group: str) -> DataFrame:
    """Coverage, sizes, diversity, entropy, balance and redundancy of topics (topic_id, count, keywords) per group."""
    real, has = F.col("topic_id") != -1, F.size("keywords") > 0
    t = topics.withColumn("keywords", F.coalesce("keywords", F.array().cast("array<string>")))
    own = F.col(group).alias("_g")
    # topics of one size are alike in all but their keywords: a group is known by how many there are of each size
    sizes = t.groupBy(own, real.alias("real"), F.col("count").cast("long").alias("c")).agg(
        F.count("*").alias("m"),
        F.sum(has.cast("int")).alias("has"),
        F.sum(F.when(has, 1 - F.size(F.array_distinct("keywords")) / F.size("keywords"))).alias("again"),
    )
    m, c, exact = F.col("m"), F.col("c"), lambda x: F.sum(x.cast("decimal(38,0)"))
    a = sizes.groupBy("_g").agg(
        F.sum("m").alias("n_topics"),
        F.coalesce(F.sum(F.when(F.col("real"), m)), F.lit(0)).alias("n_real"),
        F.min(F.when(F.col("real"), c)).cast("double").alias("size_min"),
        F.expr("percentile(CASE WHEN real THEN c END, 0.5, m)").alias("size_median"),
        F.array_sort(F.collect_list(F.when(F.col("real"), F.struct(c.alias("c"), m.alias("m"))))).alias("sizes"),
        (F.sum("again") / F.sum("has")).alias("redundancy_score"),
        exact(m * c).alias("total"),
        exact(m * c * c).alias("squares"),
        F.sum("has").alias("has"),
    )
    words = t.select(own, F.explode("keywords").alias("w")).groupBy("_g", "w").agg(F.count("*").alias("m"))
    words = words.groupBy(F.col("_g").alias("_h")).agg(F.count("*").alias("kinds"), F.sum("m").alias("all"))
    a = a.join(words, F.col("_g").eqNullSafe(F.col("_h")), "left")
    n, real_total = F.col("n_topics"), F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x["m"] * x["c"])
    p = lambda x: x["c"] / F.col("real_total")
    a = a.withColumn("real_total", real_total).withColumn("h", -F.aggregate("sizes", F.lit(0.0), lambda s, x: s + x["m"] * (p(x) * F.log(p(x) + 1e-12))))
    at = F.floor(0.95 * (F.col("n_real") - 1))  # place of the size that is asked for, from 0
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("c"))
    p95 = F.aggregate("sizes", none, lambda s, x: F.struct((s["n"] + x["m"]).alias("n"), F.when(s["c"].isNull() & (s["n"] + x["m"] > at), x["c"]).otherwise(s["c"]).alias("c")), lambda s: s["c"])
    mean, whole = F.col("total").cast("double") / n, n.cast("decimal(20,0)") * F.col("squares") - F.col("total") * F.col("total")
    diversity = F.when(F.col("all") > 0, F.col("kinds") / F.col("all")).otherwise(0.0)
    return a.select(
        F.col("_g").alias(group),
        "n_topics",
        F.round(F.col("n_real") / n, 6).alias("coverage"),
        F.round((n - F.col("n_real")) / n, 6).alias("outlier_rate"),
        F.coalesce("size_min", F.lit(0.0)).alias("size_min"),
        F.coalesce("size_median", F.lit(0.0)).alias("size_median"),
        F.coalesce(p95.cast("double"), F.lit(0.0)).alias("size_p95"),
        F.round(diversity, 6).alias("keywords_diversity"),
        diversity.alias("keywords_diversity_ext"),
        F.when(F.col("n_real") > 1, F.col("h") / (F.log(F.col("n_real").cast("double")) + 1e-12)).otherwise(0.0).alias("entropy_topics"),
        F.coalesce("redundancy_score", F.lit(0.0)).alias("redundancy_score"),
        F.when((n > 1) & (mean > 0), 1 - F.sqrt(whole.cast("double")) / n / (mean + 1e-9)).otherwise(0.0).alias("topic_balance"),
        F.when(F.col("all") > 0, 1 - diversity).otherwise(0.0).alias("keyword_redundancy_rate"),
        (F.col("has") / n).alias("informativeness_ratio"),
    )


def block_topics(blocks: DataFrame, n: int = 3, k: int = 5) -> DataFrame:
    """doc_id, topic_id, keywords: every n-th block of a document as a topic (a stand-in where no clusters are)."""
    t = blocks.withColumn("topic_id", F.pmod("block_idx", F.lit(n)).cast("int"))
    return K.tfidf_lists(t, ["doc_id", "topic_id"], "block_idx", k).drop("scores")


def hints(found: DataFrame, topics: DataFrame, k: int = 3, blend: float = C.BLEND) -> DataFrame:
    """doc_id, chunk_seq, topic_id, affinity, rank: the k topics of its document nearest to a chunk, by
    blend * cosine to the keywords' mean vector and (1 - blend) * Jaccard of tokens and keywords."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    bags.small_batches(found.sparkSession)
    listed = F.array_sort(F.collect_list(F.struct("topic_id", "keywords"))).alias("_ts")
    rows = found.select("doc_id", "chunk_seq", T.words(F.col("text")).alias("words"), "tokens").join(topics.groupBy("doc_id").agg(listed), "doc_id")
    lower = lambda t: F.array_distinct(F.transform(t["keywords"], lambda x: F.lower(x)))
    rows = rows.select("doc_id", "chunk_seq", F.col("_ts.topic_id").alias("topic_ids"), "words", "tokens", F.transform("_ts", lambda t: F.transform(t["keywords"], T.words)).alias("said"), F.transform("_ts", lower).alias("keywords"))
    schema = S.StructType([*rows.schema.fields[:3], S.StructField("near", S.ArrayType(S.DoubleType()))])
    arrow = to_arrow_schema(schema)
    near = rows.mapInArrow(lambda b: bags.near_topics(b, blend, 4096, arrow), schema)
    place = F.arrays_zip("near", "topic_ids")
    best = F.array_sort(F.transform(place, lambda z: F.struct((-F.round(z["near"], 6)).alias("a"), z["topic_ids"].alias("t"))))
    out = near.select("doc_id", "chunk_seq", F.posexplode(F.slice(best, 1, k)).alias("at", "b"))
    return out.select("doc_id", "chunk_seq", F.col("b.t").alias("topic_id"), (-F.col("b.a")).alias("affinity"), (F.col("at") + 1).alias("rank"))


def context_alignment(found: DataFrame, group: str, chunk: str = "emb_chunk", hint: str = "emb_hint") -> DataFrame:
    """group, context_alignment: mean cosine of a chunk's vector and that of its inherited topic, over chunks that have both; else 0."""
    both = F.col(chunk).isNotNull() & F.col(hint).isNotNull()
    return found.groupBy(group).agg(F.coalesce(F.avg(F.when(both, T.cosine(F.col(chunk), F.col(hint)))), F.lit(0.0)).alias("context_alignment"))


def sparse_variance(vectors: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sem_var: mean squared distance of a group's texts to their mean, of sparse vectors (keys, bucket, w; a text
    without words is the zero vector): mean squared length less the mean's squared length; 0 for fewer than two texts."""
    n = texts.groupBy(*keys).agg(F.count("*").alias("n"))
    sums = vectors.groupBy(*keys, "bucket").agg(F.sum("w").alias("s"), F.sum(F.col("w") * F.col("w")).alias("q"))
    sums = sums.groupBy(*keys).agg(F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s")).alias("s"))
    var = F.coalesce("q", F.lit(0.0)) / F.col("n") - F.coalesce("s", F.lit(0.0)) / (F.col("n") * F.col("n"))
    return n.join(sums, keys, "left").select(*keys, F.when(F.col("n") > 1, var).otherwise(0.0).alias("sem_var"))


def router_votes_with_vectors(texts: DataFrame, vectors: DataFrame, group: str, order: str, limit: float = 0.25) -> DataFrame:
    """router_votes() with the third vote, sem_var over limit."""
    v = router_votes(texts, group, order).join(sparse_variance(vectors, texts, [group]), group)
    votes = (F.col("avg_len") < 45).cast("int") + (F.col("ttr") > 0.5).cast("int") + (F.col("sem_var") > limit).cast("int")
    few = F.col("n") < 5
    return v.withColumn("hybrid_doc", few | (votes >= 2)).withColumn("hybrid_chunks", few | (F.col("avg_len") < 60) | (F.col("sem_var") > limit))


def router_votes(texts: DataFrame, group: str, order: str) -> DataFrame:
    """group, n, avg_len, ttr, hybrid_doc, hybrid_chunks: the votes for the hybrid mode, without vectors."""
    first = F.row_number().over(W.partitionBy(group).orderBy(order))
    t = texts.withColumn("r", first).withColumn("toks", T.rough_tokens(F.col("text")))
    a = t.groupBy(group).agg(F.count("*").alias("n"), (F.sum(F.size("toks")) / F.count("*")).alias("avg_len"), F.avg(F.when(F.col("r") <= 32, T.type_token_ratio(F.col("toks")))).alias("ttr"))
    votes = (F.col("avg_len") < 45).cast("int") + (F.col("ttr") > 0.5).cast("int")
    return a.withColumn("hybrid_doc", (F.col("n") < 5) | (votes >= 2)).withColumn("hybrid_chunks", (F.col("n") < 5) | (F.col("avg_len") < 60))
