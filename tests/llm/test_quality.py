import re

import zlib

import numpy as np
from conftest import *  # noqa: F403
from pyspark.sql import functions as F

from loomdoc.llm import quality, queries


def test_held_out_accuracy(spark, data):
    data = data.replace("0.001", "0.01")
    got = queries.QUERIES["op6_quality"](spark, data).toPandas()
    labels = spark.read.parquet(f"{data}/labels.parquet").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    m = got[got.held_out].merge(labels, on="doc_id")
    assert len(m) > 80 and (m.predicted == m.quality).mean() > 0.97
    good = m[m.quality == 1]
    assert (good.predicted == 1).mean() > 0.98  # clean documents stay


def test_labels_of_the_held_out_third_are_not_used(spark, data):
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, turned)
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_edge_cases(spark, edge, clashing, empty):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, None, None), (None, 1, 1), (10, 0, 0), (11, 1, 0), (12, 1, 0), (7, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(edge, labels)
    got = quality.score(edge, model).collect()
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (4, 5, 6)}
    assert len(blank) == 1 and blank.pop() == 1 / (1 + np.exp(-model[1]))
    assert quality.score(empty, model).count() == 0
    for table in (labels.limit(0), labels.where("quality = 1")):  # nothing, or one class only
        kept = quality.keep_good(clashing, table)
        assert kept.columns == clashing.columns and kept.count() == edge.count()


def plain_features(text):
    """bucket -> count of a text, word by word and byte by byte."""
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    from loomdoc.llm.textkernel import SPACE, Words, text_chunks

    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    out = Counter()
    top = lambda value, salt: ((value ^ salt) * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - quality.BUCKET_BITS
    for i, w in enumerate(found):
        ((_, _, data, offs),) = text_chunks(pa.array([w]))
        out[int(Words(data, offs, SPACE, fold=False).hash[0] >> np.uint64(64 - quality.BUCKET_BITS))] += 1
        for back in quality.REPEATS:
            if i >= back and found[i - back] == w:
                out[back] += 1
        raw = b" " + w.encode() + b" "
        for size in (3, 4):
            for j in range(len(raw) - size + 1):
                out[top(int.from_bytes(raw[j : j + size], "little"), size * 0x51ED27)] += 1
    return out


def test_scores_against_plain_python(spark, docs):
    import numpy as np

    r = np.random.default_rng(5)
    weights, bias = r.standard_normal(quality.BUCKETS).astype(np.float32), 0.3
    rows = docs.orderBy("doc_id").limit(40).collect()
    got = {x["doc_id"]: x["score"] for x in quality.score(docs, (weights, bias)).collect()}
    for x in rows:
        f = plain_features(x["text"])
        mean = sum(float(weights[k]) * n for k, n in f.items()) / max(1, sum(f.values()))
        assert abs(got[x["doc_id"]] - 1 / (1 + np.exp(-mean - bias))) < 1e-9


def test_learning_against_plain_python(monkeypatch):
    """The same steps with whole matrices in double precision."""
    import numpy as np

    monkeypatch.setattr(quality, "BUCKETS", 50)
    r = np.random.default_rng(9)
    rows = []
    for i in range(30):
        b = np.unique(r.integers(0, 50, 8)).astype(np.int32)
        rows.append((i % 2, b, r.integers(1, 4, len(b)).astype(np.float32)))
    got, bias = quality.learned(rows)
    random = np.random.default_rng(7)
    v = random.uniform(-1 / quality.DIM, 1 / quality.DIM, (50, quality.DIM)).astype(np.float32).astype(float)
    w, c, done = np.zeros((2, quality.DIM)), np.log(np.array([0.5, 0.5])), 0
    for _ in range(quality.EPOCHS):
        for i in random.permutation(len(rows)):
            y, b, n = rows[i]
            rate = quality.RATE * (1 - done / (quality.EPOCHS * len(rows)))
            done += 1
            x = np.zeros(50)
            x[b] = n / n.sum()
            p = np.exp(w @ (x @ v) + c)
            d = p / p.sum() - np.eye(2)[y]
            dv, dw = np.outer(x, d @ w), np.outer(d, x @ v)
            w, c, v = w - 0.1 * rate * dw, c - 0.01 * rate * d, v - rate * dv
    assert np.allclose(got, v @ (w[1] - w[0]), atol=1e-3) and abs(bias - (c[1] - c[0])) < 1e-3


def test_bytes_bound_the_sample(spark, docs, data, monkeypatch):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    seen = []
    monkeypatch.setattr(quality, "learned", lambda rows: seen.append(len(rows)))
    quality.train(docs, labels)
    quality.train(docs.union(docs), labels.union(labels))  # repeated rows are one
    quality.train(docs, labels, train_bytes=20_000)
    quality.train(docs, labels, train_rows=10)
    assert seen[0] == seen[1] > seen[2] > 0 and seen[3] <= 10
