from collections import Counter

import numpy as np
import pyarrow as pa
from test_quality import plain_features

from loomdoc.llm import quality


def packed(texts, labels):
    return pa.Table.from_batches(quality._counted([pa.RecordBatch.from_arrays([pa.array(texts), pa.array(labels, pa.int32())], names=["text", "label"])]))


def test_features_are_made_in_tasks(spark, docs, data, monkeypatch):
    """The driver gets them packed, so its memory does not hold texts, the work on them or wide features."""
    labels = spark.read.parquet(f"{data}/labels.parquet")
    whole = quality.train(docs, labels)

    def here(*_):
        raise AssertionError("features on the driver")

    monkeypatch.setattr(quality, "_features", here)
    again = quality.train(docs, labels)
    assert np.array_equal(whole[0], again[0]) and whole[1] == again[1]


def test_packed_rows_are_the_features():
    """Also of texts without words, with large counts and gaps, and of equal texts; in the order of their bytes."""
    texts = [None, "", "one", "word " * 70000, "a b a b c", "the same text", "the same text", "x" * 3000, "é à " * 300]
    labels = [0, 1, 1, 0, 1, 1, 0, 1, 0]
    sample = quality.Sample(packed(texts, labels))
    got = [(y, dict(zip(b.tolist(), c.tolist(), strict=True))) for y, b, c in sample]
    want = [(y, dict(plain_features(t))) for t, y in zip(texts, labels, strict=True)]
    key = lambda r: (r[0], sorted(r[1].items()))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(b.dtype == np.int32 and c.dtype == np.float32 for _, b, c in sample)
    raw = [(y, b.tobytes(), c.tobytes()) for y, b, c in sample]
    assert raw == sorted(raw) and len(sample) == len(texts)


def test_order_of_rows_alike_at_first():
    """Rows that differ late, or only in counts, are in the order of all their bytes, however they came."""
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base + " w399", base + " zz", base + " " + base, base]
    rows = [[(y, b.tobytes(), c.tobytes()) for y, b, c in quality.Sample(packed(t, [1] * 5))] for t in (texts, texts[::-1])]
    assert rows[0] == rows[1] == sorted(rows[0]) and max(Counter(rows[0]).values()) == 2


def test_packed_features_take_half_the_bytes_of_wide_ones(spark, docs):
    rows = packed([r["text"] for r in docs.limit(100).collect()], [0] * 100)
    assert rows.nbytes < sum(b.nbytes + c.nbytes for _, b, c in quality.Sample(rows)) / 2
