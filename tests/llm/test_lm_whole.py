import numpy as np
import pytest
from pyspark.sql import functions as F

from loomdoc.llm import lm

TEXT = "the quick brown fox jumps over the lazy dog while seven small birds sing above an old stone bridge " * 5


@pytest.mark.parametrize("ids", [[None], list(range(1, 9))])
def test_tasks_train_on_every_document(spark, ids, monkeypatch):
    """Each document, one without an id too, moves the parameters, also where parts are many."""
    monkeypatch.setattr(lm, "PART_TOKENS", 500)
    table = lm.ranks()
    shared = spark.sparkContext.broadcast(table)
    rows = [(i, f"{TEXT} {i} " * (n + 1)) for n, i in enumerate(ids)]
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string").coalesce(1)
    counts = frame(rows).select("text").mapInArrow(lambda b: lm._count(b, shared), lm._COUNT)
    pairs = counts.where(F.col("kind") == lm.PAIR).groupBy("key").agg(F.sum("n").alias("n")).cache()
    learnt = lambda some: lm._flat(lm.train(frame(some), pairs, table, shared).model)
    whole = learnt(rows)
    for n in {0, len(rows) - 1}:
        assert not np.allclose(whole, learnt(rows[:n] + rows[n + 1 :]), atol=1e-5)


def test_layout_does_not_matter(spark, monkeypatch):
    """The same rows in one file or in many, in any order, give the same scores."""
    monkeypatch.setattr(lm, "PART_TOKENS", 2000)
    rows = [(i, f"{TEXT} {i} {'more ' * (i % 7)}" * (1 + i % 3)) for i in range(60)]
    runs = []
    for some, parts in ((rows, 1), (rows[::-1], 1), (rows, 16)):
        df = spark.createDataFrame(some, "doc_id long, text string")
        runs.append({r["doc_id"]: r["score"] for r in lm.score(df.repartition(parts) if parts > 1 else df.coalesce(1)).collect()})
    for other in runs[1:]:
        assert max(abs(other[i] - s) / abs(s) for i, s in runs[0].items()) < 1e-6
