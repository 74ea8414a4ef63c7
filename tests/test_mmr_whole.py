"""MMR over all vectors of a label: against numpy and the query's SQL."""

import duckdb
import numpy as np

from loomdoc.operators import topics as P
from loomdoc.plans import catalogue


def greedy(keys, x, k, weight=0.7):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ (x.mean(0) / np.linalg.norm(x.mean(0)))
    chosen = [int(near.argmax())]
    while len(chosen) < k:
        gain = weight * near - (1 - weight) * (x @ x[chosen].T).max(1)
        gain[chosen] = -np.inf
        chosen.append(int(gain.argmax()))
    return [keys[i] for i in chosen]


def test_query_takes_every_vector(spark, data):
    got = sorted((r["label"], r["rank"], r["vec_id"]) for r in catalogue.QUERIES["q25_mmr"](spark, data).collect())
    c = duckdb.connect()
    c.sql(f"CREATE VIEW embeddings AS FROM '{data}/embeddings.parquet'")
    sql = catalogue.ORACLE_SQL["q25_mmr"]
    assert got == sorted(c.sql(f"SELECT label, rank, vec_id FROM ({sql})").fetchall())
    e = c.sql("SELECT label, vec_id, embedding FROM embeddings ORDER BY label, vec_id").fetchall()
    want = []
    for label in sorted({r[0] for r in e}):
        mine = [r for r in e if r[0] == label]
        want += [(label, i, v) for i, v in enumerate(greedy([r[1] for r in mine], np.array([r[2] for r in mine], float), 5), 1)]
    assert got == want


def test_groups_without_label_and_small_ones(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((30, 4))
    rows = [(None, i, v.tolist()) for i, v in enumerate(x)] + [("few", 7, [1.0, 0.0, 0.0, 0.0]), ("few", 5, [0.0, 0.0, 0.0, 0.0])]
    v = spark.createDataFrame(rows, "g string, i int, embedding array<double>").repartition(5)
    got = {g: [] for g in (None, "few")}
    for row in P.mmr(v, "g", "i", k=4).orderBy("rank").collect():
        got[row["g"]].append(row["i"])
    assert got == {None: greedy(list(range(30)), x, 4), "few": [5, 7]}
