import math
import zlib
from collections import Counter

import numpy as np
from conftest import *  # noqa: F403

from loomdoc.llm import attention, lm, queries


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def check(got, rows):
    counts = Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*words(t), None])  # noqa: F405
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in [*words(t), None]), 4)) for i, t in rows), key=str)  # noqa: F405
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 4)) for r in got), key=str) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_query_beats_or_nears_the_word_model(spark, data):
    data = data.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = queries.QUERIES["op8_lm_score"](spark, data).collect()
    check(got, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    mean = lambda c: sum(r[c] for r in got if r["held_out"]) / sum(r["n_tokens"] for r in got if r["held_out"])
    assert mean("score") > 1.04 * mean("base_score")  # from 1,000 documents; from 10,000 on it is ahead


def test_edge_cases(spark, edge, clashing, empty, monkeypatch):
    rows = [(r[0], r[1]) for r in EDGE]  # noqa: F405
    check(lm.score(edge).collect(), rows)
    monkeypatch.setattr(lm, "FREQUENT", 3)  # most words then come by join
    got = lm.score(clashing).collect()
    check(got, rows)
    same = [r["score"] for r in got if r["doc_id"] == 3]
    assert len(same) == 2 and abs(same[0] - same[1]) < 1e-5
    assert lm.score(empty).count() == 0


def small():
    r = np.random.default_rng(0)
    first = np.log(r.dirichlet(np.ones(4), 17))
    then = np.log(r.dirichlet(np.ones(4), 17 * 4)).reshape(17, 16)
    return r, attention.Model(first, then)


def test_windows_score_each_place_once():
    r, _ = small()
    n = np.array([1, 5, 16, 17, 40, 100])
    bounds = np.concatenate([[0], np.cumsum(n)])
    x, t = np.arange(bounds[-1]), np.arange(bounds[-1])
    units, valid, target, places = attention.windows(x, t, bounds)
    assert sorted(places[places >= 0].tolist()) == t.tolist()
    for u, v, p in zip(units, valid, places, strict=True):
        real = p[p >= 0]
        doc = np.searchsorted(bounds, real[0], "right") - 1
        assert (u[v] >= bounds[doc]).all() and (u[v] < bounds[doc + 1]).all()
        assert (u[attention.OVERLAP :][p >= 0] == real).all()
        assert v[: attention.OVERLAP].sum() == min(attention.OVERLAP, real[0] - bounds[doc])


def test_probabilities_sum_to_one_and_look_back_only():
    r, m = small()
    x = r.integers(0, 17, (2, attention.SPAN))
    valid = np.ones_like(x, bool)
    valid[1, :5] = False
    tables = m.tables()
    p = sum(np.exp(m.logprob(x, valid, np.full((2, attention.STEP), c), tables)) for c in range(16))
    assert np.allclose(p, 1, atol=1e-4)
    t = r.integers(0, 16, (2, attention.STEP))
    before = m.logprob(x, valid, t, tables)
    later = x.copy()
    later[:, attention.OVERLAP + 9 :] = 3
    assert np.allclose(m.logprob(later, valid, t, tables)[:, :9], before[:, :9], atol=1e-5)
    hidden = x.copy()
    hidden[1, :5] = 0  # units that are not valid do not count
    assert np.allclose(m.logprob(hidden, valid, t, tables)[1], before[1], atol=1e-5)


def test_gradients_are_those_of_the_loss():
    r, m = small()
    x, t = r.integers(0, 17, (3, attention.SPAN)), r.integers(0, 16, (3, attention.STEP))
    valid, scored = np.ones_like(x, bool), np.ones_like(t, bool)
    for k in m.p:
        m.p[k] = m.p[k].astype(np.float64)
    loss, g = m.gradients(x, valid, t, scored)
    assert abs(loss + m.logprob(x, valid, t, m.tables()).mean()) < 1e-4
    for k, v in m.p.items():
        i = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        old, h = v[i], 1e-3
        v[i] = old + h
        up = m.gradients(x, valid, t, scored)[0]
        v[i] = old - h
        down = m.gradients(x, valid, t, scored)[0]
        v[i] = old
        assert abs((up - down) / (2 * h) - g[k][i]) < 0.02 * abs(g[k][i]) + 1e-4, k


def test_training_lowers_the_loss():
    r, m = small()
    seq = np.tile([1, 2, 3, 4, 5, 6, 7], 600)
    w = attention.windows(seq[:-1], seq[1:], np.array([0, 2000, len(seq) - 1]))
    losses = m.fit([(w[0][i : i + 32], w[1][i : i + 32], w[2][i : i + 32], w[3][i : i + 32] >= 0) for _ in range(40) for i in range(0, len(w[0]), 32)], rate=0.02)
    assert losses[-1] < 0.3 * losses[0]
