import itertools

import pytest
from conftest import *  # noqa: F403

from loomdoc.llm import graph, jaccard, queries


def brute(rows, k, num, den):
    """doc_id -> (sizes, component) by comparing all pairs; rows of one id are one node."""
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, k))  # noqa: F405
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (1, 50)])
def test_against_all_pairs(docs, k, num):
    got = jaccard.classes(docs, k, num, 100).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want, texts = brute(rows, k, num, 100), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["n_shingles"] == len(shingles(texts[r["doc_id"]], k))  # noqa: F405
        assert r["component_id"] == want[r["doc_id"]]


def test_edge_cases(edge, clashing, empty):
    want = brute([(r[0], r[1]) for r in EDGE], 5, 80, 100)  # noqa: F405
    for table in (edge, clashing):
        got = jaccard.classes(table).collect()
        assert len(got) == len(EDGE)  # noqa: F405
        for r in got:
            if r["doc_id"] is not None:
                assert r["component_id"] == want[r["doc_id"]]
        without = sorted((r["component_id"] for r in got if r["doc_id"] is None), key=str)
        assert without == [1, None]  # the copy's class, and none
    assert jaccard.classes(empty).count() == 0
    kept = jaccard.keep_one(clashing)
    assert kept.columns == clashing.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 3 not in ids and 2 not in ids and 1 in ids and {4, 5, 6} <= set(ids)
    gone = [r for r in EDGE if r[0] in (2, 3) or (r[0] is None and r[1] == BASE)]  # noqa: F405
    assert len(ids) == len(EDGE) - len(gone) and ids.count(None) == 1  # noqa: F405


def test_one_rule_for_repeats(spark):
    """Equal rows lose their repeats whatever else the table holds; different texts of one id stay both."""
    wordless = [(4, None), (4, None), (5, " "), (5, " "), (6, ""), (6, "\t")]
    for more in ([], [(1, BASE)], [(1, BASE), (1, BASE)], [(None, BASE), (None, BASE)]):  # noqa: F405
        df = spark.createDataFrame(wordless + more, "doc_id long, text string")
        got = sorted(((r["doc_id"], r["text"]) for r in jaccard.keep_one(df).collect()), key=str)
        assert got == sorted(set(wordless + more), key=str)


def test_a_leader_of_many_cells(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL", 7)
    rows = [(500 + i, " ".join(f"x{i}" if j == i % 60 else f"h{j}" for j in range(60))) for i in range(80)] + [(900, " ".join(f"h{j}" for j in range(60)))]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert {r["component_id"] for r in got} == {500}


def test_groups_of_near_copies(spark):
    """Copies edited in different places: neighbours link, ends do not; chains and hubs keep their classes."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):  # a chain: each differs from the last by one word
        rows.append((100 + i, " ".join([*(f"e{j}" for j in range(i)), *base[i:]])))
    for i in range(80):  # a hub's copies, one word changed in each
        w = [f"h{j}" for j in range(60)]
        w[i % 60] = f"x{i}"
        rows.append((500 + i, " ".join(w)))
    rows.append((900, " ".join(f"h{j}" for j in range(60))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, num in ((3, 90), (3, 85), (2, 93)):
        want = brute(rows, k, num, 100)
        assert {r["doc_id"]: r["component_id"] for r in jaccard.classes(df, k, num, 100).collect()} == want


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, x) for x in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(31)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query(spark, data):
    assert queries.QUERIES["op4_ngram_jaccard"](spark, data).columns == ["doc_id", "n_shingles", "component_id"]
