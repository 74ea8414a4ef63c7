import hashlib
import re

from conftest import *  # noqa: F403

from loomdoc.llm import decontaminate as D
from loomdoc.llm import queries

RX = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = RX.findall(low(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w = RX.findall(low(t))
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := wins.get(tuple(w[k : k + n]))) is not None:
                    found |= x
                    hit[k : k + n] = [1] * n
        h = sum(hit)
        out.append((i, len(w), h, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), h > 0 and 20 * h >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(spark, data):
    t = {n: [tuple(r) for r in spark.read.parquet(f"{data}/{n}.parquet").select(k, "text").collect()] for n, k in (("documents", "doc_id"), ("benchmark", "item_id"))}
    assert got(queries.QUERIES["op2_decontaminate"](spark, data)) == brute(t["documents"], t["benchmark"])


def test_short_items_blocks_and_edges(spark, edge, clashing, empty):
    items = [(1, "Quick, BROWN fox"), (2, "lazy"), (3, None), (None, "the river at noon"), (4, "..."), (5, BASE), (6, BASE + " again"), (7, "word " * 20), (8, "línea één"), (2, "stone bridge")]  # noqa: F405
    b = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r[0], r[1]) for r in EDGE]  # noqa: F405
    want = brute(docs, items)
    assert got(D.report(edge, b)) == want
    assert got(D.report(clashing, b)) == want
    assert got(D.report(empty, b)) == []
    assert got(D.report(edge, b.limit(0))) == brute(docs, [])
    many = D.scan(edge.select("doc_id", "text"), b, block_bytes=10)  # every item its own block
    one = D.scan(edge.select("doc_id", "text"), b)
    assert got(many) == got(one)


def test_equal_items(spark):
    """Windows that many items hold are one pattern; every item is told."""
    one = " ".join(f"w{i}" for i in range(14))
    items = [(i, one) for i in range(300)] + [(1000, "other words " + one)]
    docs = [(1, f"x {one} y {one}"), (2, "w0 w1 w2"), (3, "a " + " ".join(f"w{i}" for i in range(13)))]
    b = spark.createDataFrame(items, "item_id long, text string")
    assert got(D.report(spark.createDataFrame(docs, "doc_id long, text string"), b)) == brute(docs, items)
    import numpy as np

    (p,) = D.patterns([one] * 300)
    assert len(p.starts) == 2 and all(np.array_equal(x, np.arange(300)) for x in p.items)


def test_clean_drops_a_passage_in_a_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(13))
    long = " ".join(f"w{i}" for i in range(20000))
    df = spark.createDataFrame([(1, long), (2, f"{long} {passage} {long}"), (3, " ".join(f"p{i}" for i in range(12)))], "doc_id long, text string")
    kept = D.clean(df, spark.createDataFrame([(1, passage + " more")], "item_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {1, 3}


def test_clean_keeps_rows(spark, clashing):
    b = spark.createDataFrame([(1, BASE)], "item_id long, text string")  # noqa: F405
    kept = D.clean(clashing, b)
    assert kept.columns == clashing.columns
    assert {r["doc_id"] for r in kept.collect()} == {4, 5, 6, 7, 8, 9, 10, 11, 12, None}
    assert kept.count() == 10
