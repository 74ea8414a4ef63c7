from conftest import *  # noqa: F403

from loomdoc.llm import lines


def brute(rows, min_words=5):
    """(doc_id, line) -> (kept, of) by comparing all different lines."""
    found = [((i, n), tuple(words(x))) for i, t in rows for n, x in enumerate((t or "").split("\n")) if len(words(x)) >= min_words]  # noqa: F405
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    first = {}
    for p, w in found:
        first[w] = min(first.get(w, p), p, key=order)
    near = {}
    for w, p in first.items():
        before = [q for v, q in first.items() if order(q) < order(p) and lines.near(list(v), list(w))]
        if before:
            near[w] = min(before, key=order)
    return {p: (first[w] == p and w not in near, first[w] if first[w] != p else near.get(w, (None, None))) for p, w in found}


def check(table, rows):
    got = lines.decide(table).collect()
    want = brute(rows)
    assert {(r["doc_id"], r["line"]) for r in got} == set(want)
    for r in got:
        assert (r["kept"], (r["of_doc"], r["of_line"])) == want[r["doc_id"], r["line"]]


def test_against_all_pairs(docs):
    check(docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_edits(spark):
    a = "one two three four five six"
    texts = [a, a.upper(), "one two three four five", "one two nine four five six", "zero " + a, a + " seven eight", "two three four five six seven", "one one two three four five six", "one two three four six five", "one two three four", "a a a a a", "a a a a a a", "b b b b b\n" + a]
    rows = list(enumerate(texts))
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert lines.near([1, 2, 3], [1, 3]) and lines.near([1, 2], [1, 2]) and lines.near([1], []) and lines.near([1, 2, 3], [1, 9, 3])
    assert not lines.near([1, 2, 3], [1]) and not lines.near([1, 2], [2, 1]) and not lines.near([1, 2, 3], [2, 3, 4])


def test_edge_cases(edge, clashing, empty):
    rows = [(r[0], r[1]) for r in EDGE]  # noqa: F405
    for table in (edge, clashing):
        check(table, rows)
    assert lines.decide(empty).count() == 0
    assert lines.dedup(empty).count() == 0
    out = lines.dedup(clashing)
    assert out.columns == clashing.columns
    text = {r["doc_id"]: r["text"] for r in out.collect()}
    assert text[4] is None and text[5] == "" and text[6] == " \t\n "  # as they were
    assert text[11] == "línea één\nSecond line of the text stands here\n"
    assert text[12] == "a b c d e f"  # its second line is one word off
    assert 2 not in text and 1 not in text  # their only line stands first in the row without an id
    assert text[None] is not None
