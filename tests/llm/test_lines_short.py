from conftest import *  # noqa: F403

from loomdoc.llm import lines, queries


def test_short_lines_in_the_query(spark, data, docs):
    """Every line with a word has a row; a short one stays where it stands first; rows of five words or more are those of before."""
    got = {(r["doc_id"], r["line"]): r for r in queries.QUERIES["op9_line_dedup"](spark, data).collect()}
    rows = docs.select("doc_id", "text").collect()
    found = sorted((r["doc_id"], n, tuple(words(x))) for r in rows for n, x in enumerate((r["text"] or "").split("\n")) if words(x))  # noqa: F405
    assert set(got) == {p[:2] for p in found}
    first, copies = {}, 0
    for i, n, w in found:
        if len(w) < lines.MIN_WORDS:
            at = first.setdefault(w, (i, n))
            copies += at != (i, n)
            r = got[i, n]
            assert (r["n_words"], r["kept"], r["of_doc"], r["of_line"]) == (len(w), at == (i, n), *at)
    assert copies > 0
    for r in lines.decide(docs).collect():
        x = got[r["doc_id"], r["line"]]
        assert (x["kept"], x["of_doc"], x["of_line"]) == (r["kept"], r["doc_id"] if r["of_doc"] is None else r["of_doc"], r["line"] if r["of_line"] is None else r["of_line"])


def test_short_copies_go(spark):
    rows = [(1, "les rech.\none two three four\nonly here"), (2, "Les  rech.\nmore\none two three"), (3, "les rech.")]
    out = lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {1: rows[0][1], 2: "more\none two three"}  # near short lines stay


def test_stage_drops_what_the_decisions_say(spark, docs):
    gone = {(r["doc_id"], r["line"]) for r in lines.decide(docs, 1).where("NOT kept").collect()}
    want = {}
    for r in docs.select("doc_id", "text").collect():
        left = "\n".join(x for n, x in enumerate(r["text"].split("\n")) if (r["doc_id"], n) not in gone)
        if words(left) or not words(r["text"]):  # noqa: F405
            want[r["doc_id"]] = left
    assert {r["doc_id"]: r["text"] for r in lines.dedup(docs).collect()} == want


def test_rows_of_one_id(spark):
    """Rows that share an id, or have none, keep their own lines; of equal lines at one number in two texts one stays."""
    a, b = "first line of the one text\nsame line in both of them\nmore of it here at last", "quite another line in this text\nsame line in both of them\nand then something else again"
    for i in (None, 7):
        out = lines.dedup(spark.createDataFrame([(i, a), (i, b), (8, "more of it here at last")], "doc_id long, text string"))
        got = [r["text"] for r in out.collect()]
        assert len(got) == 2 and sum("same line" in t for t in got) == 1
        assert sum("quite another" in t and "something else" in t for t in got) == 1
        assert sum("first line" in t and "more of it" in t for t in got) == 1


def test_chain(spark):
    """Of lines each one word off the line before only the first stays, though the last differs from it in four words."""
    rows = [(i, " ".join(["new"] * i + "one two three four five six".split()[i:])) for i in range(5)]
    assert {r["doc_id"] for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}
