"""Steps whose shuffles, rows or lists grew faster than their input: results by hand, and what a plan may shuffle."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomdoc.functions import text as T
from loomdoc.operators import chunks as C
from loomdoc.operators import keywords as K
from loomdoc.operators import topics as P
from loomdoc.plans import catalogue


def shuffles(df) -> list[str]:
    """Exchanges of a plan, broadcasts aside."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return re.findall(r"\bExchange (\w+)", plan)


def test_keywords_are_counted_where_their_group_is(spark, data):
    """No token is a row of a shuffle: one of texts, where tokens were shuffled by text, by term and by group."""
    assert len(shuffles(catalogue.QUERIES["q07_tfidf_top10"](spark, data))) == 1
    assert len(shuffles(catalogue.QUERIES["q57_inherited_keywords"](spark, data))) == 1


def test_keywords_over_batches_and_repeated_places(spark):
    r = np.random.default_rng(3)
    rows = [(g, t, int(o), " ".join(f"w{int(x):02d}" for x in r.integers(0, 30, int(r.integers(0, 9))))) for g in (1, 2, None) for t in ("a", None) for o in r.integers(0, 40, 60)]
    df = spark.createDataFrame(rows, "g long, t string, o int, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {(x["g"], x["t"]): list(zip(x["keywords"], x["scores"], strict=True)) for x in K.tfidf_lists(df, ["g", "t"], "o", 5).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1024)
    for key in {x[:2] for x in rows}:
        mine = [(o, s.split()) for g, t, o, s in rows if (g, t) == key]
        n = sum(bool(w) for _, w in mine)
        tf = Counter(w for _, ws in mine for w in ws)
        score = {w: tf[w] * (math.log((n + 1) / (len({o for o, ws in mine if w in ws}) + 1)) + 1) for w in tf}
        want = sorted((round(-s, 9)) for s in score.values())[:5]
        assert [round(-s, 9) for _, s in got[key]] == want
        assert all(abs(score[w] - s) < 1e-9 for w, s in got[key])


def test_equal_keywords_stand_in_order_of_their_place(spark):
    df = spark.createDataFrame([(1, 1, "zzz bbb"), (1, 0, "yyy ccc"), (2, 0, "  "), (3, 0, None)], "d long, o int, text string")
    assert [(x["d"], x["term"], x["rank"]) for x in K.tfidf_top(df, ["d"], "o", 3).orderBy("d", "rank").collect()] == [(1, "yyy", 1), (1, "ccc", 2), (1, "zzz", 3)]


def test_hints_shuffle_texts_only(spark, data):
    """Chunks and topics meet by document: their vectors' places were rows of six shuffles."""
    assert len(shuffles(catalogue.QUERIES["q27_topic_hints"](spark, data))) <= 3


def test_hints_by_hand(spark):
    texts = [(1, 0, "alfa beta beta"), (1, 1, "gama"), (1, 2, ""), (2, 0, "delta alfa")]
    topics = [(1, 0, ["Alfa", "beta"]), (1, 1, ["gama-beta"]), (1, 5, ["--"]), (1, 7, []), (2, 3, ["x"]), (3, 0, ["y"])]
    found = spark.createDataFrame(texts, "doc_id long, chunk_seq int, text string").withColumn("tokens", T.words(F.col("text")))
    got = {(x["doc_id"], x["chunk_seq"], x["topic_id"]): x["affinity"] for x in P.hints(found, spark.createDataFrame(topics, "doc_id long, topic_id int, keywords array<string>"), k=4).collect()}

    def unit(text):
        n = Counter(text.split())
        size = math.sqrt(sum(v * v for v in n.values()))
        return {w: v / size for w, v in n.items()}

    for d, i, text in texts:
        for e, t, words in topics:
            if d == e:
                mean = Counter()
                for w in words:
                    mean.update(unit(re.sub("[^a-z]+", " ", w.lower())))
                size = math.sqrt(sum(v * v for v in mean.values()))
                cos = sum(v * mean.get(w, 0) for w, v in unit(text).items()) / size if size else 0
                a, b = set(text.split()), {w.lower() for w in words}
                near = len(a & b) / len(a | b) if a | b else 1
                assert got[d, i, t] == pytest.approx(0.7 * cos + 0.3 * near, abs=2e-6), (d, i, t)
    assert len(got) == 13


def test_chunks_and_their_scores_shuffle_a_text_once(spark, data):
    """Sentences were joined to the starts of chunks, and chunks dealt out again by document."""
    assert len(shuffles(catalogue.QUERIES["q15_chunk_jaccard_redundancy"](spark, data))) == 1
    assert len(shuffles(catalogue.QUERIES["q09_chunks_pack"](spark, data))) == 1


def test_white_space_and_words_as_the_expressions_say(spark):
    odd = ["", " ", " a　", "\x1c b\x85", "a\n", "\n\na b  ", "᠎x", None, "él está, THE end-of o2 ñu X_y", "andando and ands THE the_ a"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(odd)], "i int, x string")
    for lang, stop in (("en", T.STOP_EN), ("es", T.STOP_ES)):
        letters = T.WORD_LETTERS
        plain = F.regexp_extract_all(F.lower("x"), F.lit(rf"(?<![{letters}])(?!(?:{'|'.join(stop)})(?![{letters}]))[{letters}]+"), F.lit(0))
        r = df.select(T.strip(F.col("x")).eqNullSafe(F.regexp_replace("x", r"(?U)^\s+|\s+$", "")), T.filled(F.col("x")).eqNullSafe(F.regexp_replace("x", r"(?U)^\s+|\s+$", "") != ""), T.tokens(F.col("x"), F.lit(lang)).eqNullSafe(plain)).collect()
        assert all(all(x) for x in r), r


def test_metrics_of_a_large_group_keep_no_list_of_its_topics(spark):
    """Sizes and keywords of a group are counted, not gathered in one row."""
    t = spark.range(3000).select(F.lit(None).cast("string").alias("g"), F.col("id").alias("topic_id"), (F.col("id") % 7 + 1).alias("count"), F.array(F.concat(F.lit("k"), F.col("id").cast("string")), F.lit("same")).alias("keywords"))
    m = P.metrics(t, "g")
    assert "collect_list(keywords" not in m._jdf.queryExecution().optimizedPlan().toString()
    r, c = m.first(), [i % 7 + 1 for i in range(3000)]
    assert (r["n_topics"], r["size_p95"], r["size_median"], r["keywords_diversity"]) == (3000, 7.0, 4.0, round(3001 / 6000, 6))
    p = np.array(c) / sum(c)
    assert r["entropy_topics"] == pytest.approx(-(p * np.log(p)).sum() / math.log(3000), abs=1e-6)
    assert r["topic_balance"] == pytest.approx(1 - np.std(c) / np.mean(c), abs=1e-6)


@pytest.fixture
def written(monkeypatch):
    """Names and columns of the tables that selection writes between its steps."""
    from loomdoc.plans import selectqueries as Q

    seen, plain = [], Q.staged
    monkeypatch.setattr(Q, "staged", lambda df, name: seen.append(df.columns) or plain(df, name))
    return seen


@pytest.mark.parametrize(("name", "most"), [("q35_chunk_selection", 4), ("q56_evaluated_domains", 5), ("q34_doc_selection", 3), ("q36_explanations", 3), ("q31_topic_affinity", 1), ("q65_selection_summary", 4), ("q37_selector_quality", 5)])
def test_selection_meets_by_document_and_writes_no_text(spark, data, written, name, most):
    """Signals were joined by chunk and domain, a shuffle each, and texts and tokens of chunks written and read."""
    df = catalogue.QUERIES[name](spark, data)
    assert len(shuffles(df)) <= most
    assert len(written) == 1 and not {"text", "tokens", "x"} & set(written[0])


def test_context_scores_and_run_statistics_shuffle_a_text_once(spark, data, written):
    assert len(shuffles(catalogue.QUERIES["q32_context_score"](spark, data))) == 2 and not written  # texts, then scores
    plan = catalogue.QUERIES["q52_chunk_run_stats"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "loomdoc-" not in plan and len(re.findall(r"\bExchange (\w+)", plan.split("== Initial Plan ==")[-1])) == 3


def test_cohesion_of_sentences_by_hand(spark):
    s = spark.createDataFrame([(1, "en", 0, 1, 0, i, i + 1, x) for i, x in enumerate(["red fox runs.", "fox runs home.", "sky."])] + [(2, "en", 0, 1, 0, 0, 1, "alone here.")], "doc_id long, lang string, section_no int, page_number int, block_idx int, sent_idx int, k int, sentence string")
    want = {1: 0.25, 2: 1.0}  # 2 of 4 words, then none
    assert {x["doc_id"]: x["intra_cohesion_lex"] for x in C.intra_cohesion(C.packed(s)).collect()} == want
    assert {x["doc_id"]: x["intra_cohesion_lex"] for x in C.cohesive(C.groups(s)).collect()} == want
    assert C.packed(s).columns == [*s.columns, "order_in_section", "chunk_seq"]


def test_document_signals_equal_affinity_and_products(spark):
    from loomdoc.operators import ontology as O
    from loomdoc.operators import select as X

    rows = [(1, 0, ["the", "Un"], "the des und"), (1, 1, [], "que"), (2, 0, [], ""), (3, 0, ["Und", "die"], "die the the")]
    found = spark.createDataFrame(rows, "doc_id long, chunk_seq int, keywords array<string>, text string").withColumns({"tokens": T.words(F.col("text")), "char_len": F.length("text"), "lexical_density": F.lit(1.0), "type_token_ratio": F.lit(0.5), "n_tokens": F.size(T.words(F.col("text")))})
    vectors = O.registry_vectors(spark, O.SAMPLE)
    chunks = C.scores(found, "doc_length", "lexical_density", "type_token_ratio", "n_tokens", "keywords", registry=vectors).withColumn("kw", T.unique_sorted(F.col("keywords")))
    got = {x["doc_id"]: x for x in X.document_signals(spark, O.SAMPLE, chunks).collect()}
    topics = found.where("chunk_seq = 0").select("doc_id", "keywords", F.lit(0.0).alias("prob"))
    names = [d.name for d in O.SAMPLE.domains]
    for x in X.topic_affinity(spark, O.SAMPLE, chunks, topics).collect():
        assert got[x["doc_id"]]["ts"][names.index(x["domain"])] == pytest.approx(x["t"], abs=1e-12)
    lengths = C.likeness(found).groupBy("doc_id").agg(F.first("doc_length").alias("doc_length"))
    e = {(x["doc_id"], x["domain"]): x["e"] for x in X.embedding_scores(spark, O.SAMPLE, found, ["doc_id"], lengths).collect()}
    for d, x in got.items():
        assert [e.get((d, n), 0.0) for n in names] == pytest.approx(x["es"], abs=1e-12)
    own = {(x["doc_id"], x["chunk_seq"], x["domain"]): x["e"] for x in X.embedding_scores(spark, O.SAMPLE, found, ["doc_id", "chunk_seq"]).collect()}
    for x in C.products(found.select("doc_id", "chunk_seq", "text"), vectors).collect():
        assert [own.get((x["doc_id"], x["chunk_seq"], n), 0.0) for n in names] == pytest.approx(x["dots"], abs=1e-12)
    assert got[1]["n_tokens"] == 4 and got[2]["es"] == [0.0] * len(names)


def test_layout_of_a_long_page_in_linear_time(spark):
    """A page's line numbers were copied for every word of it."""
    import time

    from loomdoc.operators import blocks as B

    n = 120_000
    w = spark.range(n).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page_number"), F.col("id").alias("seq"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("text"), (F.floor(F.col("id") / 6) * 12 + F.col("id") % 3).cast("double").alias("top")).withColumn("bottom", F.col("top") + 10)
    began = time.time()
    r = B.layout_lines(w).orderBy(F.desc("line")).limit(2).collect()
    assert time.time() - began < 60
    assert [(x["line"], x["text"]) for x in r][0] == (n // 6 - 1, " ".join(f"w{i}" for i in range(n - 6, n)))


def test_tokens_of_a_documents_chunks_meet_as_lists(spark, data):
    """Every token of a document was a row of two shuffles."""
    assert len(shuffles(catalogue.QUERIES["q54_entities_of_chunks"](spark, data))) <= 4
    from loomdoc.operators import select as X

    words = spark.createDataFrame([(1, ["b", "z"]), (3, ["q"])], "doc_id long, keywords array<string>")
    chunks = spark.createDataFrame([(1, "A b"), (1, "b c"), (2, "d")], "doc_id long, text string")
    assert {x["doc_id"]: sorted(x["tokens"]) for x in X.text_and_keywords(words, chunks).collect()} == {1: ["a", "b", "c", "z"], 2: ["d"], 3: ["q"]}


def test_density_links_join_what_all_pairs_join(spark):
    """Points as one component by then are not compared; blocks of a document are no more than thirty-two, unless they hold too many points."""
    r = np.random.default_rng(11)
    x = np.concatenate([r.standard_normal((500, 6)), r.standard_normal((8, 6)).repeat(30, axis=0) + 0.05 * r.standard_normal((240, 6)), np.zeros((3, 6))])
    u = np.divide(x, np.linalg.norm(x, axis=1, keepdims=True), out=np.zeros_like(x), where=x.any(axis=1, keepdims=True))
    for eps in (0.6, 0.1, 0.01):
        near = 1 - u @ u.T <= eps
        label = np.arange(len(x))
        while not np.array_equal(least := np.where(near, label[None, :], len(x)).min(axis=1, where=near, initial=len(x)).clip(max=label), label):
            label = least
        for own, other in ((np.arange(len(x)), None), (np.arange(400), np.arange(400, len(x)))):
            root = np.arange(len(x))
            parts = P._joined(u, None, own, own, P._least(eps), tile=64) if other is None else P._joined(u[:400], None, own, own, P._least(eps), tile=64) + P._joined(u[400:], None, own := np.arange(len(x) - 400), own, P._least(eps), 64)
            if other is not None:
                first = len(P._joined(u[:400], None, np.arange(400), np.arange(400), P._least(eps), tile=64))
                parts = parts[:first] + [(a + 400, b + 400) for a, b in parts[first:]] + P._joined(u[:400], u[400:], np.arange(400), np.arange(400, len(x)), P._least(eps), tile=64)
            assert all(near[a, b] or label[a] == label[b] for a, b in parts)
            for a, b in parts * 30:
                root[[a, b]] = min(root[a], root[b])
            for _ in range(len(x)):
                before = root.copy()
                for a, b in parts:
                    root[[a, b]] = min(root[a], root[b])
                if np.array_equal(before, root):
                    break
            assert np.array_equal(root, label)


def test_blocks_of_points_grow_in_size_not_in_number(spark):
    p = spark.range(4000).select(F.lit(None).cast("string").alias("_d"), F.col("id").alias("_id"))
    assert P._dealt(p, 10, P.LINKED).agg(F.max("g")).first()[0] == 32  # was 400
    assert P._dealt(p, 10, 50).agg(F.max("g")).first()[0] == 80
    assert P._dealt(p.limit(5), 10, 50).agg(F.max("g")).first()[0] == 1


def test_unit_vectors_take_their_length_once(spark):
    assert spark.sql("SELECT array(3.0D, 4.0D) a UNION ALL SELECT array(0.0D) UNION ALL SELECT NULL").select(T.unit(F.col("a")).alias("u")).collect() == [([0.6, 0.8],), ([0.0],), (None,)]
    plan = spark.range(1).select(F.array(F.col("id"), F.col("id")).alias("a")).select(T.unit(F.col("a")).alias("u"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT") == 1


def test_reasons_are_told_for_the_first_domain_only(spark, data):
    """They were made for every chunk and domain, and q35 does not ask for them."""
    q35, q36 = (catalogue.QUERIES[x](spark, data)._jdf.queryExecution().optimizedPlan().toString() for x in ("q35_chunk_selection", "q36_explanations"))
    assert "format_string" not in q35 and "format_string" in q36
    r = spark.sql("SELECT 'Ab ñu-3 x_y  ÉL' a UNION ALL SELECT '' UNION ALL SELECT NULL").select(T.selector_token_count(F.col("a")).alias("n"), F.size(T.selector_tokens(F.coalesce("a", F.lit("")))).alias("m")).collect()
    assert [(x["n"], x["m"]) for x in r] == [(6, 6), (0, 0), (None, 0)]
