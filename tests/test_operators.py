"""Branches that the tables do not reach, on rows made by hand, and properties."""

import io
import re
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomdoc.functions import text as T
from loomdoc.operators import blocks as B
from loomdoc.operators import chunks as C
from loomdoc.operators import keywords as K
from loomdoc.operators import ontology as O
from loomdoc.operators import select as X
from loomdoc.operators import topics as P
from loomdoc.plans import engine
from loomdoc.sources import cache, files
from loomdoc.streaming import documents as S


def docs(spark, *texts, lang="es"):
    return spark.createDataFrame([(i, t, lang) for i, t in enumerate(texts)], "doc_id long, text string, lang string")


def values(spark, f, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("t"))).collect()]


def test_headings(spark):
    assert values(spark, T.is_section_heading, "Resumen", "Métodos y datos", "- item uno", "Resumen\nsegunda línea", "Abstract " + "x" * 180, "texto a.", "• x") == [True, True, True, False, False, False, True]
    assert values(spark, T.looks_like_heading, "ANNUAL REPORT 2024", "ANNUAL REPORT:", "Ab", "abC", "A" * 81, "2024") == [True, False, True, False, False, False]
    assert values(spark, T.docx_heading_level, "Heading 3", "heading", "Normal", "Heading7") == [3, 1, None, 1]


def test_sections_and_numbers(spark):
    d = docs(spark, "antes.\nResumen\ntexto a.\nMétodos y datos\ntexto b.\n- item uno", "Resumen\nuno.", "sin nada.")
    s = C.sections(B.blocks(d))
    got = {(r["doc_id"], r["block_idx"]): r["section_no"] for r in s.collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (0, 2): 1, (0, 3): 2, (0, 4): 2, (0, 5): 3, (1, 0): 0, (1, 1): 0, (2, 0): 0}
    c = C.chunks(C.packed(C.sentences(s))).where("doc_id = 0").orderBy("chunk_seq").collect()
    assert [(r["order_in_section"], r["chunk_seq"]) for r in c] == [(0, 0), (0, 1), (0, 2), (0, 3)]
    assert [r["text"] for r in c][1] == "Resumen texto a."
    assert C.sections(B.blocks(d), prefer_headings=False).agg(F.max("section_no")).first()[0] == 0


def test_list_items_types_and_merge(spark):
    d = docs(spark, "• alpha\n– beta\n* gamma\nANNUAL REPORT 2024\nplain text.", "Uno dos\ntres.\nCuatro\n\ncinco")
    got = [(r["type"], r["text"]) for r in B.typed(B.blocks(d)).where("doc_id = 0").orderBy("block_idx").collect()]
    assert got == [("list_item", "alpha"), ("list_item", "beta"), ("list_item", "gamma"), ("heading", "ANNUAL REPORT 2024"), ("paragraph", "plain text.")]
    p = [(r["text"], r["source_lines"]) for r in B.paragraphs(B.lines(d)).where("doc_id = 1").orderBy("paragraph").collect()]
    assert p == [("Uno dos tres.", [0, 1]), ("Cuatro", [2]), ("cinco", [4])]


def test_text_normalizers(spark):
    assert values(spark, T.normalized_text, "infor-\nmación", "a  b\r\n c ") == ["información", "a b c"]
    assert values(spark, T.sentences, "sin punto\n\notra parte", "A b. C? D! e.f") == [["sin punto", "otra parte"], ["A b.", "C?", "D!", "e.f"]]
    assert values(spark, T.folded, "Ñandú, 3 ÁRBOLES ß!") == ["nandu arboles"]
    assert values(spark, T.topic_text, "• uno  “dos”", "12) ‘tres’") == ['uno "dos"', "'tres'"]
    assert values(spark, T.mime_type, "a/b.PDF", "x.docx", "noext", "d.ir/file") == ["application/pdf", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/octet-stream", "application/octet-stream"]
    assert values(spark, lambda c: T.shorten(c, 5), "abcdef", "abc") == ["ab...", "abc"]
    assert re.fullmatch("DOC-[0-9A-F]{12}", values(spark, T.document_id, "p")[0])


def test_jaccard_and_cosine(spark):
    df = spark.sql("SELECT array('a') a, cast(array() AS array<string>) e, array(0.0D, 0.0D) z, array(1.0D, 0.0D) x")
    r = df.select(T.jaccard(F.col("e"), F.col("e")), T.jaccard(F.col("a"), F.col("e")), T.jaccard(F.col("e"), F.col("e"), 0.0), T.jaccard(F.col("a"), F.col("a")), T.cosine(F.col("z"), F.col("x")), T.cosine(F.col("x"), F.col("x"))).first()
    assert tuple(r) == (1.0, 0.0, 0.0, 1.0, 0.0, 1.0)


def test_giant_sentence_is_alone(spark):
    d = docs(spark, "Una corta. " + "x" * 9001 + ". Otra corta.")
    assert [r["n_sentences"] for r in C.chunks(C.packed(C.sentences(C.sections(B.blocks(d))))).orderBy("chunk_seq").collect()] == [1, 1, 1]


def model(lengths, max_tokens, max_chars):
    out, buf = [], []
    for n in lengths:
        if n > max_chars:
            out += [buf] if buf else []
            out.append([n])
            buf = []
            continue
        joined = sum(buf) + len(buf) + n
        if buf and (sum(buf) + n > max_chars or max(1, joined // 4) > max_tokens):
            out.append(buf)
            buf = []
        buf.append(n)
    return out + ([buf] if buf else [])


@given(st.lists(st.integers(3, 60), min_size=1, max_size=25), st.integers(1, 30), st.integers(10, 80))
@settings(max_examples=25, deadline=None)
def test_packing_against_a_plain_model(spark, lengths, max_tokens, max_chars):
    s = spark.createDataFrame([(1, "es", 0, 1, 0, i, i + 1, "x" * n) for i, n in enumerate(lengths)], "doc_id long, lang string, section_no int, page_number int, block_idx int, sent_idx int, k int, sentence string")
    got = C.packed(s, max_tokens, max_chars).orderBy("k").collect()
    groups = {}
    for r in got:
        groups.setdefault(r["chunk_seq"], []).append(len(r["sentence"]))
    assert list(groups.values()) == model(lengths, max_tokens, max_chars)


def test_single_chunk_scores(spark):
    c = C.chunks(C.packed(C.sentences(C.sections(B.blocks(docs(spark, "un texto breve con palabras distintas."))))))
    r = C.scores(c).first()
    assert (r["redundancy_cos_max"], r["redundancy_jaccard_max"], r["novelty"], r["cohesion_vs_doc"]) == (0.0, 0.0, 1.0, 1.0)
    assert C.scores(c.limit(0)).count() == 0


def test_tables_and_ocr(spark):
    t = spark.createDataFrame([(1, 0, [["a", "b ", None], ["c", "d", "e"]]), (1, 1, [])], "doc_id long, table_idx int, rows array<array<string>>")
    cells = B.cells(t)
    assert cells.count() == 6
    assert {(r["table_idx"], r["n_rows"], r["n_cols"]) for r in B.shapes(t, cells).collect()} == {(0, 2, 3), (1, 0, 0)}
    w = spark.createDataFrame([(1, 1, "a", "90"), (1, 1, "b", "-1"), (1, 1, "", "50"), (1, 1, "c", "x")], "doc_id long, page_number int, text string, conf string")
    assert B.ocr_confidence(w).first()["confidence"] == pytest.approx(0.445)
    kinds = spark.createDataFrame([(1, "unknown"), (1, "table"), (2, "paragraph")], "doc_id long, type string")
    golden = spark.createDataFrame([(1, 2)], "doc_id long, expected long")
    assert {(r["doc_id"], r["layout_loss"], r["ratio"]) for r in B.parse_metrics(kinds, golden).collect()} == {(1, 0.5, 0.5), (2, 0.0, 1.0)}
    assert B.percent_ok(spark.createDataFrame([(1, True), (2, False)], "doc_id long, ok boolean")).first()[0] == 50.0
    pages = spark.createDataFrame([(1, 1), (1, 2)], "doc_id long, page_number int")
    assert B.without_blocks(pages, pages.where("page_number = 1")).collect()[0]["page_number"] == 2


def test_layout_merge(spark):
    rows = [(1, 1, i, t, y, y + 10.0) for i, (t, y) in enumerate([("Uno", 0.0), ("dos", 1.0), ("tres", 12.0), ("cuatro.", 12.5), ("Cinco", 24.0), ("seis", 60.0)])]
    w = spark.createDataFrame(rows, "doc_id long, page_number int, seq int, text string, top double, bottom double")
    lines = B.layout_lines(w)
    assert [r["text"] for r in lines.orderBy("line").collect()] == ["Uno dos", "tres cuatro.", "Cinco", "seis"]
    assert [r["text"] for r in B.layout_paragraphs(lines).orderBy("paragraph").collect()] == ["Uno dos tres cuatro.", "Cinco", "seis"]


def test_spans_over_pages(spark):
    s = spark.createDataFrame([(1, "es", 0, p, b, 0, k + 1, "una frase.") for k, (p, b) in enumerate([(1, 0), (1, 0), (1, 2), (2, 0), (1, 5)])], "doc_id long, lang string, section_no int, page_number int, block_idx int, sent_idx int, k int, sentence string")
    spans = C.source_spans(C.packed(s)).first()["source_spans"]
    assert [(x["page_number"], x["block_indices"]) for x in spans] == [(1, [0, 2]), (2, [0]), (1, [5])]


def test_fusion_and_topics(spark):
    df = spark.sql("SELECT array('Uno', 'dos', ' uno ') a, array('tres', '', 'DOS') b")
    assert df.select(K.fused(F.col("a"), F.col("b"), 3)).first()[0] == ["uno", "dos", "tres"]
    labels = spark.createDataFrame([(1, i, -1) for i in range(2)], "doc_id long, block_idx int, label int")
    texts = spark.createDataFrame([(1, 0, "alfa beta"), (1, 1, "alfa gama")], "doc_id long, block_idx int, text string")
    r = P.topic_items(texts, labels).collect()
    assert [(x["topic_id"], x["count"], x["keywords"][0]) for x in r] == [(0, 2, "alfa")]
    topics = spark.createDataFrame([(1, i, [f"k{i}"]) for i in range(3)], "doc_id long, topic_id int, keywords array<string>")
    found = P.topic_of(spark.createDataFrame([(1, -1), (1, 4)], "doc_id long, label int"), topics)
    assert {r["label"]: r["keywords"] for r in found.collect()} == {-1: ["k2"], 4: ["k1"]}
    sizes = spark.createDataFrame([("g", i, i + 1, ["a", "a"]) for i in range(10)], "g string, topic_id int, count long, keywords array<string>")
    m = P.metrics(sizes, "g").first()
    assert (m["size_p95"], m["size_median"], m["redundancy_score"], m["coverage"]) == (9.0, 5.5, 0.5, 1.0)
    one = P.metrics(sizes.where("topic_id = 0"), "g").first()
    assert (one["entropy_topics"], one["topic_balance"]) == (0.0, 0.0)


def test_dbscan_and_mmr(spark):
    x = np.array([[1, 0], [1, 0.1], [0, 1], [0.1, 1], [-1, -1], [0, 0]], float)
    assert P._dbscan(x, 0.1, 2).tolist() == [0, 0, 1, 1, -1, -1]
    order = np.array([3, 4, 1, 0, 5, 2])
    again = P._dbscan(x[order], 0.1, 2)
    assert {frozenset(order[again == c].tolist()) for c in set(again.tolist()) - {-1}} == {frozenset({0, 1}), frozenset({2, 3})}
    assert P._dbscan(x[:0], 0.1, 2).tolist() == []
    v = spark.createDataFrame([("g", i, r.tolist()) for i, r in enumerate(x[:4])], "g string, i int, embedding array<double>")
    pick = lambda k: [r["i"] for r in P.mmr(v, "g", "i", k=k).orderBy("rank").collect()]
    assert pick(4) == [0, 1, 2, 3] and len(set(pick(2))) == 2 and {p // 2 for p in pick(2)} == {0, 1}


def test_registry(spark):
    assert [d.name for d in O.DEFAULT.domains][0] == "medical" and len(O.DEFAULT.domains) == 9
    assert [len(d.aliases) for d in O.DEFAULT.domains] == [28, 23, 39, 21, 13, 12, 18, 14, 8]
    assert O.DEFAULT.get("LEGAL").schema_name == "legal_contract_v1" and O.DEFAULT.get("none") is None
    with pytest.raises(ValueError):
        O.Domain("x", aliases=("a",), negative=("A",))
    with pytest.raises(ValueError):
        O.Registry((O.Domain("x"), O.Domain("X")))
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0]), ("c", [0.0, 1.0])], "domain string, vec array<double>")
    assert tuple(O.valid_vectors(v, "domain", "vec").first()) == (3, 2, ["b"], 2)


def selection(spark, config, n_tokens=100, scores=(0.5, 0.1)):
    rows = [(1, i, d, t, s, s, 0.0, 0.0, 0.0, 0.0, 0.0) for i, (d, t, s) in enumerate([("legal", "legal_contract_v1", scores[0]), ("generic", "generic_text_v1", scores[1])])]
    df = spark.createDataFrame(rows, "doc_id long, pos int, domain string, template string, k double, precision double, recall double, e double, c double, t double, p double")
    n = spark.createDataFrame([(1, n_tokens)], "doc_id long, n_tokens long")
    return X.documents(X.ranked(X.fused(df, config), ["doc_id"]), n, config).first()


def test_fallbacks(spark):
    low, high = X.Config(fallback=0.9), X.Config(fallback=0.1)
    assert selection(spark, low)["selected_schema"] == "generic_text_v1" and "Confianza baja" in selection(spark, low)["explanation"]
    r = selection(spark, high)
    assert (r["selected_schema"], r["top_domains"], r["ambiguous"]) == ("legal_contract_v1", ["legal", "generic"], False) or r["ambiguous"] is True
    assert selection(spark, high, n_tokens=13)["selected_schema"] == "generic_text_v1"
    assert selection(spark, high, n_tokens=14)["selected_schema"] == "legal_contract_v1"
    assert "señales débiles" in selection(spark, high, scores=(0.0, 0.0))["explanation"]
    assert 0.5 <= r["confidence"] <= 1


def test_docx_json_and_errors(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    xml = f"""<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Title</w:t></w:r></w:p><w:p><w:r><w:t>Some  text</w:t></w:r></w:p><w:p/>
    <w:p><w:r><w:t>• item</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"""
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", xml)
    (tmp_path / "b.docx").write_bytes(b"broken")
    (tmp_path / "c.csv").write_text("x")
    paths = files.expand_inputs(spark, [f"{tmp_path}/*"], [])
    assert len(paths) == 3 and paths == sorted(paths)
    found = files.parse(files.binary_files(spark, paths))
    rows = found.collect()
    assert [(r["type"], r["text"], r["level"]) for r in rows if r["type"]] == [("heading", "Title", 2), ("paragraph", "Some text", None), ("list_item", "item", None), ("table", None, None)]
    assert sum(r["error"] is not None for r in rows) == 2
    assert len(next(r["cells"] for r in rows if r["type"] == "table")) == 2
    ir = files.nested(found)
    files.write_ir(ir, str(tmp_path / "ir"))
    again = files.read_ir(spark, [str(tmp_path / "ir")])
    assert [r["text"] for r in B.ir_blocks(again).orderBy("block_idx").collect()] == ["Title", "Some text", "item"]


def test_engine_and_stream(spark, data, tmp_path):
    d = spark.read.parquet(f"{data}/documents.parquet").limit(20)
    blocks = engine.parse(d)
    topics, context = engine.contextize(blocks)
    assert context.count() == 20 and topics.where("topic_id = 0").count() == 20
    light, none = engine.contextize(blocks, hybrid=False)
    assert light.count() == 0 and none.agg(F.sum("n_topics")).first()[0] == 0
    found = engine.contextize_chunks(engine.chunk(blocks, max_tokens=256), topics)
    out = engine.select(found, context, topics)
    assert out.count() == 20 and out.agg(F.countDistinct("selected_schema")).first()[0] == 1  # the default threshold always falls back
    source = tmp_path / "in"
    d.repartition(3).write.parquet(str(source))
    stage = lambda b: K.tfidf_top(B.blocks(b), ["doc_id"], "block_idx", 3)
    q = S.apply(S.arriving(spark, str(source), files_per_batch=1), stage, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got, want = spark.read.parquet(str(tmp_path / "out")).drop("batch"), stage(d)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 40


def test_cache(spark):
    w = spark.createDataFrame([("a",), ("b",)], "t string").withColumn("key", cache.cache_key(F.lit("m"), F.col("t")))
    c = w.where("t = 'a'")
    assert {r["t"]: r["hit"] for r in cache.probe(w, c).collect()} == {"a": True, "b": False}
    assert [r["t"] for r in cache.missing(w, c).collect()] == ["b"]


def test_entry_works_without_the_optional_part(spark, monkeypatch):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

    def missing(name, *a):
        raise ModuleNotFoundError(f"No module named '{name}'", name=name)

    monkeypatch.setattr(e.importlib, "import_module", missing)
    assert set(e.queries()) == set(e.oracle_sql()) and len(e.queries()) == 70


def test_a_long_documents_chunks_in_blocks(spark, monkeypatch):
    """Likeness by blocks equals all pairs by hand, over documents that share batches and a chunk without words."""
    from loomdoc.operators import bags

    r = np.random.default_rng(4)
    rows = [(d, i, " ".join(f"w{x}" for x in r.integers(0, 12, int(r.integers(0, 9))))) for d, n in ((1, 9), (2, 1), (3, 2), (4, 14)) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, chunk_seq int, text string").withColumns({"char_len": F.length("text"), "tokens": T.words(F.col("text"))})
    monkeypatch.setattr(bags, "BLOCK", 4)  # reaches this process only; the workers' own block holds all
    got = {(x["doc_id"], x["chunk_seq"]): x for x in C.likeness(df).collect()}
    (batch,) = df.orderBy("doc_id", "chunk_seq").select("doc_id", "chunk_seq", "char_len", T.words(F.col("text")).alias("words"), "tokens").toArrow().combine_chunks().to_batches()
    import pyarrow as pa

    schema = pa.schema([*list(batch.schema)[:3], *(pa.field(x, pa.float64()) for x in ("mean_len", "doc_length", "cohesion_vs_doc", "redundancy_cos_max", "redundancy_jaccard_max"))])
    blocked = {(x["doc_id"], x["chunk_seq"]): x for b in bags.likeness(iter([batch.slice(0, 5), batch.slice(5)]), 4096, schema) for x in b.to_pylist()}
    assert blocked.keys() == got.keys() == {x[:2] for x in rows}
    for d, i, text in rows:
        bag = lambda t: {w: t.split().count(w) for w in t.split()}
        unit = lambda t: {w: n / np.sqrt(sum(m * m for m in bag(t).values())) for w, n in bag(t).items()}
        dot = lambda a, b: sum(v * b.get(k, 0) for k, v in a.items())
        mine = [t for e, _, t in rows if e == d]
        others = [t for e, j, t in rows if e == d and j != i]
        cos = max((dot(unit(text), unit(t)) for t in others), default=0)
        jac = max((1.0 if not (a | b) else len(a & b) / len(a | b) for t in others for a, b in [(set(text.split()), set(t.split()))]), default=0)
        total = {}
        for t in mine:
            for w, x in unit(t).items():
                total[w] = total.get(w, 0) + x
        length = np.sqrt(dot(total, total))
        want = {"redundancy_cos_max": cos, "redundancy_jaccard_max": jac, "cohesion_vs_doc": dot(unit(text), total) / length if length else 0, "doc_length": length, "mean_len": sum(map(len, mine)) / len(mine)}
        for k, v in want.items():
            assert abs(got[d, i][k] - v) < 1e-9 and abs(blocked[d, i][k] - v) < 1e-9, (d, i, k)


def test_similar_pairs_in_blocks(spark):
    r = np.random.default_rng(8)
    x = r.standard_normal((70, 5))
    rows = [("a" if i < 40 else None, v.tolist()) for i, v in enumerate(x)] + [("one", [1.0] * 5)]
    df = spark.createDataFrame(rows, "g string, embedding array<double>")
    got = {y["g"]: (y["n"], y["p0"], y["p1"]) for y in P.similar_pairs(df, "g", [0.3, 0.8], block=7).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for g, part in (("a", u[:40]), (None, u[40:])):
        s = (part @ part.T)[np.triu_indices(len(part), 1)]
        assert got[g] == (len(part), (s > 0.3).sum(), (s > 0.8).sum())
    assert got["one"] == (1, 0, 0)


def test_topic_items_with_exemplars_and_diversity(spark):
    texts = [(1, i, f"alpha beta gamma common{i} words{i % 2}") for i in range(6)] + [(2, 0, "first of all"), (2, 1, "second text")]
    labels = [(1, i, (0, 0, 0, 1, 1, -1)[i]) for i in range(6)] + [(2, 0, -1), (2, 1, -1)]
    vec = [(1, i, [1.0, float(i) / 10, 0.0]) for i in range(6)] + [(2, 0, [1.0, 0.0, 0.0]), (2, 1, [0.0, 1.0, 0.0])]
    t = spark.createDataFrame(texts, "doc_id long, block_idx int, text string")
    lab = spark.createDataFrame(labels, "doc_id long, block_idx int, label int")
    v = spark.createDataFrame(vec, "doc_id long, block_idx int, embedding array<double>")
    second = spark.createDataFrame([(1, 0, ["Key phrase", "alpha", "another phrase"]), (2, 0, ["x1", "x2", "x3", "x4"])], "doc_id long, topic_id int, keywords array<string>")
    got = {(x["doc_id"], x["topic_id"]): x for x in P.topic_items(t, lab, 4, vectors=v, second=second).collect()}
    assert {k: (x["count"], x["exemplar"]) for k, x in got.items()} == {(1, 0): (3, texts[1][2]), (1, 1): (2, texts[3][2]), (2, 0): (2, "first of all")}
    assert all(len(x["keywords"]) == 4 for x in got.values())
    assert set(got[1, 0]["keywords"]) <= {"alpha", "beta", "gamma", "key phrase", "another phrase"} | {f"common{i}" for i in range(6)} | {"words0", "words1"}


def test_clusters_in_blocks_equal_clusters(spark):
    r = np.random.default_rng(6)
    centres = r.standard_normal((6, 8))
    x = np.concatenate([centres[r.integers(0, 6, 90)] + 0.25 * r.standard_normal((90, 8)), r.standard_normal((30, 8)), np.zeros((2, 8))])
    rows = [("a" if i % 3 else None, 1000 - i, v.tolist()) for i, v in enumerate(x)] + [("one", 5, [1.0] * 8)]
    df = spark.createDataFrame(rows, "doc string, i int, embedding array<double>").repartition(3)
    for eps, least in ((0.1, 2), (0.1, 4), (0.3, 6), (0.02, 3)):
        want = {(y["doc"], y["i"]): y["label"] for y in P.clusters(df, "doc", "i", eps=eps, min_samples=least).collect()}
        got = {(y["doc"], y["i"]): y["label"] for y in P.clusters_in_blocks(df, "doc", "i", eps=eps, min_samples=least, block=10).collect()}
        assert got == want and len(set(want.values())) > 2
