"""Stages end to end: parsed files to blocks, models as plug-ins, the cache, the command line."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from loomdoc import __main__ as cli
from loomdoc.operators import chunks as C
from loomdoc.operators import keywords as K
from loomdoc.operators import ontology as O
from loomdoc.sources import cache, files

PARSED = files._PARSED
HEAD = ("DOC-1", "/x.pdf", "application/pdf", "00")


def letters():
    """A model: counts of a, b and c (a local class, so that it reaches the workers by value)."""

    class Letters:
        def encode(self, texts):
            return [[float(t.count(x)) for x in "abc"] for t in texts]

    return Letters


def test_raw_lines_become_paragraphs(spark):
    lines = ["The cat of the house sat", "on the mat.", "Then it was gone", "", "- an item in the list", "INTRODUCTION"]
    rows = [(*HEAD, 1, i, "unknown", x, None, None, None) for i, x in enumerate(lines)] + [(*HEAD, 1, 6, "table", None, None, [(0, 0, "x")], None), (*HEAD, 3, 0, "unknown", "el gato de la casa", None, None, None)]
    rows.append(("DOC-2", "/y.bin", "application/octet-stream", "01", None, None, None, None, None, None, "ValueError: unsupported"))
    parsed = spark.createDataFrame(rows, PARSED)
    got = files.structured(parsed).orderBy("doc_id", "page_number", "block_idx").collect()
    assert [(r["page_number"], r["block_idx"], r["type"], r["text"]) for r in got[:-1]] == [
        (1, 0, "paragraph", "The cat of the house sat on the mat."),
        (1, 1, "paragraph", "Then it was gone"),
        (1, 2, "list_item", "an item in the list INTRODUCTION"),
        (1, 3, "table", None),
        (3, 0, "paragraph", "el gato de la casa"),
    ]
    assert {r["lang"] for r in got[:-1]} == {"en"} and got[4]["page_lang"] == "es" and {r["page_count"] for r in got[:-1]} == {2}
    assert (got[-1]["doc_id"], got[-1]["type"], got[-1]["lang"]) == ("DOC-2", None, "und") and "unsupported" in got[-1]["error"]
    pages = spark.createDataFrame([("DOC-1", 3)], "doc_id string, page_count int")
    assert [tuple(r) for r in files.needing_ocr(parsed, pages).collect()] == [("DOC-1", 2)]


def test_models_are_plugged_in(spark):
    df = spark.createDataFrame([(1, "aab"), (2, "c c"), (3, None)], "i int, text string")
    got = {r["i"]: r["embedding"] for r in C.encoded(df, ["i"], letters(), batch=2).collect()}
    assert got == {1: [2, 1, 0], 2: [0, 0, 2], 3: [0, 0, 0]}
    texts = spark.createDataFrame([(1, "aaab bbbb"), (1, "cccc aaaa abab"), (2, "bbb")], "doc_id long, text string")
    model = letters()
    near = K.nearest_terms(texts, ["doc_id"], lambda rows, keys: C.encoded(rows, keys, model), k=2)
    # sums of document 1: a 9, b 7, c 4
    assert {r["doc_id"]: r["keywords"] for r in near.collect()} == {1: ["abab", "aaab"], 2: ["bbb"]}


def test_cache_encodes_what_it_lacks(spark, tmp_path):
    seen, model = spark.sparkContext.accumulator(0), letters()

    def encode(rows):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return C.encoded(rows.mapInArrow(run, rows.schema), ["key"], model)

    make = lambda *texts: spark.createDataFrame([(t,) for t in texts], "text string").withColumn("key", cache.cache_key(F.lit("m"), F.col("text")))
    path = str(tmp_path / "cache")
    first = {r["text"]: r["embedding"] for r in cache.through(make("a", "b", "a"), path, encode).collect()}
    assert first == {"a": [1, 0, 0], "b": [0, 1, 0]} and seen.value == 2
    again = cache.through(make("b", "cc", "b"), path, encode)
    assert sorted((r["text"], r["embedding"]) for r in again.collect()) == [("b", [0, 1, 0]), ("b", [0, 1, 0]), ("cc", [0, 0, 2])] and seen.value == 3


def test_sinks(spark, tmp_path):
    files.export_registry(spark, O.DEFAULT, str(tmp_path / "registry"))
    rows = {r["domain"]: r for r in spark.read.json(str(tmp_path / "registry")).collect()}
    assert set(rows) == {d.name for d in O.DEFAULT.domains}
    legal = O.DEFAULT.get("LEGAL")
    assert rows["legal"]["aliases"] == list(legal.aliases) and [e["name"] for e in rows["legal"]["entity_types"]] == [n for n, _ in legal.entities]
    assert [(r["name"], r["head"], r["tail"]) for r in rows["legal"]["relation_types"]] == list(legal.relations)
    files.write_chunks(spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], "doc_id long, chunk_seq int, text string"), str(tmp_path / "chunks"))
    assert {p.name for p in (tmp_path / "chunks").glob("doc_id=*")} == {"doc_id=1", "doc_id=2"}
    path = str(tmp_path / "vectors")
    made = files.registry_vectors(spark, O.SAMPLE, path).collect()
    stamp = (tmp_path / "vectors" / "_SUCCESS").stat().st_mtime_ns
    assert made and sorted(files.registry_vectors(spark, O.SAMPLE, path).collect()) == sorted(made) and (tmp_path / "vectors" / "_SUCCESS").stat().st_mtime_ns == stamp
    (tmp_path / "a.json").write_text(json.dumps({"doc_id": "d", "pages": []}))
    assert files.read_ir(spark, [str(tmp_path / "a.json"), str(tmp_path / "none.json")]).count() == 1
    assert files.read_ir(spark, [str(tmp_path / "none.json")]).count() == 0


def docx(path, *paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
    path.write_bytes(out.getvalue())


def test_command_line(spark, tmp_path):
    docx(tmp_path / "a.docx", "The contract of the court has a clause and a penalty. It is signed by the notary of the city.", "The patient has a disease and the doctor of the hospital gave a drug. It was the treatment of the day.")
    docx(tmp_path / "b.docx", "El paciente de la clínica tiene un síntoma y el médico le dio una receta para la terapia del día.")
    at = lambda name: str(tmp_path / name)
    cli.main(["parse", at("*.docx"), "--out", at("blocks")])
    blocks = spark.read.parquet(at("blocks"))
    assert {r["lang"] for r in blocks.select("lang").collect()} == {"en", "es"} and blocks.where("error IS NOT NULL").count() == 0
    cli.main(["contextize-doc", at("blocks"), "--out", at("context"), "--top-k", "5", "--min-samples", "2"])
    cli.main(["chunk", at("blocks"), "--out", at("chunks"), "--max-tokens", "32"])
    cli.main(["contextize-chunks", at("chunks"), at("context"), "--out", at("rich")])
    rich = spark.read.parquet(at("rich"))
    assert rich.count() == spark.read.parquet(at("chunks")).count() > 2 and all(0 < len(r["inherited_keywords"]) <= 5 for r in rich.collect())
    for name, extra in (("out", []), ("strict", ["--fallback", "0.99", "--k", "0.5"])):
        cli.main(["schema-select", at("rich"), at("context"), "--out", at(name), *extra])
    out, strict = (spark.read.parquet(at(f"{x}/documents")) for x in ("out", "strict"))
    chosen = spark.read.parquet(at("out/chunks")).collect()
    tops = {r["doc_id"]: set(r["all_top"]) for r in out.collect()}
    assert len(chosen) == rich.count() and all(r["top_domain"] in r["evaluated_domains"] and set(r["evaluated_domains"]) <= tops[r["doc_id"]] for r in chosen)
    assert out.count() == strict.count() == 2 and {r["selected_schema"] for r in strict.collect()} == {"generic_text_v1"}
