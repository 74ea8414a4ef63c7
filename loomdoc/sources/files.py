"""Reading and writing: files of documents, nested JSON, registry export."""

from __future__ import annotations

import io
import logging
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from ..functions import text as X
from ..operators import blocks as B

_BLOCK = "STRUCT<type STRING, text STRING, level INT, caption STRING, cells ARRAY<STRUCT<row INT, col INT, text STRING>>>"
IR = f"doc_id STRING, source_path STRING, mime STRING, lang STRING, pages ARRAY<STRUCT<page_number INT, width DOUBLE, height DOUBLE, lang STRING, blocks ARRAY<{_BLOCK}>>>"
_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def expand_inputs(spark: SparkSession, patterns: list[str], listed: list[str] | None = None) -> list[str]:
    """Paths that match the patterns, and those listed; sorted, each once.  Any file system Spark reads."""
    found = set(listed or [])
    conf = spark._jsc.hadoopConfiguration()
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found |= {s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []}
    return sorted(found)


def binary_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """doc_id, path, mime, sha256, size, content of files."""
    f = spark.read.format("binaryFile").load(paths)
    return f.select(X.document_id(F.col("path")).alias("doc_id"), "path", X.mime_type(F.col("path")).alias("mime"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"), "content")


def parse_docx(content: bytes) -> list[dict]:
    """Blocks of a .docx file on one logical page: paragraphs with style-based headings and list items, then tables."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{_WORD}body")
    clean = lambda s: " ".join(s.replace(" ", " ").replace("\r", "").replace("-\n", "").split())
    words = lambda node: clean("".join(t.text or "" if t.tag == f"{_WORD}t" else "\n" if t.tag == f"{_WORD}br" else "\t" if t.tag == f"{_WORD}tab" else "" for t in node.iter()))
    blocks: list[dict] = []
    for p in body.findall(f"{_WORD}p"):
        if not (text := words(p)):
            continue
        style = p.find(f"{_WORD}pPr/{_WORD}pStyle")
        name = (style.get(f"{_WORD}val") if style is not None else "") or ""
        block = {"type": "paragraph", "text": text, "level": None, "cells": None}
        if "heading" in name.lower():
            level = next((n for n in range(1, 7) if str(n) in name), 1)
            block |= {"type": "heading", "level": level}
        elif text[0] in X.BULLETS or p.find(f"{_WORD}pPr/{_WORD}numPr") is not None:
            block |= {"type": "list_item", "text": re.sub(rf"^[{X.BULLETS}]\s*", "", text)}
        blocks.append(block)
    for table in body.findall(f"{_WORD}tbl"):
        cells = [{"row": i, "col": j, "text": words(c)} for i, r in enumerate(table.findall(f"{_WORD}tr")) for j, c in enumerate(r.findall(f"{_WORD}tc"))]
        blocks.append({"type": "table", "text": None, "level": None, "cells": cells})
    return blocks


def parse_pdf(content: bytes) -> list[dict]:
    """Lines of every page (type unknown; typed and merged later by operators.blocks) through pdfplumber, where installed."""
    import pdfplumber

    blocks = []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for number, page in enumerate(pdf.pages, 1):
            blocks += [{"page": number, "type": "unknown", "text": line, "level": None, "cells": None} for line in (page.extract_text() or "").split("\n")]
            for rows in page.extract_tables() or []:
                cells = [{"row": i, "col": j, "text": c or ""} for i, r in enumerate(rows) for j, c in enumerate(r)]
                blocks.append({"page": number, "type": "table", "text": None, "level": None, "cells": cells})
    return blocks


def parse_image(content: bytes) -> list[dict]:
    """Words of an image through pytesseract, where installed, as one paragraph."""
    import pytesseract
    from PIL import Image

    text = " ".join(pytesseract.image_to_string(Image.open(io.BytesIO(content))).split())
    return [{"type": "paragraph", "text": text, "level": None, "cells": None}] if text else []


def _parser(mime: str):
    if mime == "application/pdf":
        return parse_pdf
    if "word" in mime:
        return parse_docx
    return parse_image if mime.startswith("image/") else None


_PARSED = "doc_id string, path string, mime string, sha256 string, page_number int, block_idx int, type string, text string, level int, cells array<struct<row:int,col:int,text:string>>, error string"


def parse(files: DataFrame) -> DataFrame:
    """Blocks of files (binary_files); one row with error for a file that no parser here can read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _PARSED.split(", ")]
        for pdf in batches:
            for f in pdf.itertuples():
                head = {"doc_id": f.doc_id, "path": f.path, "mime": f.mime, "sha256": f.sha256}
                try:
                    if (parser := _parser(f.mime)) is None:
                        raise ValueError(f"unsupported type {f.mime}")
                    rows, counts = [], {}
                    for b in parser(bytes(f.content)):
                        page = b.get("page", 1)
                        rows.append(head | {"page_number": page, "block_idx": counts.get(page, 0), "error": None} | {k: b[k] for k in ("type", "text", "level", "cells")})
                        counts[page] = counts.get(page, 0) + 1
                except Exception as e:  # a broken file or a parser that is not installed: report it, go on
                    rows = [head | {"error": f"{type(e).__name__}: {e}"}]
                out = pd.DataFrame(rows).reindex(columns=names)
                for c in ("page_number", "block_idx", "level"):
                    out[c] = out[c].astype("Int32")
                yield out.astype(object).where(out.notna(), None)

    return files.mapInPandas(run, _PARSED)


def structured(parsed: DataFrame) -> DataFrame:
    """Blocks of parse() with raw lines (type unknown) merged to paragraphs and typed, what else a page has after
    them in its order, and with lang (of the document), page_lang and page_count.  Rows with an error stay as they are."""
    found = parsed.where("error IS NULL")
    raw = found.where("type = 'unknown'")
    merged = B.typed(B.paragraphs(raw.select("doc_id", "page_number", "block_idx", "text")).withColumnRenamed("paragraph", "block_idx"))
    none = {"cells": F.lit(None).cast(parsed.schema["cells"].dataType)}
    own = merged.withColumns(none).select("doc_id", "page_number", F.lit(0).alias("_after"), "block_idx", "type", "text", "level", "cells")
    rest = found.where("type <> 'unknown'").select("doc_id", "page_number", F.lit(1).alias("_after"), "block_idx", "type", "text", "level", "cells")
    number = F.row_number().over(W.partitionBy("doc_id", "page_number").orderBy("_after", "block_idx")) - 1
    blocks = own.union(rest).withColumn("block_idx", number).drop("_after")
    told = B.languages(blocks.where("text IS NOT NULL")).withColumnRenamed("n_pages", "_n")
    pages = found.groupBy("doc_id").agg(F.countDistinct("page_number").alias("page_count"))
    files = parsed.select("doc_id", "path", "mime", "sha256", "error").distinct()
    out = files.join(blocks, "doc_id", "left").join(told.select("doc_id", "page_number", "page_lang"), ["doc_id", "page_number"], "left")
    out = out.join(told.select("doc_id", "lang").distinct(), "doc_id", "left").join(pages, "doc_id", "left")
    return out.withColumns({c: F.coalesce(c, F.lit("und")) for c in ("lang", "page_lang")})


def needing_ocr(parsed: DataFrame, page_counts: DataFrame) -> DataFrame:
    """doc_id, page_number of pages (doc_id, page_count) that no text or table came from."""
    pages = page_counts.select("doc_id", F.explode(F.sequence(F.lit(1), F.col("page_count").cast("int"))).alias("page_number"))
    return B.without_blocks(pages, parsed.where("error IS NULL AND (type = 'table' OR trim(text) <> '')"))


def nested(blocks: DataFrame) -> DataFrame:
    """Documents of nested pages (schema IR) from flat blocks."""
    b = blocks.where("error IS NULL") if "error" in blocks.columns else blocks
    one = F.struct("type", "text", "level", F.lit(None).cast("string").alias("caption"), "cells")
    pages = b.groupBy("doc_id", "path", "mime", "page_number").agg(F.array_sort(F.collect_list(F.struct("block_idx", one.alias("b")))).alias("x"))
    page = F.struct("page_number", F.lit(None).cast("double").alias("width"), F.lit(None).cast("double").alias("height"), F.lit("und").alias("lang"), F.col("x.b").alias("blocks"))
    docs = pages.groupBy("doc_id", "path", "mime").agg(F.array_sort(F.collect_list(F.struct("page_number", page.alias("p")))).alias("p"))
    return docs.select("doc_id", F.col("path").alias("source_path"), "mime", F.lit("und").alias("lang"), F.col("p.p").alias("pages"))


def read_ir(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Nested documents from JSON files, of one object each or one a line; missing files are told in the log and passed over."""
    there = [p for pattern in paths for p in expand_inputs(spark, [pattern])]
    if missing := len(paths) - len(there) if len(there) < len(paths) else 0:
        logging.getLogger(__name__).warning("%d of %d inputs do not exist", missing, len(paths))
    if not there:
        return spark.createDataFrame([], IR)
    return spark.read.schema(IR).option("multiLine", True).json(there)


def write_json(df: DataFrame, path: str, key: str | None = None) -> None:
    """Replaces path (only it) with JSON, in a folder per key if given.  Spark's commit protocol
    leaves no half-written output."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(key) if key else writer).json(path)


def write_ir(df: DataFrame, path: str) -> None:
    write_json(df.select(*[f.name for f in T._parse_datatype_string(IR)]), path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Replaces path with JSON lines of chunks, a folder per document (doc_id=...)."""
    write_json(chunks, path, "doc_id")


def export_registry(spark: SparkSession, registry, path: str) -> None:
    """Replaces path with a registry as JSON: a row per domain with its aliases, entity types and relations."""
    rows = [(d.name, d.schema_name, float(d.weight), list(d.aliases), list(d.negative), list(d.stopwords), [(n, sorted({x.strip().lower() for x in a})) for n, a in d.entities], list(d.relations)) for d in registry.domains]
    schema = "domain string, schema_name string, weight double, aliases array<string>, negative_aliases array<string>, stopwords array<string>, entity_types array<struct<name:string,aliases:array<string>>>, relation_types array<struct<name:string,head:string,tail:string>>"
    write_json(spark.createDataFrame(rows, schema), path)


def registry_vectors(spark: SparkSession, registry, path: str) -> DataFrame:
    """The registry's vectors (domain, bucket, v) as a table at path, made where there is none."""
    from ..operators import ontology as O

    if not expand_inputs(spark, [f"{path}/_SUCCESS"]):
        O.cosine_vectors(spark, registry).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
