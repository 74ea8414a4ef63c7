"""Blocks, paragraphs, pages and tables of documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from .bags import small_batches


def lines(documents: DataFrame) -> DataFrame:
    """doc_id, lang, page_number, block_idx, text: every line of plain documents as a block of page 1."""
    return documents.select("doc_id", "lang", F.lit(1).alias("page_number"), F.posexplode(F.split("text", "\n", -1)).alias("block_idx", "text"))


def blocks(documents: DataFrame) -> DataFrame:
    """Lines with text."""
    return lines(documents).where(T.filled(F.col("text")))


def ir_blocks(ir: DataFrame) -> DataFrame:
    """Text blocks of nested documents (pages of blocks); tables and figures have no text and drop out."""
    pages = ir.select("doc_id", "lang", F.explode("pages").alias("p"))
    found = pages.select("doc_id", "lang", F.coalesce("p.page_number", F.lit(1)).alias("page_number"), F.posexplode("p.blocks").alias("block_idx", "b"))
    return found.select("doc_id", "lang", "page_number", "block_idx", "b.type", "b.text").where(T.filled(F.col("text")))


def typed(found: DataFrame) -> DataFrame:
    """With type, level and the text without its bullet."""
    kind = T.block_type(T.strip(F.col("text")))
    text = F.when(kind == "list_item", T.list_item_text(F.col("text"))).otherwise(T.strip(F.col("text")))
    return found.withColumn("type", kind).withColumn("level", F.when(kind == "heading", 2)).withColumn("text", text)


def paragraphs(found: DataFrame) -> DataFrame:
    """doc_id, page_number, paragraph, text, source_lines: lines merged until a blank one, or a sentence
    end before a blank or capitalised one."""
    in_page = W.partitionBy("doc_id", "page_number").orderBy("block_idx")
    line = found.withColumn("l", T.normalized_line(F.col("text"))).withColumn("next", F.coalesce(F.lead("l").over(in_page), F.lit("")))
    ends = F.col("l").rlike('[.!?…]"?$') & ((F.col("next") == "") | F.col("next").rlike(r"^\p{Lu}"))
    cut = F.when((F.col("l") == "") | ends, 1).otherwise(0)
    line = line.withColumn("cut", cut).withColumn("g", F.coalesce(F.sum("cut").over(in_page.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    merged = line.where("l <> ''").groupBy("doc_id", "page_number", "g").agg(F.array_sort(F.collect_list(F.struct("block_idx", "l"))).alias("x"))
    number = F.row_number().over(W.partitionBy("doc_id", "page_number").orderBy("g")) - 1
    return merged.select("doc_id", "page_number", number.alias("paragraph"), F.array_join("x.l", " ").alias("text"), F.col("x.block_idx").alias("source_lines"))


def page_metrics(found: DataFrame, merged: DataFrame) -> DataFrame:
    """n_lines_raw, n_paragraphs_final, fusion_rate, layout_loss per page."""
    raw = found.groupBy("doc_id", "page_number").agg(F.count("*").alias("n_lines_raw"))
    final = merged.groupBy("doc_id", "page_number").agg(F.count("*").alias("n_paragraphs_final"))
    both = raw.join(final, ["doc_id", "page_number"], "left").withColumn("n_paragraphs_final", F.coalesce("n_paragraphs_final", F.lit(0)))
    rate = F.round(F.col("n_lines_raw") / F.greatest(F.lit(1), F.col("n_paragraphs_final")), 3)
    return both.withColumn("fusion_rate", rate).withColumn("layout_loss", F.lit(0.0))


def census(kinds: DataFrame) -> DataFrame:
    """Blocks of each type per page, in columns."""
    kinds_of = ["heading", "list_item", "paragraph"]
    return kinds.groupBy("doc_id", "page_number").pivot("type", kinds_of).count().na.fill(0)


def joined(found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, text: the texts of a document's or page's blocks in order, a space between."""
    rows = F.array_sort(F.collect_list(F.struct("page_number", "block_idx", "text")))
    return found.groupBy(*keys).agg(rows.alias("x")).select(*keys, F.array_join("x.text", " ").alias("text"))


def language_sample(found: DataFrame, blocks: int = 50, chars: int = 2000) -> DataFrame:
    """doc_id, text: a document's first blocks, until they have over chars characters, blocks of them at most."""
    in_doc = W.partitionBy("doc_id").orderBy("page_number", "block_idx")
    s = found.withColumn("text", T.strip(F.col("text"))).withColumn("r", F.row_number().over(in_doc))
    s = s.withColumn("before", F.coalesce(F.sum(F.length("text")).over(in_doc.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return joined(s.where((F.col("r") <= blocks) & (F.col("before") <= chars)), ["doc_id"])


def languages(found: DataFrame, doc_chars: int = 2000, page_chars: int = 1000) -> DataFrame:
    """doc_id, page_number, lang, page_lang, n_pages from samples of the blocks' texts."""
    doc = joined(found, ["doc_id"]).select("doc_id", T.detected_language(F.left("text", F.lit(doc_chars))).alias("lang"))
    page = joined(found, ["doc_id", "page_number"]).select("doc_id", "page_number", T.detected_language(F.left("text", F.lit(page_chars))).alias("page_lang"))
    n = F.count("*").over(W.partitionBy("doc_id"))
    return page.join(doc, "doc_id").select("doc_id", "page_number", "lang", "page_lang", n.alias("n_pages"))


def without_blocks(pages: DataFrame, found: DataFrame) -> DataFrame:
    """Pages that no text or table came from: those to read optically."""
    return pages.join(found.select("doc_id", "page_number").distinct(), ["doc_id", "page_number"], "left_anti")


def cells(tables: DataFrame) -> DataFrame:
    """doc_id, table_idx, row, col, text of tables (doc_id, table_idx, rows: array of arrays of text)."""
    rows = tables.select("doc_id", "table_idx", F.posexplode("rows").alias("row", "r"))
    return rows.select("doc_id", "table_idx", "row", F.posexplode("r").alias("col", "t")).select("doc_id", "table_idx", "row", "col", T.normalized_text(F.coalesce("t", F.lit(""))).alias("text"))


def shapes(tables: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and columns of every table, (0, 0) for one without cells."""
    size = found.groupBy("doc_id", "table_idx").agg((F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"))
    return tables.select("doc_id", "table_idx").join(size, ["doc_id", "table_idx"], "left").na.fill(0, ["n_rows", "n_cols"])


def ocr_confidence(words: DataFrame) -> DataFrame:
    """Mean confidence (0 to 1) per page of words (doc_id, page_number, text, conf)."""
    conf = F.expr("try_cast(conf AS DOUBLE)")
    return words.where(T.filled(F.col("text"))).groupBy("doc_id", "page_number").agg((F.avg(conf) / 100).alias("confidence"))


def parse_metrics(kinds: DataFrame, golden: DataFrame | None = None) -> DataFrame:
    """layout_loss, tables found, expected and ratio per document."""
    out = kinds.groupBy("doc_id").agg(F.avg((F.col("type") == "unknown").cast("int")).alias("layout_loss"), F.count(F.when(F.col("type") == "table", 1)).alias("found"))
    out = out.join(golden, "doc_id", "left") if golden is not None else out.withColumn("expected", F.lit(None).cast("long"))
    expected = F.coalesce("expected", F.lit(0))
    return out.withColumn("expected", expected).withColumn("ratio", F.when(F.col("expected") > 0, F.col("found") / F.col("expected")).otherwise(1.0))


def percent_ok(results: DataFrame) -> DataFrame:
    """Share of documents parsed, in percent, of results (doc_id, ok)."""
    return results.agg(F.coalesce(100 * F.avg(F.col("ok").cast("int")), F.lit(0.0)).alias("percent_docs_ok"))


def layout_lines(words: DataFrame, tolerance: float = 2.5) -> DataFrame:
    """doc_id, page_number, line, y, text: words (seq, text, top, bottom) grouped while their centre stays
    within tolerance of the line's first.  One fold over each page's centres on Arrow batches, so pages run side by side."""
    from pyspark.sql import types as S
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(words.sparkSession)
    centre = (F.col("top") + F.col("bottom")) / 2
    seen = words.select("doc_id", "page_number", F.struct("seq", centre.alias("y"), T.strip(F.col("text")).alias("t")).alias("w")).where(F.col("w.t") != "")
    page = seen.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_list("w")).alias("w")).select("doc_id", "page_number", "w.y", "w.t")
    schema = S.StructType([*page.schema.fields[:2], S.StructField("line", S.IntegerType()), S.StructField("y", S.DoubleType()), S.StructField("text", S.StringType())])
    arrow = to_arrow_schema(schema)

    def fold(batches):
        for batch in batches:
            row, line, at, text = [], [], [], []
            for i, (ys, ts) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                ys, ts = ys.as_py(), ts.as_py()
                first, starts = None, []
                for j, y in enumerate(ys):
                    if first is None or (y is not None and abs(y - first) >= tolerance):
                        first = y
                        starts.append(j)
                row += [i] * len(starts)
                line += range(len(starts))
                at += [ys[j] for j in starts]
                text += [" ".join(ts[a:b]) for a, b in zip(starts, [*starts[1:], len(ts)], strict=True)]
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(line, pa.int32()), pa.array(at, pa.float64()), pa.array(text, pa.string())], schema=arrow)

    return page.mapInArrow(fold, schema)


def layout_paragraphs(found: DataFrame, factor: float = 1.8) -> DataFrame:
    """Paragraphs of layout lines: cut where the gap to the next line is over factor medians, at a sentence
    end before a capital, and at the end of the page."""
    in_page = W.partitionBy("doc_id", "page_number").orderBy("line")
    f = found.withColumn("gap", F.abs(F.lead("y").over(in_page) - F.col("y"))).withColumn("next", F.lead("text").over(in_page))
    f = f.withColumn("median", F.expr("percentile(gap, 0.5)").over(W.partitionBy("doc_id", "page_number")))
    limit = F.when(F.col("median") > 0, factor * F.col("median")).otherwise(9999.0)
    ends = F.col("text").rlike('[.!?…]"?$') & (F.coalesce("next", F.lit("")).rlike(r"^\p{Lu}") | F.col("next").isNull())
    f = f.withColumn("cut", (F.col("gap").isNull() | (F.col("gap") > limit) | ends).cast("int"))
    f = f.withColumn("g", F.coalesce(F.sum("cut").over(in_page.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    out = f.groupBy("doc_id", "page_number", "g").agg(F.array_sort(F.collect_list(F.struct("line", "text"))).alias("x"))
    return out.select("doc_id", "page_number", F.col("g").cast("int").alias("paragraph"), F.array_join("x.text", " ").alias("text"), F.col("x.line").alias("source_lines"))
