"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, fingerprint, jaccard, lines, lm, mixing, oracles, quality, urlfilter, warc
from .common import table, written

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query("op1_mixing", mixing.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    return mixing.mix(written(docs, "sizes")).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_decontaminate", oracles.DECONTAMINATE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_ngram_jaccard", oracles.JACCARD)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"), k=3, num=90, den=100).drop("mark")


@query("op10_fingerprint")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.train(docs, labels))


@query("op9_line_dedup", oracles.LINES)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a word and the line that stands for it: itself, or the earlier one that it repeats."""
    found = lines.decide(table(spark, sf_dir, "documents"), min_words=1)
    return found.withColumns({"of_doc": F.coalesce("of_doc", "doc_id"), "of_line": F.coalesce("of_line", "line")})


@query("op3_chat", oracles.CHAT)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.windows(chat.probe(table(spark, sf_dir, "conversations"))))


@query("op5_url_filter", oracles.urls(urlfilter.RULES, urlfilter.ORDER, urlfilter.ALPHABET, urlfilter.MICRO))
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


@query("op8_lm_score")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))
