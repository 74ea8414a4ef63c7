"""Corpus pipeline: quality, line dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all of docs and returns a DataFrame; all but the last
return the columns of documents.  run() writes every stage's rows to the shared folder, so that a later
stage never computes an earlier one again.  A stage's cases (nulls, empty texts and tables, ties,
repeated rows, other columns) are those of its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomdoc.llm import decontaminate, jaccard, lines, mixing, quality
from loomdoc.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, trained on the labelled ones, rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line, and lines one word off, only where it stands first; documents left empty go."""
    return lines.dedup(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of their five-word shingles, that of the smallest id."""
    return jaccard.keep_one(docs, k=5, num=80, den=100)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold passages of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, with the words taken of each, repeats counted."""
    return mixing.mix(docs).where("taken > 0").drop("finish")


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]

#: The classifier is not expressible in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{number}")
    return docs
