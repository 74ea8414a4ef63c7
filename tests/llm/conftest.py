import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def shingles(text, k):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


BASE = "the quick brown fox jumps over the lazy dog while seven small birds sing above an old stone bridge near the river at noon today"
EDGE = [
    (1, BASE, "en", "a", 1),
    (2, BASE + " again", "en", "a", None),
    (3, BASE, "en", "b", 3),
    (3, BASE, "en", "b", 3),  # a repeated row
    (4, None, "en", None, None),
    (5, "", "en", "a", 0),
    (6, " \t\n ", None, "b", 4),
    (None, BASE, "en", "c", 5),
    (None, "no id here and nothing like the others at all", "en", "a", 5),
    (7, "one", "en", "é", 3),
    (8, "x" * 5000, "en", "a", 5000),  # a word longer than any table of powers
    (9, "word " * 30000, "en", "a", 150000),
    (10, "THE QUICK brown fox", "en", "b", 3),
    (11, "línea één\nSecond line of the text stands here\n\nSecond line of the text stands here", "es", "ß", 9),
    (12, "a b c d e f\nsecond line of the text stands there", "en", "b", 9),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    """edge with columns named like results and working columns of the operators."""
    from pyspark.sql import functions as F

    names = "size source_size target taken n_words n_hit items spans contaminated n_shingles component_id rep n level prefix score predicted held_out line kept of_doc words key rank copy label".split()
    return edge.withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="session")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")
