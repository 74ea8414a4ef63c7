"""Every query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from loomdoc.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    def value(v):
        if v is None or v != v:
            return None
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, bool):
            return str(v)
        return round(float(v), 5) if isinstance(v, int | float) and math.isfinite(v) else str(v)

    df = df[sorted(df.columns)].astype(object).where(df.notna(), None)
    return sorted((tuple(map(value, r)) for r in df.itertuples(index=False)), key=str)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{data}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, data, duck, name):
    got = catalogue.QUERIES[name](spark, data).toPandas()
    want = duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    a, b = rows(got), rows(want)
    wrong = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not wrong, wrong[:3]


def test_all_have_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL) and len(catalogue.QUERIES) == 70
