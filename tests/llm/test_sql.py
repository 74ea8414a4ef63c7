"""Queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from loomdoc.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, data, name):
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "labels"):
        if os.path.exists(f"{data}/{t}.parquet"):
            c.sql(f"CREATE VIEW {t} AS FROM '{data}/{t}.parquet'")
    got = queries.QUERIES[name](spark, data).toPandas()
    want = c.sql(queries.ORACLE_SQL[name]).df()[list(got.columns)]
    rows = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    assert len(got) > 0 and rows(got) == rows(want)
