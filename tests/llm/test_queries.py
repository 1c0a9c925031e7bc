"""Registered queries: those with SQL against DuckDB, and the guard of the driver contract."""

import os
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from panelspark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    result = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = Counter(result.fetchall())
    assert Counter(map(tuple, df.select(*columns).collect())) == expected and expected


def test_all_are_registered():
    found = E.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) <= set(found) and found["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLE_SQL) <= set(E.oracle_sql()) and "pipeline" not in E.oracle_sql()
