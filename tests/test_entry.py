"""The driver contract: entry, queries, oracle SQL -- checked against DuckDB on sf0.001."""

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as E
from panelspark.plans import driver

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["l_suppkey", "year", "month", "total_quantity"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(driver.ORACLE_SQL) == set(driver.QUERIES)
    assert set(driver.ORACLE_SQL) <= set(E.oracle_sql()) and set(driver.QUERIES) <= set(E.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return 0.0 if x == 0 else (None if math.isnan(x) else x)
        return x

    return Counter(tuple(v(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(driver.ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _norm(rows, df.columns) == _norm(orows, ocols)


FORBIDDEN_IN_PLANS = (
    "BatchEvalPython",  # row-at-a-time Python UDF
    "ArrowEvalPython",  # pandas UDF
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.mark.parametrize("name", sorted(driver.QUERIES))
def test_plans_stay_on_the_jvm_and_emit_no_pairs(spark, name):
    """Every query, and every table it writes on its way, runs as built-in expressions with no all-pairs join."""
    seen = []
    tracked = type(spark.range(0).write)
    save = {n: getattr(tracked, n) for n in ("save", "parquet", "csv", "json", "text")}

    def recording(method):
        def run(self, *args, **kwargs):
            seen.append(self._df._jdf.queryExecution().executedPlan().toString())
            return method(self, *args, **kwargs)

        return run

    try:
        for n, method in save.items():
            setattr(tracked, n, recording(method))
        seen.append(driver.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    finally:
        for n, method in save.items():
            setattr(tracked, n, method)
    for plan in seen:
        assert not [p for p in FORBIDDEN_IN_PLANS if p in plan]
