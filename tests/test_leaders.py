import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.operators import leaders
from panelspark.plans import panel_queries as Q
from tests.fixtures import weekly

COLS = ["country", "year", "trimester", "month", "country_covid_deaths", "avg_deaths_per100k", "monthly_covid_deaths"]

# Plain row-level statement of the cumulative semantics: windows over every weekly row, default frames.
ROW_LEVEL_SQL = """
WITH base AS (
    SELECT country, year(start_date) AS year, month(start_date) AS month,
           CAST(floor((month(start_date) - 1) / 3) + 1 AS INT) AS trimester,
           covid_deaths, covid_deaths_per_100k
    FROM weekly WHERE covid_deaths > 0
), w AS (
    SELECT *,
           sum(covid_deaths) OVER (PARTITION BY year ORDER BY month) AS monthly_covid_deaths,
           sum(covid_deaths) OVER (PARTITION BY year, country ORDER BY month) AS country_covid_deaths,
           round(avg(covid_deaths_per_100k) OVER (PARTITION BY year, country ORDER BY month), 4) AS avg_deaths_per100k
    FROM base
), m AS (
    SELECT *, max(monthly_covid_deaths) OVER (PARTITION BY year ORDER BY trimester) AS mx FROM w
)
SELECT DISTINCT country, year, trimester, month, country_covid_deaths, avg_deaths_per100k, monthly_covid_deaths
FROM m WHERE monthly_covid_deaths = mx
"""


def run(spark, n=1, mode="cumulative"):
    return leaders.quarter_leaders(
        weekly(spark), "country", "start_date", "covid_deaths", "covid_deaths_per_100k", n=n, mode=mode,
        names=Q.COVID_NAMES,
    )


def as_set(df):
    return {tuple(r) for r in df.select(*COLS).collect()}


def test_cumulative_quarter_rows_hand_worked(spark):
    rows, _ = run(spark)
    assert as_set(rows) == {
        # Q1 2020: year-to-date totals 240, 250, 261 -> the last month with data (March) is chosen;
        # A has no positive row in March and is absent
        ("B", 2020, 1, 3, 56.0, 0.75, 261.0),
        ("C", 2020, 1, 3, 5.0, 0.25, 261.0),
        # Q2 2020: June is empty, May is the last month with data
        ("C", 2020, 2, 5, 25.0, 1.125, 331.0),
        ("D", 2020, 2, 5, 20.0, 1.0, 331.0),
        # 2021 (year from the date, not the delivered column)
        ("A", 2021, 1, 2, 8.0, 0.4, 19.0),
        ("B", 2021, 1, 2, 8.0, 0.4, 19.0),
        ("C", 2021, 1, 2, 3.0, 0.3, 19.0),
    }


def test_top_n_keeps_ties(spark):
    _, top = run(spark, n=1)
    got = sorted((r.country, r.year, r.trimester) for r in top.collect())
    # the tie at rank 1 in 2021 gives two rows for n = 1
    assert got == [("A", 2021, 1), ("B", 2020, 1), ("B", 2021, 1), ("C", 2020, 2)]
    _, top2 = run(spark, n=2)
    assert sorted((r.country, r.year) for r in top2.collect() if r.year == 2021) == [("A", 2021), ("B", 2021)]


def test_calendar_mode_differs_on_first_month_deadliest(spark):
    rows, _ = run(spark, mode="calendar")
    got = as_set(rows)
    assert ("A", 2020, 1, 1, 190.0, 1.5, 240.0) in got
    assert ("B", 2020, 1, 1, 50.0, None, 240.0) in got  # only null rates -> null mean
    assert {r[3] for r in got if r[1] == 2020 and r[2] == 1} == {1}  # January, not March
    assert {r[3] for r in got if r[1] == 2021} == {1}


def test_aggregate_first_equals_row_level(spark):
    weekly(spark).createOrReplaceTempView("weekly")
    expected = {tuple(r) for r in spark.sql(ROW_LEVEL_SQL).collect()}
    got = {tuple(r) for r in run(spark)[0].select(*COLS).collect()}
    assert {r[:4] for r in got} == {r[:4] for r in expected}
    exp = {r[:4]: r for r in expected}
    for r in got:
        e = exp[r[:4]]
        assert r[4] == pytest.approx(e[4]) and r[6] == pytest.approx(e[6])
        assert (r[5] is None and e[5] is None) or r[5] == pytest.approx(e[5], abs=1e-4)


def test_driver_orders_match_row_level_at_scale(spark):
    """Aggregate-first on orders (sf0.001) equals the row-level windows, exact money sums."""
    from panelspark.plans import driver

    got = {tuple(r) for r in driver.quarter_peak_rows(spark, "/root/testdata/sf0.001").collect()}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.createOrReplaceTempView("orders_t")
    sql = driver.ORACLE_SQL["quarter_peak_rows"].replace("FROM orders", "FROM orders_t")
    sql = sql.replace("CAST(year(o_orderdate) AS INTEGER)", "year(o_orderdate)").replace(
        "CAST(month(o_orderdate) AS INTEGER)", "month(o_orderdate)"
    )
    expected = {tuple(r) for r in spark.sql(sql).collect()}
    assert len(got) > 0 and got == expected


def test_top_n_plan_limits_before_exchange(spark):
    """Each map task keeps at most n rows (plus ties) per quarter before the final rank."""
    _, top = run(spark, n=5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial
    top_part = plan.split("Exchange hashpartitioning(year")[1]
    assert "WindowGroupLimit" in top_part.splitlines()[1]


def test_quarter_plan_broadcasts_only_the_month_table(spark):
    rows, _ = run(spark)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the broadcast side is the (year, month) table: every aggregation in it is keyed by year and month only
    broadcast_side = plan.split("BroadcastExchange")[1].split("FileScan")[0]
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", broadcast_side)
    assert keys and all(re.sub(r"#\d+", "", k) == "year, month" for k in keys)


def test_bad_mode(spark):
    with pytest.raises(ValueError):
        run(spark, mode="weekly")


@pytest.mark.parametrize("mode", ["cumulative", "calendar"])
def test_from_checkpointed_months_equals_direct(spark, mode):
    direct = as_set(run(spark, mode=mode)[0])
    monthly = Q.country_months(weekly(spark))
    assert as_set(Q.quarter_rows_from_months(monthly, mode)) == direct


@pytest.mark.parametrize("n", [1, 5, 1500])
def test_top_n_of_any_n(spark, n):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    top = leaders.top_n(orders, ["o_orderstatus"], "o_totalprice", n)
    w = Window.partitionBy("o_orderstatus").orderBy(F.col("o_totalprice").desc())
    plain = orders.withColumn("r", F.rank().over(w)).filter(F.col("r") <= n).drop("r")
    assert top.count() == plain.count() and top.exceptAll(plain).count() == 0


@pytest.mark.parametrize("mode", ["cumulative", "calendar"])
def test_rows_without_a_date_stay(spark, mode):
    df = spark.createDataFrame(
        [("A", "2020-01-05", 3.0), ("A", None, 4.0), ("B", None, 5.0), ("B", None, -1.0), (None, "2020-02-02", 1.0)],
        "country string, start_date string, v double",
    ).withColumn("start_date", F.to_date("start_date"))
    got = leaders.quarter_peak(df, "country", "start_date", "v", "v", mode=mode, names=Q.COVID_NAMES)
    undated = {(r.country, r.country_covid_deaths, r.monthly_covid_deaths) for r in got.filter("year IS NULL").collect()}
    assert undated == {("A", 4.0, 9.0), ("B", 5.0, 9.0)}
    assert got.filter("year IS NOT NULL").count() == 1


@pytest.mark.parametrize("mode", ["cumulative", "calendar"])
def test_non_finite_measures_count_as_in_plain_sums(spark, mode):
    """The exact form gives the rows of the plain one where a month holds NaN or an infinity."""
    nan, inf = float("nan"), float("inf")
    months = {1: [1.0, 2.0], 2: [inf, 1.0], 3: [4.0], 5: [nan], 6: [2.0], 11: [None, 8.0]}
    data = [(f"e{i % 2}", dt.date(2021, m, 1 + i), v) for m, vs in months.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "e string, d date, v double")
    plain, exact = (leaders.quarter_peak(df, "e", "d", "v", "v", mode=mode, measure_scale=s, rate_scale=s) for s in (None, 2))
    assert exact.count() and sorted(map(repr, plain.collect())) == sorted(map(repr, exact.collect()))
