from pyspark.sql import functions as F

from panelspark.operators import periods
from tests.fixtures import county


def totals(spark):
    return periods.monthly_totals(
        county(spark), ["state"], "date", {"total_cases": "cases", "total_deaths": "deaths"}
    )


def test_monthly_totals(spark):
    got = {(r.state, r.year, r.month): (r.total_cases, r.total_deaths) for r in totals(spark).collect()}
    assert got == {
        ("Maine", 2020, 4): (21, 2),
        ("Maine", 2020, 5): (21, 2),
        ("Maine", 2021, 1): (4, 0),
        ("Maine", 2021, 2): (6, 3),
        ("Ohio", 2020, 3): (52, 6),
        # a negative correction counts as given
        ("Ohio", 2020, 4): (40, 8),
        # the null-dated row forms its own group
        ("Ohio", None, None): (1, 0),
    }
    assert dict(totals(spark).dtypes)["total_cases"] == "bigint"


def test_exact_sum_is_order_free(spark):
    df = spark.createDataFrame([("k", "2020-01-01", 0.1)] * 10 + [("k", "2020-01-02", 0.2)] * 5, "k string, d string, x double")
    df = df.withColumn("d", F.to_date("d"))
    exact = periods.monthly_totals(df, ["k"], "d", {"t": "x"}, scales={"t": 2}).first().t
    assert exact == 2.0


def test_peak_month_one_row_per_group_tie_to_earliest(spark):
    t = totals(spark)
    cases = {(r.state, r.year): (r.month, r.total_cases) for r in periods.peak_period(t, ["state", "year"], "total_cases").collect()}
    assert cases == {
        ("Maine", 2020): (4, 21),  # April and May tie at 21: the earliest month wins
        ("Maine", 2021): (2, 6),
        ("Ohio", 2020): (3, 52),
        ("Ohio", None): (None, 1),
    }
    deaths = {(r.state, r.year): (r.month, r.total_deaths) for r in periods.peak_period(t, ["state", "year"], "total_deaths").collect()}
    assert deaths == {("Maine", 2020): (4, 2), ("Maine", 2021): (2, 3), ("Ohio", 2020): (4, 8), ("Ohio", None): (None, 0)}


def test_peak_month_plan_has_group_limit_and_no_range_exchange(spark):
    plan = periods.peak_period(totals(spark), ["state", "year"], "total_cases")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert "WindowGroupLimit" in plan


def test_sorted_by_nulls_first(spark):
    rows = periods.sorted_by(totals(spark), ["state", "year", "month"]).collect()
    assert [(r.state, r.year, r.month) for r in rows][:5] == [
        ("Maine", 2020, 4),
        ("Maine", 2020, 5),
        ("Maine", 2021, 1),
        ("Maine", 2021, 2),
        ("Ohio", None, None),
    ]


def test_quarter_matches_floor_formula(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    df = df.withColumn("d", F.make_date(F.lit(2020), F.col("m"), F.lit(15)))
    got = periods.with_quarter(df, "d").collect()
    assert all(r.trimester == (r.m - 1) // 3 + 1 for r in got)


def test_monthly_totals_combine_before_the_shuffle(spark):
    """A hot key is summed map-side: the partial aggregate sits below the only exchange."""
    plan = totals(spark)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in below_exchange
