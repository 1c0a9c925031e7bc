"""Property checks: the rewritten plans equal the plain formulations on random panels."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelspark.plans import panel_queries as Q
from panelspark.operators import leaders, panel, periods
from tests.test_leaders import ROW_LEVEL_SQL
from tests.test_panel import plain_lagged, rows

BASE = dt.date(2020, 1, 1)

panel_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),  # entity (null is an entity too); "a" tends to be hot
        st.one_of(st.none(), st.integers(0, 400)),  # day offset, or a null date
        st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4)),  # measure (quarters: exact in binary)
    ),
    min_size=1,
    max_size=40,
    unique_by=lambda r: (r[0], r[1]),  # one row per (entity, day) -- null days may repeat per entity only once
)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=panel_rows,
    partitions=st.sampled_from([None, 1, 2, 5, 30]),
    start=st.one_of(st.none(), st.integers(0, 400)),
    span=st.one_of(st.none(), st.integers(0, 200)),
)
def test_lagged_change_equals_plain_window(spark, data, partitions, start, span):
    df = spark.createDataFrame(
        [(k, None if d is None else BASE + dt.timedelta(days=d), v) for k, d, v in data], "k string, d date, v double"
    )
    lo = None if start is None else BASE + dt.timedelta(days=start)
    hi = None if (start is None or span is None) else lo + dt.timedelta(days=span)
    cols = ["k", "d", "v", "v_diff"]
    expected = rows(plain_lagged(df, ["k"], ["d"], ["v"], 2, lo, hi), cols)
    got = rows(panel.lagged_change(df, ["k"], ["d"], ["v"], 2, lo, hi, partitions=partitions), cols)
    assert got == expected


weekly_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", "D"]),
        st.integers(0, 700),  # day offset from 2020-01-01
        st.one_of(st.none(), st.integers(-3, 40)),  # deaths (integral: sums are exact)
        st.one_of(st.none(), st.integers(0, 40).map(lambda x: x / 8)),  # rate
    ),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(data=weekly_rows)
def test_quarter_peak_equals_row_level(spark, data):
    df = spark.createDataFrame(
        [(c, BASE + dt.timedelta(days=d), None if x is None else float(x), r) for c, d, x, r in data],
        "country string, start_date date, covid_deaths double, covid_deaths_per_100k double",
    )
    df.createOrReplaceTempView("weekly")
    expected = {tuple(r) for r in spark.sql(ROW_LEVEL_SQL).collect()}
    got, _ = leaders.quarter_leaders(
        df, "country", "start_date", "covid_deaths", "covid_deaths_per_100k", names=Q.COVID_NAMES
    )
    cols = ["country", "year", "trimester", "month", "country_covid_deaths", "avg_deaths_per100k", "monthly_covid_deaths"]
    assert {tuple(r) for r in got.select(*cols).collect()} == expected


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 23), st.integers(0, 5)), min_size=1, max_size=30))
def test_peak_period_is_max_with_earliest_tie(spark, data):
    df = spark.createDataFrame(
        [(k, dt.date(2020 + m // 12, m % 12 + 1, 1), v) for k, m, v in data], "k string, d date, v long"
    )
    totals = periods.monthly_totals(df, ["k"], "d", {"t": "v"})
    got = {(r.k, r.year): (r.month, r.t) for r in periods.peak_period(totals, ["k", "year"], "t").collect()}
    by_group: dict = {}
    for r in totals.collect():
        by_group.setdefault((r.k, r.year), []).append((r.month, r.t))
    for g, months in by_group.items():
        best = max(t for _, t in months)
        assert got[g] == (min(m for m, t in months if t == best), best)
