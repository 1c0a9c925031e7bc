import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.operators import panel
from tests.fixtures import county

D = dt.date
MEASURES = ["deaths_avg", "deaths_avg_per_100k", "cases_avg", "cases_avg_per_100k"]
OUT = ["date", "geoid", "cases_avg", "cases_avg_diff", "cases_avg_per_100k_diff"]


def plain_lagged(df, keys, order, measures, digits, start, end):
    """Brute force: the straightforward single-window form, range applied afterwards."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    out = df
    for m in measures:
        out = out.withColumn(
            f"{m}_diff",
            F.when(F.row_number().over(w) == 1, F.col(m)).otherwise(F.round(F.col(m) - F.lag(m).over(w), digits)),
        )
    return panel.in_date_range(out, order[0], start, end)


def rows(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_daily_change_hand_worked(spark):
    out = panel.lagged_change(county(spark), ["geoid"], ["date"], MEASURES, 3, "2020-03-30", "2020-04-15")
    got = {(r.date, r.geoid): (r.cases_avg, r.cases_avg_diff, r.cases_avg_per_100k_diff) for r in out.collect()}
    assert got == {
        # first row of the entity inside the range: raw, unrounded values
        (D(2020, 4, 2), "USA-1"): (1.5, 1.5, 0.25),
        (D(2020, 4, 3), "USA-1"): (2.25, 0.75, 0.125),
        (D(2020, 4, 4), "USA-1"): (3.0, 0.75, 0.125),
        # first day in range has a real difference from the row before the range
        (D(2020, 3, 30), "USA-2"): (12.5, 1.389, 0.3),
        # null value -> null difference, and the next row's previous value is that null
        (D(2020, 3, 31), "USA-2"): (None, None, 0.25),
        # 04-01 is missing: the previous *row* is used
        (D(2020, 4, 2), "USA-2"): (13.0, None, -0.05),
        # upper bound included, 04-16 excluded
        (D(2020, 4, 15), "USA-2"): (15.0, 2.0, 0.3),
        # the null-dated row sorts first, so 04-01 is not the entity's first row
        (D(2020, 4, 1), "USA-3"): (5.0, 1.0, 0.1),
    }


@pytest.mark.parametrize(
    "bounds", [("2020-03-30", "2020-04-15"), (None, None), ("2020-04-02", None), (None, "2020-04-02")]
)
@pytest.mark.parametrize("partitions", [None, 1, 2, 3, 5, 40])
def test_matches_plain_window_with_null_dates(spark, bounds, partitions):
    """Whatever the number of partitions: entities cut by their edges, several entities in one, more partitions than rows."""
    df = county(spark)
    expected = rows(plain_lagged(df, ["geoid"], ["date"], MEASURES, 3, *bounds), OUT)
    got = rows(panel.lagged_change(df, ["geoid"], ["date"], MEASURES, 3, *bounds, partitions=partitions), OUT)
    assert got == expected


def test_telescoping(spark):
    """first value + sum of differences = last value (no nulls, no range)."""
    df = county(spark).filter(F.col("geoid") == "USA-1")
    out = panel.lagged_change(df, ["geoid"], ["date"], ["cases_avg"], 3).collect()
    assert sum(r.cases_avg_diff for r in out) == pytest.approx(max(out, key=lambda r: r.date).cases_avg)


def hot_events(spark):
    """Events of one day, a third of them of one user."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev = ev.withColumn("ts", F.expr("ts - make_dt_interval(datediff(ts, DATE'2024-01-10'))"))
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))


@pytest.mark.parametrize("bounds", [("2024-01-10", "2024-01-10"), (None, None)])
def test_hot_entity_within_one_day(spark, bounds):
    ev = hot_events(spark)
    cols = ["user_id", "ts", "event_id", "value", "value_diff"]
    expected = rows(plain_lagged(ev, ["user_id"], ["ts", "event_id"], ["value"], 3, *bounds), cols)
    out = panel.lagged_change(ev, ["user_id"], ["ts", "event_id"], ["value"], 3, *bounds, partitions=24)
    assert rows(out, cols) == expected


def test_hot_entity_takes_partitions_by_its_rows(spark):
    """Also where its rows share one time and only the tie column differs."""
    for ev in (hot_events(spark), hot_events(spark).withColumn("ts", F.lit(dt.datetime(2024, 1, 10)))):
        n, parts = ev.count(), 24
        sizes = panel.in_pieces(ev, ["user_id"], ["ts", "event_id"], parts).filter("__copy = 0").groupBy("__piece", "user_id").count()
        hot = [r["count"] for r in sizes.filter("user_id = -1").collect()]
        assert len(hot) >= parts // 4 and max(hot) < 3 * n / parts


def test_no_keys_is_one_series(spark):
    ev = hot_events(spark)
    cols = ["event_id", "value_diff"]
    got = panel.lagged_change(ev, [], ["ts", "event_id"], ["value"], 3, partitions=7)
    w = Window.orderBy("ts", "event_id")
    plain = ev.withColumn("value_diff", F.when(F.row_number().over(w) == 1, F.col("value")).otherwise(F.round(F.col("value") - F.lag("value").over(w), 3)))
    assert rows(got, cols) == rows(plain, cols)


def test_repeated_rows_and_null_keys(spark):
    """A null key is one entity; equal rows are each other's previous row, wherever the partitions are cut."""
    data = [(k, dt.date(2024, 1, d), 1.0 * d) for k in (None, "a", "b") for d in (1, 2, 3, 4, 5)] * 3
    df = spark.createDataFrame(data, "k string, d date, v double").repartition(4)
    for partitions in (1, 4, 9, 60):
        got = rows(panel.lagged_change(df, ["k"], ["d"], ["v"], 3, partitions=partitions), ["k", "d", "v", "v_diff"])
        assert got == rows(plain_lagged(df, ["k"], ["d"], ["v"], 3, None, None), ["k", "d", "v", "v_diff"])


def test_input_stands_once_in_the_plan_and_no_job_runs_for_it(spark):
    """One scan, no join; nothing runs while the plan is built."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan only", "")
    ev = spark.read.schema("event_id long, ts timestamp_ntz, user_id long, value double").parquet("/root/testdata/sf0.001/events.parquet")
    out = panel.lagged_change(ev, ["user_id"], ["ts", "event_id"], ["value"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not tracker.getJobIdsForGroup("plan only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange ") == 2


def test_timestamp_range_includes_whole_end_day(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 14, 23, 59, 59), 1.0), (1, dt.datetime(2024, 1, 15, 0, 0, 0), 2.0)],
        "k int, ts timestamp_ntz, v double",
    )
    assert panel.in_date_range(df, "ts", "2024-01-14", "2024-01-14").count() == 1


def test_duplicate_order_check(spark):
    df = county(spark)
    assert panel.assert_unique_order(df, ["geoid"], ["date"]).count() == 0
    assert panel.assert_unique_order(df.union(df.limit(1)), ["geoid"], ["date"]).count() == 1


def test_plan_one_window_pruned_scan_pushed_bounds(spark, tmp_root):
    path = f"{tmp_root}/county_parquet"
    county(spark).write.parquet(path)
    df = spark.read.parquet(path)
    out = panel.lagged_change(df, ["geoid"], ["date"], MEASURES, 3, "2020-03-30", "2020-04-15").select(*OUT)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    # deaths differences are dropped from the plan; unused columns never leave the scan
    assert "deaths_avg" not in plan.split("Window [")[1].split("\n")[0]
    for line in plan.splitlines():
        if "ReadSchema" in line:
            schema = line.split("ReadSchema:")[1]
            assert "county" not in schema and "state" not in schema and "deaths" not in schema
    # earlier rows may be a previous row, later ones never are
    assert "LessThanOrEqual(date,2020-04-15)" in plan


@pytest.mark.parametrize("partitions", [1, 3, 20])
def test_pieces_across_a_dst_gap(spark, partitions):
    """Wall-clock timestamps around the 2024-03-10 spring-forward gap, with a DST session time zone."""
    data = [
        ("u", dt.datetime(2024, 3, 10, 1, 50), 1, 1.0),
        ("u", dt.datetime(2024, 3, 10, 2, 30), 2, 4.0),  # does not exist in New York
        ("u", dt.datetime(2024, 3, 10, 3, 10), 3, 9.0),
        ("u", dt.datetime(2024, 3, 10, 3, 40), 4, 16.0),
        ("v", dt.datetime(2024, 11, 3, 1, 30), 5, 1.0),  # falls in the autumn overlap
        ("v", dt.datetime(2024, 11, 3, 1, 45), 6, 3.0),
        ("v", dt.datetime(2024, 11, 3, 2, 15), 7, 6.0),
    ]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, id long, v double")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cols = ["k", "ts", "id", "v", "v_diff"]
        for bounds in [(None, None), ("2024-03-10", "2024-11-03")]:
            expected = rows(plain_lagged(df, ["k"], ["ts", "id"], ["v"], 3, *bounds), cols)
            got = rows(panel.lagged_change(df, ["k"], ["ts", "id"], ["v"], 3, *bounds, partitions=partitions), cols)
            assert got == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

