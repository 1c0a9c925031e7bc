"""The panel queries on the generated benchmark tables, each with an equivalent SQL oracle.

Every query reads whole tables (``<sf_dir>/<name>.parquet``). The mapping to the panel workload:

* daily county panel -> ``lineitem`` summed per (supplier, ship day), or ``events`` per user;
* state monthly totals -> ``lineitem`` per (supplier, year, month);
* weekly country panel -> ``orders`` per customer (``o_totalprice`` as measure and as rate).

Money is summed exactly (as decimals in both engines) so both engines get the
same doubles regardless of summation order. The oracles restate the plain row-level semantics -- not
the rewritten plans -- so they check the rewrites too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelspark import functions as PF
from panelspark import session as S
from panelspark import schemas, sinks, sources, timings
from panelspark.operators import averages, leaders, merge, panel, periods, profile
from panelspark.sources import driver_table

# ---------------------------------------------------------------- fixed parameters of the queries
EVENTS_RANGE = ("2024-01-08", "2024-01-14")
PANEL_RANGE = ("1998-03-30", "1998-04-15")
TOP_N = 5
KEY_SEGMENT = "MACHINERY"

ORDERS_NAMES = leaders.LeaderNames(
    quarter="trimester", entity_total="customer_total", entity_avg="avg_price", period_total="period_total"
)


# ---------------------------------------------------------------- Q1: lagged change


def lagged_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, change of ``value`` from the previous event; events of 2024-01-08..14."""
    ev = driver_table(spark, sf_dir, "events")
    out = panel.lagged_change(
        ev,
        ["user_id"],
        ["ts", "event_id"],
        ["value"],
        digits=3,
        start=EVENTS_RANGE[0],
        end=EVENTS_RANGE[1],
    )
    return out.select("user_id", "ts", "event_id", "value", "value_diff")


def lagged_change_events_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, change of ``value`` from the previous event over the whole history (no range)."""
    ev = driver_table(spark, sf_dir, "events")
    out = panel.lagged_change(ev, ["user_id"], ["ts", "event_id"], ["value"], digits=3)
    return out.select("user_id", "ts", "event_id", "value", "value_diff")


def daily_supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a daily panel: one row per (l_suppkey, ship_date) with four exact sums."""
    li = driver_table(spark, sf_dir, "lineitem")
    disc = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    measures = {
        "quantity": ("l_quantity", 2),
        "base_price": ("l_extendedprice", 2),
        "disc_price": (disc, 4),
        "charge": (disc * (F.lit(1) + F.col("l_tax")), 6),
    }
    taken = PF.with_units(li.withColumn("ship_date", F.to_date("l_shipdate")), measures)
    sums = [PF.from_parts(PF.parts_of(name), scale).alias(name) for name, (_, scale) in measures.items()]
    return taken.groupBy("l_suppkey", "ship_date").agg(*sums)


def lagged_change_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-on-day change of four measures per supplier, shown for 1998-03-30..04-15.

    As in the county query, all four differences are defined but only two are selected; Catalyst drops
    the other two (and their sums) from the plan.
    """
    daily = daily_supplier_panel(spark, sf_dir)
    out = panel.lagged_change(
        daily,
        ["l_suppkey"],
        ["ship_date"],
        ["quantity", "base_price", "disc_price", "charge"],
        digits=3,
        start=PANEL_RANGE[0],
        end=PANEL_RANGE[1],
    )
    return out.select("ship_date", "l_suppkey", "quantity", "quantity_diff", "base_price_diff")


# ---------------------------------------------------------------- Q2: monthly totals and peak month


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = driver_table(spark, sf_dir, "lineitem")
    return periods.monthly_totals(
        li,
        ["l_suppkey"],
        "l_shipdate",
        {"total_quantity": "l_quantity", "total_price": "l_extendedprice"},
        scales={"total_quantity": 2, "total_price": 2},
    )


def monthly_totals_non_finite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly totals of prices some of which are NaN or infinite: the total as a plain sum has it, and what kind it is."""
    k, price = F.col("l_orderkey"), F.col("l_extendedprice")
    odd = F.when(k % 500 == 0, float("nan")).when(k % 500 == 1, float("inf")).when(k % 500 == 2, float("-inf")).otherwise(price)
    li = driver_table(spark, sf_dir, "lineitem").withColumn("price", odd)
    totals = periods.monthly_totals(li, ["l_suppkey"], "l_shipdate", {"total": "price"}, scales={"total": 2})
    total = F.col("total")
    kind = F.when(F.isnan(total), "nan").when(total == float("inf"), "inf").when(total == float("-inf"), "-inf").otherwise("finite")
    finite = F.when(kind == "finite", total).alias("total")
    return totals.select("l_suppkey", "year", "month", finite, kind.alias("kind"))


def peak_month_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.peak_period(monthly_totals(spark, sf_dir), ["l_suppkey", "year"], "total_quantity")


def peak_month_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.peak_period(monthly_totals(spark, sf_dir), ["l_suppkey", "year"], "total_price")


def sorted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.sorted_by(monthly_totals(spark, sf_dir), ["l_suppkey", "year", "month"])


# ---------------------------------------------------------------- Q3: running totals and quarter leaders


def running_period_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-to-date total of all orders through each month."""
    orders = driver_table(spark, sf_dir, "orders")
    return leaders.period_totals(orders, "o_orderdate", "o_totalprice", measure_scale=2)


def running_entity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year-to-date total and mean order price per customer and month."""
    orders = driver_table(spark, sf_dir, "orders")
    return leaders.entity_running_totals(
        orders, "o_custkey", "o_orderdate", "o_totalprice", "o_totalprice", 2, 2, names=ORDERS_NAMES
    )


def _quarter(spark: SparkSession, sf_dir: str, mode: str) -> tuple[DataFrame, DataFrame]:
    orders = driver_table(spark, sf_dir, "orders")
    return leaders.quarter_leaders(
        orders,
        "o_custkey",
        "o_orderdate",
        "o_totalprice",
        "o_totalprice",
        n=TOP_N,
        mode=mode,
        measure_scale=2,
        rate_scale=2,
        names=ORDERS_NAMES,
    )


def quarter_peak_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarter(spark, sf_dir, "cumulative")[0]


def quarter_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarter(spark, sf_dir, "cumulative")[1]


def quarter_top_customers_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarter(spark, sf_dir, "calendar")[1]


# ---------------------------------------------------------------- profiling


def distinct_values_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(driver_table(spark, sf_dir, "documents"), "source")


def distinct_counts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_counts(driver_table(spark, sf_dir, "documents"), ["lang", "source"])


def distinct_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts of low- and high-cardinality columns of ``orders`` in one aggregation."""
    return profile.distinct_counts(
        driver_table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]
    )


def distinct_years_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(driver_table(spark, sf_dir, "orders"), PF.year("o_orderdate"), "year")


def rows_for_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rows_for_key(driver_table(spark, sf_dir, "customer"), "c_mktsegment", KEY_SEGMENT)


def numeric_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average of every numeric column of ``lineitem`` (strings and timestamps skipped), to 4 places."""
    return averages.average_numeric(driver_table(spark, sf_dir, "lineitem"), digits=4)


def sketched_distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile rows of ``orders`` per order year, written as a table and merged: exact rows and nulls, and whether the
    estimated distinct count is within its error bound of the exact one."""
    columns = ["o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"]
    orders = signed_orders(spark, sf_dir).join(driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey")
    root = S.scratch_path(spark, "profiles")
    sinks.write_table(profile.sketch_profile(orders, columns, [PF.year("o_orderdate").alias("year")]), root, "Profiles", "orders", mode="append")
    merged = profile.merge_profiles(sources.read_table(spark, root, "Profiles", "orders"))
    exact = profile.distinct_counts(orders, {c: c for c in columns}).select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column", "exact"))
    within = F.abs(F.col("n_distinct") - F.col("exact")) <= F.lit(profile.error_bound()) * F.col("exact")
    return merged.join(exact, "column").select("column", "n_rows", "n_nulls", within.alias("within_bound"))


# ---------------------------------------------------------------- sources and sinks


def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite replaces, append adds, the re-read returns what was written: all orders.

    Four writes to one table in the shared scratch folder: the 'P' orders, then the 'F' orders in their place, then the others
    and the 'P' orders once more behind these.
    """
    orders = driver_table(spark, sf_dir, "orders")
    root = S.scratch_path(spark, "round_trip")
    status = F.coalesce("o_orderstatus", F.lit(""))
    for rows, mode in ((status == "P", "overwrite"), (status == "F", "overwrite"), (~status.isin("F", "P"), "append"), (status == "P", "append")):
        sinks.write_table(orders.filter(rows), root, "copies", "orders", mode=mode)
    return sources.read_table(spark, root, "copies", "orders")


def versioned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders from a table with versions: written, overwritten, appended to and compacted."""
    orders = driver_table(spark, sf_dir, "orders")
    root = S.scratch_path(spark, "versions")
    open_orders = F.coalesce("o_orderstatus", F.lit("")) == "O"
    sinks.write_table(orders.filter(open_orders), root, "copies", "orders", versioned=True)
    sinks.write_table(orders.filter(~open_orders), root, "copies", "orders", versioned=True)
    sinks.write_table(orders.filter(open_orders), root, "copies", "orders", mode="append", versioned=True)
    sinks.compact(spark, root, "copies", "orders", most=1)
    return sources.read_table(spark, root, "copies", "orders")


def observed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and the last order day of an output, as the write itself gathered them (orders with some nulls)."""
    root, seen = S.scratch_path(spark, "observed"), Observation()
    rows = signed_orders(spark, sf_dir).withColumn("o_orderdate", F.to_date("o_orderdate"))
    sinks.write_table(rows, root, "copies", "orders", observation=seen)
    timings.log_output(spark, seen.get, root, "copies", ("copies", "orders"))
    log = sources.read_table(spark, root, "copies", timings.METRICS_TABLE)
    nulls = [F.element_at("nulls", c).alias(f"null_{c}") for c in ("o_orderkey", "o_orderdate", "o_totalprice")]
    return log.select("output", "n_rows", *nulls, F.element_at("latest", "o_orderdate").alias("latest_day"))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` written as CSV with a header, read back with an explicit schema (matched by name)."""
    orders = driver_table(spark, sf_dir, "orders")
    path = S.scratch_path(spark, "csv")
    sinks.write_csv(orders, path)
    return sources.read_csv(spark, path, schema=orders.schema)


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as CSV with some texts in number columns: the keys of the rows that convert, and every value that does not."""
    orders = driver_table(spark, sf_dir, "orders")
    key, path = F.col("o_orderkey"), S.scratch_path(spark, "csv")
    customer = F.when(key % 10 == 0, F.concat(F.lit("C-"), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    price = F.when(F.col("o_orderstatus") == "P", "unknown").otherwise(F.col("o_totalprice").cast("string"))
    sinks.write_csv(orders.withColumns({"o_custkey": customer, "o_totalprice": price}), path)
    good, bad = sources.divert_csv(spark, path, orders.schema, S.scratch_path(spark, "diverted"))
    read_from = F.get_json_object("line", "$.o_orderkey").cast(orders.schema["o_orderkey"].dataType)
    nothing = F.lit(None).cast("string")
    kept = good.select("o_orderkey", "o_custkey", "o_totalprice", nothing.alias("bad_column"), nothing.alias("bad_text"))
    rest = bad.select(read_from.alias("o_orderkey"), F.col("column").alias("bad_column"), F.col("text").alias("bad_text"))
    return kept.unionByName(rest, allowMissingColumns=True)


def json_records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` exported as JSON arrays of records (one file per partition), read back."""
    events = driver_table(spark, sf_dir, "events")
    path = S.scratch_path(spark, "json")
    sinks.write_json_records(events, path)
    return sources.read_json_records(spark, path, schema=events.schema)


def json_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` exported as indented JSON arrays, one to a file, read back by cutting the files at the records' ends."""
    events = driver_table(spark, sf_dir, "events")
    path = S.scratch_path(spark, "json_documents")
    sinks.write_json_records(events, path, per_array=50_000, layout="document")
    return sources.read_json_records(spark, path, schema=events.schema, layout="document")


def _timed_peak_month(spark: SparkSession, sf_dir: str, root: str) -> dict[str, float]:
    timer = timings.StageTimer()
    with timer.stage("load"):
        li = driver_table(spark, sf_dir, "lineitem")
    with timer.stage("process"):
        totals = periods.monthly_totals(li, ["l_suppkey"], "l_shipdate", {"total_quantity": "l_quantity"})
        peak = periods.peak_period(totals, ["l_suppkey", "year"], "total_quantity")
    with timer.stage("write"):
        sinks.write_table(peak, root, "Query2", "max_quantity_per_year")
    return timer.record()


def timing_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two timed runs of the peak-month job, appended to the timing log and read back: what can be checked of it.

    Runs, runs with all stages, runs whose total is at least the sum of the stages, and the rows that the job wrote.
    """
    root = S.scratch_path(spark, "timings")
    for _ in range(2):
        timings.log_run(spark, _timed_peak_month(spark, sf_dir, root), root, "Query2")
    log = sources.read_table(spark, root, "Query2", "Execution_Times")
    stages = [F.col(f"{s}_time") for s in timings.STAGES]
    whole = stages[0] + stages[1] + stages[2]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    checked = log.select(
        one.alias("n_runs"),
        (F.least(*stages) >= 0).cast("long").alias("n_with_stages"),
        (F.col("Total_time") >= whole - 1e-6).cast("long").alias("n_with_total"),
        none.alias("n_written"),
    )
    names = checked.columns
    written = sources.read_table(spark, root, "Query2", "max_quantity_per_year").select(none, none, none, one)
    return checked.union(written).agg(*[F.sum(n).alias(n) for n in names])


def timing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average of every numeric field of exported records: ``lineitem`` as timing records with an id."""
    records = driver_table(spark, sf_dir, "lineitem").select(
        F.struct(F.col("l_orderkey").cast("string").alias("$oid")).alias("_id"),
        F.col("l_extendedprice").alias("Total_time"),
        F.col("l_quantity").alias("load_time"),
        F.col("l_discount").alias("process_time"),
        F.col("l_tax").alias("write_time"),
    )
    path = S.scratch_path(spark, "timing_export")
    sinks.write_json_records(records, path)
    return averages.average_numeric(sources.read_json_records(spark, path, schemas.TIMING_EXPORT), digits=4)


def mixed_document_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of documents whose ``load_time`` is a number, a text or absent, by the values (``lineitem`` as such documents)."""
    k = F.col("l_orderkey")
    total, load = F.col("l_extendedprice").alias("Total_time"), F.col("l_quantity").alias("load_time")
    text = F.when(k % 5 == 0, F.to_json(F.struct(total, F.lit("n/a").alias("load_time"))))
    text = text.when(k % 7 == 0, F.to_json(F.struct(total, F.array(load).alias("other")))).otherwise(F.to_json(F.struct(total, load)))
    path = S.scratch_path(spark, "mixed_documents")
    driver_table(spark, sf_dir, "lineitem").select(text.alias("value")).write.text(path)
    return averages.average_of_documents(sources.read_json_texts(spark, path), digits=4)


def keyed_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` inserted by key in two overlapping parts, the second one twice: every customer once, those without a key too.

    Customers of one segment have no key; theirs is made from the content.
    """
    customer = driver_table(spark, sf_dir, "customer")
    keyed = customer.withColumn("_id", F.when(F.col("c_mktsegment") != KEY_SEGMENT, F.col("c_custkey").cast("string")))
    root = S.scratch_path(spark, "keyed_insert")
    parts = (F.col("c_nationkey") <= 15, F.col("c_nationkey") >= 10, F.col("c_nationkey") >= 10)
    for i, part in enumerate(parts):
        existing = sources.read_table(spark, root, "copies", "customer") if i else None
        sinks.write_table(merge.new_rows(keyed.filter(part), existing, "_id"), root, "copies", "customer", mode="append")
    made = F.length("_id") == 64
    return sources.read_table(spark, root, "copies", "customer").select(*customer.columns, made.alias("key_made"))


# ---------------------------------------------------------------- rows that filters and null handling have to see


def signed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with some prices null, zero or negative and some dates null (see _SIGNED_SQL)."""
    k = F.col("o_orderkey")
    price = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, 0.0).when(k % 5 == 2, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    date = F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderdate"))
    return driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", date.alias("o_orderdate"), price.alias("o_totalprice"))


def _signed_quarter(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    names = ("o_custkey", "o_orderdate", "o_totalprice", "o_totalprice")
    return leaders.quarter_peak(signed_orders(spark, sf_dir), *names, mode=mode, measure_scale=2, rate_scale=2, names=ORDERS_NAMES)


def quarter_rows_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter rows where prices may be null, zero or negative and dates null."""
    return _signed_quarter(spark, sf_dir, "cumulative")


def quarter_rows_with_nulls_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed_quarter(spark, sf_dir, "calendar")


def distinct_counts_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts in which null is a value of some columns."""
    return profile.distinct_counts(signed_orders(spark, sf_dir), ["o_custkey", "o_orderdate", "o_totalprice"])


# ---------------------------------------------------------------- registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lagged_change_events": lagged_change_events,
    "lagged_change_events_all": lagged_change_events_all,
    "lagged_change_panel": lagged_change_panel,
    "monthly_totals": monthly_totals,
    "monthly_totals_non_finite": monthly_totals_non_finite,
    "peak_month_quantity": peak_month_quantity,
    "peak_month_price": peak_month_price,
    "sorted_totals": sorted_totals,
    "running_period_totals": running_period_totals,
    "running_entity_totals": running_entity_totals,
    "quarter_peak_rows": quarter_peak_rows,
    "quarter_top_customers": quarter_top_customers,
    "quarter_top_customers_calendar": quarter_top_customers_calendar,
    "distinct_values_source": distinct_values_source,
    "distinct_counts_documents": distinct_counts_documents,
    "distinct_counts_orders": distinct_counts_orders,
    "distinct_years_orders": distinct_years_orders,
    "rows_for_key": rows_for_key,
    "numeric_averages": numeric_averages,
    "table_round_trip": table_round_trip,
    "versioned_round_trip": versioned_round_trip,
    "observed_write": observed_write,
    "csv_scan": csv_scan,
    "csv_rejects": csv_rejects,
    "json_records_scan": json_records_scan,
    "json_document_scan": json_document_scan,
    "timing_log": timing_log,
    "timing_report": timing_report,
    "sketched_distinct_counts": sketched_distinct_counts,
    "mixed_document_averages": mixed_document_averages,
    "keyed_insert": keyed_insert,
    "quarter_rows_with_nulls": quarter_rows_with_nulls,
    "quarter_rows_with_nulls_calendar": quarter_rows_with_nulls_calendar,
    "distinct_counts_with_nulls": distinct_counts_with_nulls,
}


def _date(s: str) -> str:
    return dt.date.fromisoformat(s).isoformat()


def _next_day(s: str) -> str:
    return (dt.date.fromisoformat(s) + dt.timedelta(days=1)).isoformat()

# ---------------------------------------------------------------- oracle SQL (DuckDB dialect)

_MONTHLY_SQL = """
SELECT l_suppkey,
       CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM lineitem
GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)
"""

# Row-level form of the quarter query, as the plain windows over every order row compute it.
_ORDER_ROWS_SQL = """
WITH base AS (
    SELECT o_custkey,
           CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(floor((month(o_orderdate) - 1) / 3) + 1 AS INTEGER) AS trimester,
           CAST(o_totalprice AS DECIMAL(18,2)) AS price
    FROM orders
    WHERE o_totalprice > 0
),
win AS (
    SELECT *,
           sum(price) OVER (PARTITION BY year ORDER BY month) AS period_ytd,
           sum(price) OVER (PARTITION BY year, o_custkey ORDER BY month) AS cust_ytd,
           count(price) OVER (PARTITION BY year, o_custkey ORDER BY month) AS cust_n
    FROM base
),
peak AS (
    SELECT *, max(period_ytd) OVER (PARTITION BY year ORDER BY trimester) AS period_max
    FROM win
)
SELECT DISTINCT o_custkey, year, trimester, month,
       CAST(cust_ytd AS DOUBLE) AS customer_total,
       round(CAST(cust_ytd AS DOUBLE) / cust_n, 4) AS avg_price,
       CAST(period_ytd AS DOUBLE) AS period_total
FROM peak
WHERE period_ytd = period_max
"""

_CALENDAR_ROWS_SQL = """
WITH base AS (
    SELECT o_custkey,
           CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           CAST(floor((month(o_orderdate) - 1) / 3) + 1 AS INTEGER) AS trimester,
           CAST(o_totalprice AS DECIMAL(18,2)) AS price
    FROM orders
    WHERE o_totalprice > 0
),
cust AS (
    SELECT o_custkey, year, trimester, month, sum(price) AS s, count(price) AS n
    FROM base GROUP BY o_custkey, year, trimester, month
),
months AS (
    SELECT year, trimester, month, sum(price) AS t FROM base GROUP BY year, trimester, month
),
chosen AS (
    SELECT * FROM months
    QUALIFY row_number() OVER (PARTITION BY year, trimester ORDER BY t DESC, month) = 1
)
SELECT c.o_custkey, c.year, c.trimester, c.month,
       CAST(c.s AS DOUBLE) AS customer_total,
       round(CAST(c.s AS DOUBLE) / c.n, 4) AS avg_price,
       CAST(m.t AS DOUBLE) AS period_total
FROM cust c JOIN chosen m ON c.year IS NOT DISTINCT FROM m.year AND c.month IS NOT DISTINCT FROM m.month
"""

# Orders with null, zero and negative prices and null dates, as signed_orders makes them.
_SIGNED_SQL = """(
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
           CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 0.0 WHEN 2 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM orders
)"""

ORACLE_SQL: dict[str, str] = {
    "quarter_rows_with_nulls": _ORDER_ROWS_SQL.replace("FROM orders", f"FROM {_SIGNED_SQL}"),
    "quarter_rows_with_nulls_calendar": _CALENDAR_ROWS_SQL.replace("FROM orders", f"FROM {_SIGNED_SQL}"),
    "distinct_counts_with_nulls": f"""
SELECT (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM {_SIGNED_SQL})) AS n_o_custkey,
       (SELECT count(*) FROM (SELECT DISTINCT o_orderdate FROM {_SIGNED_SQL})) AS n_o_orderdate,
       (SELECT count(*) FROM (SELECT DISTINCT o_totalprice FROM {_SIGNED_SQL})) AS n_o_totalprice
""",
    "timing_log": """
SELECT CAST(2 AS BIGINT) AS n_runs, CAST(2 AS BIGINT) AS n_with_stages, CAST(2 AS BIGINT) AS n_with_total,
       (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, year(l_shipdate) FROM lineitem)) AS n_written
""",
    "timing_report": """
SELECT round(avg(l_extendedprice), 4) AS Total_time, round(avg(l_quantity), 4) AS load_time,
       round(avg(l_discount), 4) AS process_time, round(avg(l_tax), 4) AS write_time
FROM lineitem
""",
    "lagged_change_events": f"""
SELECT user_id, ts, event_id, value, value_diff FROM (
    SELECT user_id, ts, event_id, value,
           CASE WHEN row_number() OVER w = 1 THEN value
                ELSE round(value - lag(value) OVER w, 3) END AS value_diff
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST)
)
WHERE ts >= TIMESTAMP '{_date(EVENTS_RANGE[0])} 00:00:00' AND ts < TIMESTAMP '{_next_day(EVENTS_RANGE[1])} 00:00:00'
""",
    "lagged_change_events_all": """
SELECT user_id, ts, event_id, value,
       CASE WHEN row_number() OVER w = 1 THEN value
            ELSE round(value - lag(value) OVER w, 3) END AS value_diff
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST)
""",
    "lagged_change_panel": f"""
WITH daily AS (
    SELECT l_suppkey, CAST(l_shipdate AS DATE) AS ship_date,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS base_price
    FROM lineitem
    GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
)
SELECT ship_date, l_suppkey, quantity, quantity_diff, base_price_diff FROM (
    SELECT ship_date, l_suppkey, quantity,
           CASE WHEN row_number() OVER w = 1 THEN quantity
                ELSE round(quantity - lag(quantity) OVER w, 3) END AS quantity_diff,
           CASE WHEN row_number() OVER w = 1 THEN base_price
                ELSE round(base_price - lag(base_price) OVER w, 3) END AS base_price_diff
    FROM daily
    WINDOW w AS (PARTITION BY l_suppkey ORDER BY ship_date ASC NULLS FIRST)
)
WHERE ship_date >= DATE '{PANEL_RANGE[0]}' AND ship_date <= DATE '{PANEL_RANGE[1]}'
""",
    "monthly_totals": _MONTHLY_SQL,
    "monthly_totals_non_finite": """
WITH kinds AS (
    SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
           count(*) FILTER (l_orderkey % 500 = 0) AS n_nan, count(*) FILTER (l_orderkey % 500 = 1) AS n_up,
           count(*) FILTER (l_orderkey % 500 = 2) AS n_down,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_orderkey % 500 > 2) AS DOUBLE) AS finite
    FROM lineitem GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)
),
named AS (
    SELECT *, CASE WHEN n_nan > 0 OR (n_up > 0 AND n_down > 0) THEN 'nan' WHEN n_up > 0 THEN 'inf' WHEN n_down > 0 THEN '-inf' ELSE 'finite' END AS kind
    FROM kinds
)
SELECT l_suppkey, year, month, CASE WHEN kind = 'finite' THEN finite END AS total, kind FROM named
""",
    "peak_month_quantity": f"""
SELECT l_suppkey, year, month, total_quantity FROM ({_MONTHLY_SQL})
QUALIFY row_number() OVER (PARTITION BY l_suppkey, year ORDER BY total_quantity DESC NULLS LAST, month) = 1
""",
    "peak_month_price": f"""
SELECT l_suppkey, year, month, total_price FROM ({_MONTHLY_SQL})
QUALIFY row_number() OVER (PARTITION BY l_suppkey, year ORDER BY total_price DESC NULLS LAST, month) = 1
""",
    "sorted_totals": f"SELECT * FROM ({_MONTHLY_SQL}) ORDER BY l_suppkey, year, month",
    "running_period_totals": """
SELECT year, month, CAST(sum(t) OVER (PARTITION BY year ORDER BY month) AS DOUBLE) AS period_total
FROM (
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
    FROM orders WHERE o_totalprice > 0
    GROUP BY year(o_orderdate), month(o_orderdate)
)
""",
    "running_entity_totals": """
SELECT DISTINCT o_custkey, year, month,
       CAST(cust_ytd AS DOUBLE) AS customer_total,
       round(CAST(cust_ytd AS DOUBLE) / cust_n, 4) AS avg_price
FROM (
    SELECT o_custkey, year, month,
           sum(price) OVER (PARTITION BY year, o_custkey ORDER BY month) AS cust_ytd,
           count(price) OVER (PARTITION BY year, o_custkey ORDER BY month) AS cust_n
    FROM (
        SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(o_totalprice AS DECIMAL(18,2)) AS price
        FROM orders WHERE o_totalprice > 0
    )
)
""",
    "quarter_peak_rows": _ORDER_ROWS_SQL,
    "quarter_top_customers": f"""
SELECT * FROM ({_ORDER_ROWS_SQL})
QUALIFY rank() OVER (PARTITION BY year, trimester ORDER BY customer_total DESC NULLS LAST) <= {TOP_N}
""",
    "quarter_top_customers_calendar": f"""
SELECT * FROM ({_CALENDAR_ROWS_SQL})
QUALIFY rank() OVER (PARTITION BY year, trimester ORDER BY customer_total DESC NULLS LAST) <= {TOP_N}
""",
    "distinct_values_source": "SELECT DISTINCT source FROM documents",
    "distinct_counts_documents": """
SELECT (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents)) AS n_lang,
       (SELECT count(*) FROM (SELECT DISTINCT source FROM documents)) AS n_source
""",
    "distinct_counts_orders": """
SELECT (SELECT count(*) FROM (SELECT DISTINCT o_orderstatus FROM orders)) AS n_o_orderstatus,
       (SELECT count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)) AS n_o_orderpriority,
       (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders)) AS n_o_custkey
""",
    "distinct_years_orders": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
    "rows_for_key": f"SELECT * FROM customer WHERE c_mktsegment = '{KEY_SEGMENT}'",
    "numeric_averages": """
SELECT round(avg(l_orderkey), 4) AS l_orderkey, round(avg(l_partkey), 4) AS l_partkey,
       round(avg(l_suppkey), 4) AS l_suppkey, round(avg(l_linenumber), 4) AS l_linenumber,
       round(avg(l_quantity), 4) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice,
       round(avg(l_discount), 4) AS l_discount, round(avg(l_tax), 4) AS l_tax
FROM lineitem
""",
    "table_round_trip": "SELECT * FROM orders",
    "sketched_distinct_counts": f"""
SELECT "column", (SELECT count(*) FROM orders) AS n_rows, n_nulls, TRUE AS within_bound FROM (
    SELECT 'o_custkey' AS "column", count(*) FILTER (o_custkey IS NULL) AS n_nulls FROM {_SIGNED_SQL}
    UNION ALL SELECT 'o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM {_SIGNED_SQL}
    UNION ALL SELECT 'o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM {_SIGNED_SQL}
    UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority IS NULL) FROM orders
)
""",
    "mixed_document_averages": """
SELECT 'Total_time' AS field, round(avg(l_extendedprice), 4) AS average, count(*) AS n_values FROM lineitem
UNION ALL
SELECT 'load_time', round(avg(l_quantity), 4), count(*) FROM lineitem WHERE l_orderkey % 5 <> 0 AND l_orderkey % 7 <> 0
""",
    "keyed_insert": f"SELECT *, c_mktsegment = '{KEY_SEGMENT}' AS key_made FROM customer",
    "versioned_round_trip": "SELECT * FROM orders",
    "observed_write": f"""
SELECT 'copies.orders' AS output, count(*) AS n_rows, count(*) FILTER (o_orderkey IS NULL) AS null_o_orderkey,
       count(*) FILTER (o_orderdate IS NULL) AS null_o_orderdate, count(*) FILTER (o_totalprice IS NULL) AS null_o_totalprice,
       CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS latest_day
FROM {_SIGNED_SQL}
""",
    "csv_scan": "SELECT * FROM orders",
    "csv_rejects": """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS bad_column, CAST(NULL AS VARCHAR) AS bad_text
FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderstatus IS DISTINCT FROM 'P'
UNION ALL
SELECT o_orderkey, NULL, NULL, 'o_custkey', 'C-' || o_custkey FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT o_orderkey, NULL, NULL, 'o_totalprice', 'unknown' FROM orders WHERE o_orderstatus = 'P'
""",
    "json_records_scan": "SELECT * FROM events",
    "json_document_scan": "SELECT * FROM events",
}
