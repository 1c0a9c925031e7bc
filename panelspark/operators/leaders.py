"""Year-to-date totals, the chosen month of each quarter, and the top entities in it.

Semantics of the cumulative mode (the default):

* rows with ``measure > 0`` only (null, zero and negative rows are dropped before every sum);
* ``period_total`` -- year-to-date total over **all** entities, through the row's month;
* ``entity_total`` -- year-to-date total of the entity through the month; ``entity_avg`` -- year-to-date
  mean of the entity's non-null ``rate`` values, rounded to 4 places;
* for each (year, quarter) the rows whose ``period_total`` equals the running maximum of
  ``period_total`` over the year's quarters so far. Year-to-date totals only grow, so that is the last
  month with data in the quarter;
* ``top_n``: ``rank() <= n`` by ``entity_total`` per (year, quarter) -- ties at the edge give more than
  n rows.

``mode="calendar"`` is an addition of ours: plain monthly sums instead of year-to-date ones, and the
month with the largest all-entity total in each quarter (ties to the earliest month).

Plan
----
Rows are first aggregated to one per (entity, year, month) -- partial aggregation in each map task, so a
hot entity is combined before it shuffles. Running sums are windows over that table partitioned by
(entity, year): at most 12 rows per window group. The all-entity month table has at most 12 rows per
year, so it is small by construction (12 x number of years); the chosen months are broadcast into the
join. The rank filter becomes a partial ``WindowGroupLimit`` before the exchange, so each map task sends
at most n rows (plus ties) per quarter to the final rank.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark import functions as PF

YEAR, MONTH = "year", "month"


@dataclass(frozen=True)
class LeaderNames:
    """Output column names."""

    quarter: str = "trimester"
    entity_total: str = "entity_total"
    entity_avg: str = "entity_avg"
    period_total: str = "period_total"


def prepare(df: DataFrame, entity: str, date: str, measure: str, rate: str, positive_only: bool = True) -> DataFrame:
    """(entity, year, month, measure, rate), keeping only rows with ``measure > 0`` when asked."""
    values = [measure] if rate == measure else [measure, rate]
    out = df.select(entity, PF.year(date).alias(YEAR), PF.month(date).alias(MONTH), *values)
    if positive_only:
        out = out.filter(F.col(measure) > 0)
    return out


def _sum(name: str, c: str, scale: int | None):
    """A sum of ``c``; with a scale, the exact one as a struct, of what ``with_units`` took apart under ``name``."""
    return PF.parts_of(name) if scale is not None else F.sum(c)


def _is_exact(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StructType)


def _total(df: DataFrame, c: str, over=None):
    """The sum of the sums in column ``c``, over a window if one is given."""
    if _is_exact(df, c):
        return PF.added(c, over)
    return F.sum(c).over(over) if over is not None else F.sum(c)


def _number(df: DataFrame, c: str, scale: int | None):
    """The sum in column ``c`` as a plain number."""
    return PF.from_parts(c, scale) if _is_exact(df, c) else F.col(c)


def _order(df: DataFrame, c: str):
    return PF.parts_order(c) if _is_exact(df, c) else F.col(c)


def entity_months(
    prepared: DataFrame, entity: str, measure: str, rate: str, measure_scale=None, rate_scale=None
) -> DataFrame:
    """One row per (entity, year, month): measure sum, rate sum and count of non-null rates.

    Sums stay exact structs when a scale is given (order-free); see :func:`finish`.
    """
    taken = PF.with_units(prepared, {"m": (measure, measure_scale), "r": (rate, rate_scale)})
    return taken.groupBy(entity, YEAR, MONTH).agg(
        _sum("m", measure, measure_scale).alias("__m"),
        _sum("r", rate, rate_scale).alias("__r"),
        F.count(rate).alias("__n"),
    )


def running_totals(months: DataFrame, entity: str) -> DataFrame:
    """Year-to-date sums per entity over the (entity, year, month) table."""
    w = Window.partitionBy(entity, YEAR).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return months.withColumns({c: _total(months, c, w) for c in ("__m", "__r", "__n")})


def finish(df: DataFrame, names: LeaderNames, measure_scale, rate_scale, digits: int = 4) -> DataFrame:
    """Name the entity total and the rounded mean of the non-null rates (null when there is none)."""
    avg = F.try_divide(_number(df, "__r", rate_scale), F.col("__n").cast("double"))
    return df.withColumns(
        {
            names.entity_total: _number(df, "__m", measure_scale),
            names.entity_avg: F.round(avg, digits),
        }
    )


def period_months(prepared: DataFrame, measure: str, measure_scale=None, cumulative: bool = True) -> DataFrame:
    """All-entity total per (year, month) -- at most 12 rows per year -- year-to-date when cumulative.

    Aggregated straight from the rows: the partial aggregate leaves at most one row per (year, month) in
    each map task, so its shuffle is negligible next to the entity-month one.
    """
    total = _total(prepared, measure) if _is_exact(prepared, measure) else _sum("p", measure, measure_scale)
    months = PF.with_units(prepared, {"p": (measure, measure_scale)}).groupBy(YEAR, MONTH).agg(total.alias("__p"))
    if cumulative:
        w = Window.partitionBy(YEAR).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        months = months.withColumn("__p", _total(months, "__p", w))
    return months.withColumn("__q", PF.quarter_of_month(MONTH))


def chosen_months(periods: DataFrame, mode: str = "cumulative") -> DataFrame:
    """(year, month, quarter, period total) of the month(s) each quarter reports."""
    total = _order(periods, "__p")
    if mode == "cumulative":
        w = Window.partitionBy(YEAR).orderBy("__q").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        marked = periods.withColumn("__now", total).withColumn("__max", F.max("__now").over(w))
        return marked.filter(F.col("__now") == F.col("__max")).drop("__now", "__max")
    if mode == "calendar":
        w = Window.partitionBy(YEAR, "__q").orderBy(total.desc_nulls_last(), F.col(MONTH))
        return periods.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    raise ValueError(f"mode must be 'cumulative' or 'calendar', got {mode!r}")


def quarter_peak(
    df: DataFrame,
    entity: str,
    date: str,
    measure: str,
    rate: str,
    mode: str = "cumulative",
    positive_only: bool = True,
    measure_scale: int | None = None,
    rate_scale: int | None = None,
    names: LeaderNames = LeaderNames(),
) -> DataFrame:
    """One row per entity with data in each quarter's chosen month.

    Columns: ``entity, year, <quarter>, month, <entity_total>, <entity_avg>, <period_total>``.
    The month table is aggregated straight from the rows (a second, column-pruned scan); to scan a
    costly source once, materialise :func:`entity_months` and use :func:`quarter_peak_from_months`.
    """
    prepared = prepare(df, entity, date, measure, rate, positive_only)
    monthly = entity_months(prepared, entity, measure, rate, measure_scale, rate_scale)
    periods = period_months(prepared, measure, measure_scale, mode == "cumulative")
    return quarter_peak_from_months(monthly, entity, mode, measure_scale, rate_scale, names, periods)


def quarter_peak_from_months(
    monthly: DataFrame,
    entity: str,
    mode: str = "cumulative",
    measure_scale: int | None = None,
    rate_scale: int | None = None,
    names: LeaderNames = LeaderNames(),
    periods: DataFrame | None = None,
) -> DataFrame:
    """:func:`quarter_peak` from the (entity, year, month) table of :func:`entity_months`.

    Without ``periods`` the all-entity month table is summed from ``monthly`` itself, so a checkpointed
    ``monthly`` makes the whole query read its source once.
    """
    cumulative = mode == "cumulative"
    if periods is None:
        periods = period_months(monthly.withColumnRenamed("__m", "__v"), "__v", None, cumulative)
    ent = running_totals(monthly, entity) if cumulative else monthly
    ent = finish(ent, names, measure_scale, rate_scale)
    months = chosen_months(periods, mode).select(
        YEAR, MONTH, F.col("__q").alias(names.quarter), _number(periods, "__p", measure_scale).alias(names.period_total)
    )
    # Bounded by construction: at most 12 rows per calendar year.
    # Null matches null: rows without a date have a null year, quarter and month, and stay.
    months = months.withColumnsRenamed({YEAR: "__y", MONTH: "__mo"})
    same = F.col(YEAR).eqNullSafe(F.col("__y")) & F.col(MONTH).eqNullSafe(F.col("__mo"))
    joined = ent.join(F.broadcast(months), same, "inner")
    return joined.select(entity, YEAR, names.quarter, MONTH, names.entity_total, names.entity_avg, names.period_total)


def period_totals(
    df: DataFrame,
    date: str,
    measure: str,
    measure_scale: int | None = None,
    cumulative: bool = True,
    positive_only: bool = True,
    name: str = "period_total",
) -> DataFrame:
    """(year, month, <name>): the all-entity total of each month, year-to-date when cumulative."""
    prepared = df.select(PF.year(date).alias(YEAR), PF.month(date).alias(MONTH), measure)
    if positive_only:
        prepared = prepared.filter(F.col(measure) > 0)
    months = period_months(prepared, measure, measure_scale, cumulative)
    return months.select(YEAR, MONTH, _number(months, "__p", measure_scale).alias(name))


def entity_running_totals(
    df: DataFrame,
    entity: str,
    date: str,
    measure: str,
    rate: str,
    measure_scale: int | None = None,
    rate_scale: int | None = None,
    positive_only: bool = True,
    names: LeaderNames = LeaderNames(),
) -> DataFrame:
    """(entity, year, month, <entity_total>, <entity_avg>): year-to-date per entity and month."""
    prepared = prepare(df, entity, date, measure, rate, positive_only)
    ytd = running_totals(entity_months(prepared, entity, measure, rate, measure_scale, rate_scale), entity)
    ytd = finish(ytd, names, measure_scale, rate_scale)
    return ytd.select(entity, YEAR, MONTH, names.entity_total, names.entity_avg)


def top_n(df: DataFrame, group: Sequence[str], measure: str, n: int, output: Sequence[str] | None = None) -> DataFrame:
    """Rows with ``rank() <= n`` by ``measure`` (descending, nulls last) within each ``group``.

    Spark plans the filter as a partial group limit before the exchange, so each task sends on at most n
    rows (and ties) of a group.
    """
    w = Window.partitionBy(*group).orderBy(F.col(measure).desc_nulls_last())
    ranked = df.withColumn("__rank", F.rank().over(w)).filter(F.col("__rank") <= n)
    return ranked.select(*(output or df.columns))


def quarter_leaders(
    df: DataFrame,
    entity: str,
    date: str,
    measure: str,
    rate: str,
    n: int = 5,
    mode: str = "cumulative",
    positive_only: bool = True,
    measure_scale: int | None = None,
    rate_scale: int | None = None,
    names: LeaderNames = LeaderNames(),
) -> tuple[DataFrame, DataFrame]:
    """(quarter rows, top-n of them per (year, quarter))."""
    rows = quarter_peak(df, entity, date, measure, rate, mode, positive_only, measure_scale, rate_scale, names)
    return rows, top_n(rows, [YEAR, names.quarter], names.entity_total, n)
