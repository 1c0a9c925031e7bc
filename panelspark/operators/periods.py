"""Calendar periods: year/month/quarter columns, monthly totals, and the peak period per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark import functions as PF


def with_year_month(df: DataFrame, date: str, year: str = "year", month: str = "month") -> DataFrame:
    """Add calendar ``year`` and ``month`` (ints) of the ``date`` column."""
    return df.withColumns({year: PF.year(date), month: PF.month(date)})


def with_quarter(df: DataFrame, date: str, quarter: str = "trimester") -> DataFrame:
    """Add the quarter 1-4 (int) of the ``date`` column."""
    return df.withColumn(quarter, PF.quarter(date))


def monthly_totals(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    measures: Mapping[str, str | Column],
    scales: Mapping[str, int | None] | None = None,
    year: str = "year",
    month: str = "month",
) -> DataFrame:
    """Sum each measure per (keys, year, month).

    ``measures`` maps an output name to a source column, e.g. ``{"total_cases": "cases"}``. Nulls are
    ignored, negative corrections count as given. ``scales`` (output name -> decimal places) sums a
    measure exactly as scaled integers (see :func:`panelspark.functions.exact_sum`); NaN and infinities count as in a plain sum.

    Plan: partial aggregate in every map task, one exchange on the group keys, final aggregate. A hot
    key is combined map-side before it shuffles, so skew does not reach one reducer.
    """
    scales = scales or {}
    dated = with_year_month(df, date, year, month)
    dated = PF.with_units(dated, {name: (src, scales.get(name)) for name, src in measures.items()})
    sums = [
        (F.sum(PF.col(src)) if scales.get(name) is None else PF.from_parts(PF.parts_of(name), scales[name])).alias(name)
        for name, src in measures.items()
    ]
    return dated.groupBy(*keys, year, month).agg(*sums)


def peak_period(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    tie: Sequence[str] = ("month",),
    output: Sequence[str] | None = None,
) -> DataFrame:
    """The one row with the largest ``measure`` in each ``keys`` group (``row_number() == 1``).

    Null measures sort last. Ties go to the smallest ``tie`` columns (the earliest month), so the result
    is deterministic where plain ``row_number`` would pick any tied row.

    The filter on ``row_number`` becomes a ``WindowGroupLimit`` that keeps one row per group in every map
    task before the exchange and once more after it.
    """
    order = [F.col(measure).desc_nulls_last()] + [F.col(t).asc_nulls_last() for t in tie]
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
    return ranked.select(*(output or [*keys, *tie, measure]))


def sorted_by(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Global ascending sort (nulls first) -- for output only: a range exchange, so never before a window."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in columns])
