"""Change from the previous row of each entity (day-on-day difference of panel measures).

Semantics (per entity, rows ordered by ``order``; nulls in the order columns sort first):

* ``<m>_diff = round(m - m_of_previous_row, digits)`` -- the previous *row*, not the previous calendar
  day; a null value on either side gives null;
* the first row of an entity gets its raw, unrounded value;
* an optional inclusive day range ``[start, end]`` is applied *after* the differences, so the first day
  in range has a real difference when the entity has earlier rows.

Plan
----
One plan for every entity, whatever its share of the rows:

1. one range exchange by (keys, order): neighbouring rows lie in one partition or on both sides of a partition's edge, and an entity
   with many rows takes as many partitions as its rows fill;
2. each partition is sorted downwards, so its last row is the one numbered 0; a copy of it goes to the next partition as well
   (as many copies as partitions);
3. the window runs per (partition, keys) behind a hash exchange, the copy first. Where the entity goes on from the partition before, the
   copy is its previous row; elsewhere it is a group by itself and falls out.

Nothing is counted or collected while the plan is built, and the input stands in it once. Spark samples the input of
a range exchange when the query runs: that reads files a second time (the needed columns), but not a shuffle below it. Every partition
but the last holds the row that bounds it, so no partition in between is empty and one copy is enough. Only rows that
are equal in keys and all order columns cannot be separated. The window only looks back, so rows after ``end`` are dropped in the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark import functions as PF
from panelspark import session

_PIECE, _ROW, _COPY = "__piece", "__row", "__copy"  # _COPY: 1 = the copy of the last row of the piece before
_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id numbers a partition's rows in its lower 33 bits

DayBound = str | dt.date | None


def in_date_range(df: DataFrame, column: str, start: DayBound, end: DayBound) -> DataFrame:
    """Rows whose ``column`` lies in the inclusive day range ``[start, end]``; null dates drop out if a bound is given.

    Bounds are ``YYYY-MM-DD`` text or dates. For a timestamp column the end day is included to its end.
    """
    dtype = df.schema[column].dataType.typeName()
    cond = F.lit(True)
    if start is not None:
        cond = cond & PF.on_or_after(column, PF.as_date(start), dtype)
    if end is not None:
        cond = cond & PF.on_or_before(column, PF.as_date(end), dtype)
    return df.filter(cond)


def lagged_change(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Sequence[str],
    digits: int = 3,
    start: DayBound = None,
    end: DayBound = None,
    suffix: str = "_diff",
    partitions: int | None = None,
) -> DataFrame:
    """Add ``<m><suffix>`` for every measure; keep rows in ``[start, end]`` (each bound optional).

    ``order[0]`` is the date or timestamp column the range refers to; further ``order`` columns break ties (e.g. an
    event id). Rows with equal order values have no defined order, as with any window. Keys and order columns need a
    type that can be sorted. ``partitions``: how many the rows are dealt to (default: the session's shuffle partitions).
    """
    keys, order, measures = list(keys), list(order), list(measures)
    rows = df
    if end is not None:
        # Rows without a date come before all others, so they may be a previous row.
        dtype = df.schema[order[0]].dataType.typeName()
        rows = df.filter(F.col(order[0]).isNull() | PF.on_or_before(order[0], PF.as_date(end), dtype))
    pieces = in_pieces(rows, keys, order, partitions or session.initial_partitions(df.sparkSession))
    w = Window.partitionBy(_PIECE, *keys).orderBy(F.col(_COPY).desc(), *[F.col(o).asc_nulls_first() for o in order])
    is_first = F.row_number().over(w) == 1
    diffs: dict[str, Column] = {
        f"{m}{suffix}": F.when(is_first, F.col(m)).otherwise(F.round(F.col(m) - F.lag(m).over(w), digits)) for m in measures
    }
    changed = pieces.withColumns(diffs).filter(F.col(_COPY) == 0).drop(_COPY, _PIECE)
    return in_date_range(changed, order[0], start, end)


def in_pieces(rows: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int) -> DataFrame:
    """``rows`` range-partitioned by (keys, order), with their partition's number and the last row of each in the next as well."""
    by = [*keys, *order]
    # With a stated number of partitions AQE neither joins nor splits them, so a row's partition is its range.
    ranged = rows.repartitionByRange(partitions, *[F.col(c).asc_nulls_first() for c in by])
    down = ranged.sortWithinPartitions(*[F.col(c).desc_nulls_last() for c in by])
    numbered = down.withColumns({_PIECE: F.spark_partition_id(), _ROW: F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))})
    is_last = F.col(_ROW) == 0
    sent = numbered.withColumn(_COPY, F.explode(F.when(is_last, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return sent.withColumn(_PIECE, F.col(_PIECE) + F.col(_COPY)).drop(_ROW)


def assert_unique_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """(keys, order) pairs that occur more than once -- empty when the previous row is well defined."""
    return df.groupBy(*keys, *order).count().filter(F.col("count") > 1)
