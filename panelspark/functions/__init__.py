"""Column expressions shared by the operators. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: str | dt.date | dt.datetime) -> dt.date:
    """``YYYY-MM-DD`` text, date or datetime -> date (the day a bound names)."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


# ---------------------------------------------------------------- calendar parts


def year(c: ColumnOrName) -> Column:
    return F.year(col(c))


def month(c: ColumnOrName) -> Column:
    return F.month(col(c))


def quarter(c: ColumnOrName) -> Column:
    """Quarter 1-4 of a date; equal to ``floor((month - 1) / 3) + 1`` but an int."""
    return F.quarter(col(c))


def quarter_of_month(m: ColumnOrName) -> Column:
    """Quarter 1-4 from a month number 1-12, as an int."""
    return (F.floor((col(m) - F.lit(1)) / F.lit(3)) + F.lit(1)).cast("int")


# ---------------------------------------------------------------- inclusive day ranges
#
# A bound names a calendar day. For a date column that is plain ``>=`` / ``<=``. For a timestamp column
# the last day is included up to its end, so the upper test is ``< next midnight``. Both forms compare the
# bare column with a literal, so Catalyst pushes them into the parquet scan.


def _is_timestamp(dtype_name: str) -> bool:
    return dtype_name.startswith("timestamp")


def day_start_literal(day: dt.date, dtype_name: str) -> Column:
    """Midnight starting ``day`` as a literal of the column's type.

    Built from text, so it means midnight in the session time zone (or wall-clock midnight for
    ``timestamp_ntz``) whatever the time zone of the Python process.
    """
    if _is_timestamp(dtype_name):
        return F.lit(f"{day.isoformat()} 00:00:00").cast(dtype_name)
    return F.lit(day)


def on_or_after(c: ColumnOrName, day: dt.date, dtype_name: str = "date") -> Column:
    return col(c) >= day_start_literal(day, dtype_name)


def before(c: ColumnOrName, day: dt.date, dtype_name: str = "date") -> Column:
    """Strictly before ``day`` (before its first instant)."""
    return col(c) < day_start_literal(day, dtype_name)


def on_or_before(c: ColumnOrName, day: dt.date, dtype_name: str = "date") -> Column:
    if _is_timestamp(dtype_name):
        return col(c) < day_start_literal(day + dt.timedelta(days=1), dtype_name)
    return col(c) <= F.lit(day)


# ---------------------------------------------------------------- exact sums
#
# A double sum depends on the order rows arrive in, which changes with partitioning. Measures that are
# decimals at heart (money with 2 places, counts) are summed exactly instead and cast once at the end; the result is the
# double nearest to the sum of the rounded values, whatever the order.
#
# A value x becomes the whole number x * 10^scale, which is summed in two limbs, the lower one of 31 bits: two sums of longs, which stay
# in generated code (a sum of decimals would allocate objects for every row). A group may have 2^32 rows, or 2^32 / 2^k where
# values exceed 2^(62 + k); beyond, the sum of longs raises its overflow error (with ``spark.sql.ansi.enabled``, as is usual).
# NaN and infinities have no such number; they are summed by themselves as doubles, where order does not matter, and decide
# the result as in a plain sum.

LIMB = 31
PRECISION = 28  # digits of a summand at most
MOST_SCALE = 13
_MOST = float(1 << 62)  # scaled values from here on are taken apart as decimals
HIGH, LOW, OTHER = "high", "low", "other"


def _is_finite(x: Column) -> Column:
    # NaN - NaN and inf - inf are NaN, which is equal to itself here but not to zero.
    return (x - x) == F.lit(0.0)


def _units(c: ColumnOrName, scale: int) -> dict[str, Column]:
    """``x * 10^scale``, rounded like the decimal that ``x`` prints as (HALF_UP), in one of three columns.

    ``easy``: as a long; ``units``: as a decimal, for the few values whose rounding a double product does not settle or that
    are 2^62 or more; ``other``: NaN and infinities as they are. Raises an error for more than ``PRECISION`` digits.
    """
    if not 0 <= scale <= MOST_SCALE:
        raise ValueError(f"scale must lie in 0 to {MOST_SCALE}, got {scale}")
    x = col(c).cast("double")
    y = x * F.lit(10.0**scale)
    # The product is right to 2^-53 of its size.
    near_half = F.abs(F.abs(y - F.floor(y)) - 0.5) <= F.abs(y) * F.lit(2.0**-51)
    is_easy = (F.abs(y) < _MOST) & ~near_half
    units = col(c).try_cast(T.DecimalType(PRECISION, scale)) * F.lit(10**scale).cast(T.DecimalType(scale + 1, 0))
    told = F.concat(F.lit(f"too large for an exact sum with {scale} places: "), x.cast("string"))
    whole = T.DecimalType(PRECISION, 0)
    checked = F.when(units.isNull(), F.raise_error(told).cast(whole)).otherwise(units.cast(whole))
    return {
        "easy": F.when(is_easy, F.rint(y).cast("long")),
        "units": F.when(~is_easy & _is_finite(x), checked),
        "other": F.when(~_is_finite(x), x),
    }


def _parts(easy: Column, units: Column, other: Column) -> Column:
    block = F.lit(1 << LIMB).cast(T.DecimalType(10, 0))
    rest = F.pmod(units, block)
    low = F.coalesce(easy.bitwiseAND(F.lit((1 << LIMB) - 1)), rest.cast("long"))
    high = F.coalesce(F.shiftright(easy, LIMB), ((units - rest) / block).cast("long"))
    return F.struct(F.sum(high).alias(HIGH), F.sum(low).alias(LOW), F.sum(other).alias(OTHER))


def exact_parts(c: ColumnOrName, scale: int) -> Column:
    """Aggregate: struct of the sums of both limbs of the finite values, and the sum of the other values.

    All null without any value. :func:`added` adds such structs up, :func:`from_parts` makes a number of one.
    """
    return _parts(*_units(c, scale).values())


def with_units(df: DataFrame, measures: Mapping[str, tuple[ColumnOrName, int | None]]) -> DataFrame:
    """``df`` with the columns that :func:`parts_of` sums for each (column, scale): every value is taken apart once.

    Measures without a scale are left out. The same sums as :func:`exact_parts`, in less generated code.
    """
    columns = {f"__{part}_{name}": c for name, (src, scale) in measures.items() if scale is not None for part, c in _units(src, scale).items()}
    return df.withColumns(columns) if columns else df


def parts_of(name: str) -> Column:
    """Aggregate: :func:`exact_parts` of a measure that :func:`with_units` prepared."""
    return _parts(*[F.col(f"__{part}_{name}") for part in ("easy", "units", "other")])


def added(parts: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """Structs of :func:`exact_parts` added up: an aggregate, or a running sum over a window."""
    sums = {n: F.sum(col(parts)[n]) for n in (HIGH, LOW, OTHER)}
    return F.struct(*[(s if over is None else s.over(over)).alias(n) for n, s in sums.items()])


def from_parts(parts: ColumnOrName, scale: int) -> Column:
    """The double nearest to the sum; NaN or an infinity where such values decide it."""
    p = col(parts)
    high, low = p[HIGH], p[LOW]
    # Below 2^53, dividing by a power of ten gives the nearest double.
    few_bits = high.between(-(1 << 20), 1 << 20) & (low < F.lit(1 << 52))
    small = (F.shiftleft(high, LIMB) + low).cast("double") / F.lit(10.0**scale)
    # 2^31 / 10^scale has no more than ``scale`` places, so nothing is rounded here either until the cast.
    weight = F.lit(Decimal(1 << LIMB).scaleb(-scale)).cast(T.DecimalType(max(10, scale + 1), scale))
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(scale + 1, scale))
    wide = high.cast(T.DecimalType(19, 0)) * weight + low.cast(T.DecimalType(19, 0)) * unit
    return F.coalesce(p[OTHER], F.when(few_bits, small).otherwise(wide.cast("double")))


def parts_order(parts: ColumnOrName) -> Column:
    """A value that sorts and compares as the sums do: -inf, the finite ones exactly, inf, NaN."""
    p = col(parts)
    group = F.when(p[OTHER].isNull(), 0).when(F.isnan(p[OTHER]), 2).when(p[OTHER] > 0, 1).otherwise(-1)
    high = F.when(group == 0, p[HIGH] + F.shiftright(p[LOW], LIMB)).alias(HIGH)
    low = F.when(group == 0, p[LOW].bitwiseAND(F.lit((1 << LIMB) - 1))).alias(LOW)
    return F.when(p[LOW].isNotNull() | p[OTHER].isNotNull(), F.struct(group.alias("group"), high, low))


def exact_sum(c: ColumnOrName, scale: int | None = None) -> Column:
    """``sum(x)``; with ``scale``, summed exactly with that many decimal places and returned as double."""
    if scale is None:
        return F.sum(col(c))
    return from_parts(exact_parts(c, scale), scale)
