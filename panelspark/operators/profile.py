"""Column profiling: distinct values, distinct counts (exact, or by sketches that can be merged), the rows of one key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_values(df: DataFrame, column: str | Column, name: str | None = None) -> DataFrame:
    """The distinct values of one column (or expression), null included."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(c.alias(name) if name else c).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """One row: the number of distinct values of each column, **null counted as a value**.

    That equals ``df.select(c).distinct().count()`` for every column, but all columns are counted in a
    single aggregation (one scan; Spark expands the rows per column and de-duplicates map-side before
    the exchange). ``count_distinct`` skips null, so one more is added when the column holds a null.
    ``columns`` is a list (outputs ``n_<col>``) or a mapping output name -> column.
    """
    named = dict(columns) if isinstance(columns, Mapping) else {f"n_{c}": c for c in columns}
    exprs = [
        (F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(out)
        for out, c in named.items()
    ]
    return df.agg(*exprs)


def rows_for_key(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value`` (pushed into the scan)."""
    return df.filter(F.col(column) == F.lit(value))


def row_count(df: DataFrame) -> int:
    return df.count()


# ---------------------------------------------------------------- profiles that can be merged

LG_K = 12  # a sketch has 2^LG_K registers


def error_bound(lg_k: int = LG_K) -> float:
    """Relative error that a merged distinct count stays below with a probability of about 0.997 (three standard errors)."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def _as_text(df: DataFrame, column: str) -> Column:
    """One text for each value: equal values of a column have equal texts."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(c == 0, F.lit("0")).otherwise(c.cast("string"))  # 0.0 and -0.0 are one value
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(c)
    return c.cast("string")


def sketch_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column] = (), lg_k: int = LG_K) -> DataFrame:
    """Profile rows (``by`` columns, column, n_rows, n_nulls, sketch): one per part and column.

    A row is what later merges need: exact counts and a sketch of the distinct non-null values, about 2^lg_k bytes at most. Store
    the rows of each new piece of data; :func:`merge_profiles` adds them up without reading the data again. All columns
    are read in one pass, and a row per part leaves each task.
    """
    parts = [F.col(b) if isinstance(b, str) else b for b in by]
    measured = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("n_nulls"),
            F.hll_sketch_agg(_as_text(df, c), lg_k).alias("sketch"),
        )
        for c in columns
    ]
    rows = df.groupBy(*parts).agg(F.array(*measured).alias("__profile"))
    names = [n for n in rows.columns if n != "__profile"]
    return rows.select(*names, F.inline("__profile"))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by`` columns, column, n_rows, n_nulls, n_distinct): profile rows added up.

    ``n_distinct`` counts null as a value, as :func:`distinct_counts` does; it is an estimate within :func:`error_bound`. Rows
    and nulls are exact.
    """
    merged = profiles.groupBy(*by, "column").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_values")
    )
    with_null = F.col("n_values") + F.when(F.col("n_nulls") > 0, 1).otherwise(0)
    return merged.select(*by, "column", "n_rows", "n_nulls", with_null.alias("n_distinct"))
