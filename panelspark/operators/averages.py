"""Average of every numeric column of a table, and of every numeric field of documents (one aggregation each)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Top-level columns whose type is a number (strings, dates, structs ... are skipped)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def average_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = None
) -> DataFrame | None:
    """One row with ``avg(c)`` for every numeric column, named as the column.

    Nulls are skipped; an empty input gives one row of nulls. Returns None when there is no numeric
    column. The global aggregation is partial per task, then one row per task is combined.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    if not cols:
        return None
    exprs = []
    for c in cols:
        a = F.avg(F.col(f"`{c}`"))
        exprs.append((F.round(a, digits) if digits is not None else a).alias(c))
    return df.agg(*exprs)


NUMBER_KINDS = "BIGINT|DOUBLE|FLOAT|DECIMAL.*"  # of a JSON value


def average_of_documents(texts: DataFrame, column: str = "text", digits: int | None = None) -> DataFrame:
    """(field, average, n_values) for every top-level field that is a number in some document.

    The values decide, not a schema: a field that is a number in some documents and text, null, an object or
    absent in others has the average of its numbers. Fields without any number are left out; texts must be JSON, and those that are no objects have no fields. One row a
    field, combined map-side, so as many rows as field names leave a task.
    """
    spark = texts.sparkSession
    docs = texts.select(F.parse_json(F.col(column)).alias("doc"))
    fields = docs.lateralJoin(spark.tvf.variant_explode(F.col("doc").outer())).select(F.col("key").alias("field"), "value")
    # The elements of an array have no names.
    numbers = fields.filter(F.col("field").isNotNull()).filter(F.regexp_like(F.schema_of_variant("value"), F.lit(f"^({NUMBER_KINDS})$")))
    average = F.avg(F.try_variant_get("value", "$", "double"))
    average = F.round(average, digits) if digits is not None else average
    return numbers.groupBy("field").agg(average.alias("average"), F.count("*").alias("n_values"))
