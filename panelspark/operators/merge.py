"""Insert by key: rows whose key a table has already are not added again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _content(df: DataFrame, without: str) -> Column:
    """The row's other columns as one text, in the order of their names, so that equal rows have equal texts."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns) if c != without]))


def with_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a text key in every row: the given one, or where it is null or absent a digest of the row's other columns.

    A key made from the content is the same whenever the job runs.
    """
    made = F.sha2(_content(df, key), 256)
    return df.withColumn(key, F.coalesce(F.col(f"`{key}`").cast("string"), made) if key in df.columns else made)


def new_rows(incoming: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """The rows of ``incoming`` (see :func:`with_key`) to append: one for each key that ``existing`` does not have.

    Of several incoming rows with one key the one with the smallest content stays. Only the key column of ``existing`` is read.
    """
    keyed = with_key(incoming, key)
    first = Window.partitionBy(key).orderBy(_content(keyed, key))
    one = keyed.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").drop("__rank")
    if existing is None:
        return one
    return one.join(existing.select(F.col(f"`{key}`").cast("string").alias(key)), key, "left_anti").select(*one.columns)
