"""Writers. Each runs one Spark job; the data goes from the executors to storage, never via the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark import session
from panelspark.sources import FILE_FORMATS, READ_OPTIONS, refuse_lossy, table_path, versions

MODES = {"overwrite", "append", "error", "errorifexists", "ignore"}

# Text formats keep microseconds (Spark's default patterns stop at milliseconds).
TIMESTAMP_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_table(
    df: DataFrame,
    root: str,
    database: str,
    table: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    versioned: bool = False,
    observation: Observation | None = None,
    **options: str,
) -> None:
    """Write ``df`` as table (database, table).

    ``overwrite`` replaces the table, ``append`` adds rows (a rerun then duplicates them). File formats
    go to ``root/database/table``; other formats (a connector on the class path) get ``database`` and
    ``collection``/``table`` options. ``partition_by`` lays files out by column value (e.g. ``year``),
    so later reads prune whole folders.

    A plain overwrite deletes first, so a job that fails leaves no table. With ``versioned`` (file formats, ``overwrite`` and
    ``append``) the rows go to a new folder that becomes the table, or a part of it, once it is whole (see
    :mod:`panelspark.sources.versions`); the rows of before stay on disk until ``versions.vacuum``.

    ``observation`` receives the :func:`output_metrics` of the rows as they are written.
    """
    mode = mode.lower()
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    refuse_lossy(fmt)
    if observation is not None:
        df = df.observe(observation, *output_metrics(df))
    if fmt == "csv":
        options = {**TIMESTAMP_FORMATS, "header": "true", **options}
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    path = table_path(root, database, table)
    if versioned or (fmt in FILE_FORMATS and versions.folders(df.sparkSession, path) is not None):
        if fmt not in FILE_FORMATS or mode not in ("overwrite", "append"):
            raise ValueError("only file tables have versions, and these are overwritten or appended to")
        name, folder = versions.new_folder(path)
        writer.mode("error").save(folder)
        versions.commit(df.sparkSession, path, name, None if mode == "overwrite" else [])
    elif fmt in FILE_FORMATS:
        writer.save(path)
    else:
        writer.option("database", database).option("collection", table).option("table", table).save()


def output_metrics(df: DataFrame) -> list[Column]:
    """Aggregates of an output: ``n_rows``, ``nulls`` of each column, and ``latest``, the last day or time of each such column."""
    nulls = [x for c in df.columns for x in (F.lit(c), F.count_if(F.col(f"`{c}`").isNull()))]
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    latest = [x for c in times for x in (F.lit(c), F.max(F.col(f"`{c}`")).cast("string"))]
    none = F.create_map().cast("map<string,string>")
    return [F.count(F.lit(1)).alias("n_rows"), F.create_map(*nulls).alias("nulls"), (F.create_map(*latest) if latest else none).alias("latest")]


def compact(
    spark: SparkSession, root: str, database: str, table: str, most: int, fmt: str = "parquet", partition_by: Sequence[str] | None = None
) -> bool:
    """Put the folders of a table with versions into one if there are more than ``most``; whether that was done.

    Rows appended meanwhile stay: only the folders that were read are replaced.
    """
    path = table_path(root, database, table)
    found = versions.folders(spark, path)
    if found is None or len(found) <= most:
        return False
    name, folder = versions.new_folder(path)
    rows = versions.load(spark.read.format(fmt).options(**READ_OPTIONS.get(fmt, {})), spark, path, found)
    # AQE deals the rows to files of its advisory size.
    writer = rows.hint("rebalance").write.format(fmt).options(**({**TIMESTAMP_FORMATS, "header": "true"} if fmt == "csv" else {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(folder)
    versions.commit(spark, path, name, found)
    return True


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    df.write.mode(mode).options(**TIMESTAMP_FORMATS).option("header", str(header).lower()).csv(path)


def write_json_records(df: DataFrame, path: str, mode: str = "overwrite", per_array: int = 1_000, layout: str = "lines") -> None:
    """Write ``df`` as exported JSON, in arrays of at most ``per_array`` records.

    ``layout="lines"``: every line is one array, and files can be split by line when they are read back;
    ``layout="document"``: every file is one array, indented over many lines. All of it runs on the JVM; arrays are filled within the
    input partitions. Read them back with :func:`panelspark.sources.read_json_records`.
    """
    if layout not in ("lines", "document"):
        raise ValueError(f"layout must be 'lines' or 'document', got {layout!r}")
    indented = layout == "document"
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    chunk = F.floor(F.monotonically_increasing_id() / F.lit(per_array))
    options = {**TIMESTAMP_FORMATS, "pretty": str(indented).lower()}
    numbered = df.select(F.to_json(row, options).alias("json"), chunk.alias("chunk"))
    # Lines: as many files as shuffle partitions, which jobs size by their input, so that reading them back is shared out as well. Documents have
    # a file each; a fixed number of partitions would leave an empty one if the first has none.
    spread = numbered.repartition("chunk") if indented else numbered.repartition(session.initial_partitions(df.sparkSession), "chunk")
    arrays = spread.groupBy("chunk").agg(F.array_join(F.collect_list("json"), ",\n" if indented else ",").alias("records"))
    opens, closes = ("[\n", "\n]") if indented else ("[", "]")
    writer = arrays.select(F.concat(F.lit(opens), "records", F.lit(closes)).alias("value")).write.mode(mode)
    (writer.option("maxRecordsPerFile", 1) if indented else writer).text(path)
