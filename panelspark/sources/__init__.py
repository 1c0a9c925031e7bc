"""Readers. Each returns a lazy DataFrame; nothing is read until an action runs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark import session
from panelspark.sources import json_documents, versions


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    header: bool = True,
    infer_schema: bool = False,
    bad_values: str = "raise",
    all_columns: bool = False,
    **options: str,
) -> DataFrame:
    """CSV with a header line.

    With ``schema`` the columns are matched by header name and converted; the file may hold more columns, in
    any order. A value that is present but does not convert raises an error, or becomes null with
    ``bad_values="null"``. Whole numbers written as ``12.0`` or ``1e3`` are whole numbers. The result has the
    schema's columns, absent ones as nulls; with ``all_columns`` it has the file's own columns instead, all of them,
    those outside the schema as strings.

    All files of a folder must have the same header; a file whose header differs raises an error when it is read.
    Without a schema the columns stay strings, or are inferred with ``infer_schema=True`` (one extra pass).
    """
    if bad_values not in ("raise", "null"):
        raise ValueError(f"bad_values must be 'raise' or 'null', got {bad_values!r}")
    reader = spark.read.options(header=str(header).lower(), **options)
    if header:
        # Else values of a file with another column order would land under the wrong names.
        reader = reader.option("enforceSchema", "false")
    if schema is None:
        return reader.option("inferSchema", str(infer_schema).lower()).csv(path)
    raw = reader.csv(path)
    known = {f.name: f for f in schema.fields}
    if all_columns:
        return raw.select(*[_converted(known[c], bad_values) if c in known else F.col(f"`{c}`") for c in raw.columns])
    present = set(raw.columns)
    return raw.select(
        *[_converted(f, bad_values) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


REJECTS = "file string, line string, column string, text string"


def divert_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, target: str, all_columns: bool = False, **options: str
) -> tuple[DataFrame, DataFrame]:
    """CSV with a header line: the rows that convert, and the values that do not.

    The files are parsed once and written to the new folder ``target``, apart by whether every value of a row converts; both
    results are readers of it. The first has the columns of :func:`read_csv`. The second has a row for each value that does
    not convert, so one or more for each row that the first lacks: the file, the whole row as it stands there (``line``, a JSON object
    of texts by header name, without the empty ones), the column and its text.
    """
    raw = spark.read.options(header="true", **options).option("enforceSchema", "false").csv(path)
    known = {f.name: f for f in schema.fields}
    if all_columns:
        values = [_converted(known[c], "null") if c in known else F.col(f"`{c}`") for c in raw.columns]
    else:
        values = [_converted(f, "null") if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]

    def failed(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        found = F.struct(F.lit(field.name).alias("column"), text.alias("text"))
        return F.when(text.isNotNull() & _converted(field, "null").isNull(), found)

    rejects = F.array_compact(F.array(*[failed(known[c]) for c in raw.columns if c in known]))
    rejects = rejects.cast("array<struct<column:string,text:string>>")
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))
    marked = raw.select(F.struct(*values).alias("row"), rejects.alias("rejects"), F.col("_metadata.file_path").alias("file"), line.alias("line"))
    # What a kept row was read from is not needed again.
    some = F.size("rejects") > 0
    marked = marked.select("row", "rejects", *[F.when(some, F.col(c)).alias(c) for c in ("file", "line")], some.cast("int").alias("rejected"))
    marked.write.partitionBy("rejected").parquet(target)
    parts = spark.read.schema(marked.schema).parquet(target)
    bad = parts.filter("rejected = 1").select("file", "line", F.explode("rejects").alias("r")).select("file", "line", "r.column", "r.text")
    return parts.filter("rejected = 0").select("row.*"), bad


def _converted(field: T.StructField, bad_values: str) -> Column:
    text = F.col(f"`{field.name}`")
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.IntegralType):
        number = text.try_cast(T.DecimalType(38, 10))
        value = F.coalesce(value, F.when(number == F.floor(number), number.try_cast(field.dataType)))
    if bad_values == "raise":
        told = F.concat(F.lit(f"column {field.name}: cannot convert "), text)
        value = F.when(text.isNotNull() & value.isNull(), F.raise_error(told).cast(field.dataType)).otherwise(value)
    return value.alias(field.name)


def read_parquet(spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, layout: str | None = None
) -> DataFrame:
    """Exported JSON: the records of every file, whichever way they are laid out.

    * ``lines``: every line is an object or an array of objects; files are split among tasks;
    * ``document``: a file is one array of objects, or one object, over any number of lines; it is cut at the records' ends
      and read by many tasks (see :mod:`panelspark.sources.json_documents`). Without a schema the records are written to the
      shared scratch folder first, one a line, as Spark has to read them twice then.

    Without ``layout`` each file's is found first, by one pass over the lines. A file that is neither (several
    objects one after the other, each over several lines) raises an error, as does text that is not JSON.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if layout not in (None, "lines", "document"):
        raise ValueError(f"layout must be 'lines' or 'document', got {layout!r}")
    by_layout = {layout: paths} if layout else _json_layouts(spark, paths)
    reader = spark.read.option("mode", "FAILFAST").options(**TIMESTAMP_READ_FORMATS)
    parts = []
    if documents := by_layout.get("document"):
        texts = json_documents.record_texts(spark, documents)
        if schema is not None:
            options = {"mode": "FAILFAST", **TIMESTAMP_READ_FORMATS}
            parts.append(texts.select(F.from_json("text", schema, options).alias("r")).select("r.*"))
        else:
            lines = session.scratch_path(spark, "json_records")
            texts.select(json_documents.on_one_line(F.col("text")).alias("value")).write.text(lines)
            parts.append(reader.json(lines))
    if lines := by_layout.get("lines"):
        parts.append((reader.schema(schema) if schema is not None else reader).json(lines))
    if not parts:
        return spark.createDataFrame([], schema or T.StructType())
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


LINE_CHARS = 16 << 20  # an array on a line of its own is parsed as one value up to this length; longer ones are cut like documents


def _json_layouts(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by layout. Names of files come to the driver, as in any file listing; their lines do not."""
    lines = spark.read.text(paths).select(F.trim("value").alias("v"), F.col("_metadata.file_path").alias("file")).filter("v <> ''")
    whole = F.regexp_like("v", F.lit(r"^(\{.*\}|\[.*\])$"))
    files = lines.groupBy("file").agg(
        F.min(whole).alias("lines"),
        F.max(F.startswith("v", F.lit("["))).alias("array"),
        F.sum(F.regexp_like("v", F.lit(r"^\{")).cast("int")).alias("objects"),
        F.max(F.length("v")).alias("longest"),
    )
    found: dict[str, list[str]] = {"lines": [], "document": []}
    for row in files.collect():
        if not row["lines"] and not row["array"] and row["objects"] > 1:
            raise ValueError(f"{row['file']}: several JSON values over several lines each")
        found["lines" if row["lines"] and row["longest"] <= LINE_CHARS else "document"].append(row["file"])
    return found


def read_json_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of exported JSON as texts (column ``text``), whichever way they are laid out and whatever fields they have."""
    return json_documents.record_texts(spark, [path] if isinstance(path, str) else list(path))


def table_exists(spark: SparkSession, root: str, database: str, table: str) -> bool:
    """Whether the folder of a file table is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(root, database, table))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def read_table(
    spark: SparkSession,
    root: str,
    database: str,
    table: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """A table addressed by (database, table).

    File formats live at ``root/database/table``; of a table with versions the current one is read. Any other format (a connector on the class path, for
    example a document store) receives ``database`` and ``collection``/``table`` options instead.
    """
    refuse_lossy(fmt)
    reader = spark.read.format(fmt).options(**{**READ_OPTIONS.get(fmt, {}), **options})
    if schema is not None:
        reader = reader.schema(schema)
    if fmt in FILE_FORMATS:
        path = table_path(root, database, table)
        found = versions.folders(spark, path)
        return reader.load(path) if found is None else versions.load(reader, spark, path, found)
    return reader.option("database", database).option("collection", table).option("table", table).load()


FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro"}
# A table's csv files carry their header; without a schema their types are inferred.
READ_OPTIONS = {"csv": {"header": "true", "inferSchema": "true", "enforceSchema": "false"}}


def refuse_lossy(fmt: str) -> None:
    if fmt == "text":
        raise ValueError("text files keep neither column names nor types; choose another table format")

# Optional fraction of up to six digits: reads what the writers in panelspark.sinks produce, and the
# plain ISO forms of other exporters.
TIMESTAMP_READ_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
}


def table_path(root: str, database: str, table: str) -> str:
    return f"{root.rstrip('/')}/{database}/{table}"


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the generated benchmark tables, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
