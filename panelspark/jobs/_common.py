"""Shared command-line handling of the jobs."""

from __future__ import annotations

import argparse
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession

from panelspark import session, sinks, sources, timings


def parser(description: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    p.add_argument("--input", required=True, help="input path (CSV with header unless --input-format says otherwise)")
    p.add_argument("--input-format", default="csv", choices=["csv", "parquet", "json"])
    p.add_argument("--infer-schema", action="store_true", help="infer CSV types (extra pass) instead of the fixed schema")
    p.add_argument("--bad-values", default="raise", choices=["raise", "null", "divert"],
                   help="CSV text that does not convert: an error, null, or its rows go to table Rejects.<input>")
    p.add_argument("--output-root", default=None, help="root folder of written tables (default: the shared scratch folder)")
    p.add_argument("--format", default="parquet", help="table format, or a connector name on the class path")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--versioned", action="store_true", help="commit each output as a version: readers see the old rows or the new ones")
    p.add_argument("--show", type=int, default=20, help="rows to preview on the console (0: none)")
    p.add_argument("--timings-db", default=None, help="append stage timings to <db>.Execution_Times and each output's metrics to <db>.Output_Metrics")
    p.add_argument("--partition-by", default=None, help="comma-separated columns to lay written tables out by")
    p.add_argument("--explain", action="store_true", help="print each output's formatted physical plan first")
    return p


def load(spark: SparkSession, args, schema, all_columns: bool = False) -> DataFrame:
    if args.input_format == "csv":
        if args.infer_schema:
            return sources.read_csv(spark, args.input, infer_schema=True)
        if args.bad_values == "divert":
            good, bad = sources.divert_csv(spark, args.input, schema, session.scratch_path(spark, "diverted"), all_columns)
            name = args.input.rstrip("/").rsplit("/", 1)[-1]
            sinks.write_table(bad, output_root(spark, args), "Rejects", name, mode=args.mode, fmt=args.format)
            return good
        return sources.read_csv(spark, args.input, schema=schema, bad_values=args.bad_values, all_columns=all_columns)
    if args.input_format == "json":
        return sources.read_json_records(spark, args.input, schema=schema)
    return sources.read_parquet(spark, args.input)


def output_root(spark: SparkSession, args) -> str:
    return args.output_root or session.scratch_root(spark) + "/panelspark-tables"


def write(df: DataFrame, spark: SparkSession, args, database: str, table: str, mode: str | None = None) -> None:
    if getattr(args, "explain", False):
        print(f"== {database}.{table} ==")
        df.explain("formatted")
    parts = [c for c in (getattr(args, "partition_by", None) or "").split(",") if c and c in df.columns]
    observed = Observation() if getattr(args, "timings_db", None) else None
    sinks.write_table(
        df, output_root(spark, args), database, table, mode=mode or args.mode, fmt=args.format, partition_by=parts,
        versioned=getattr(args, "versioned", False), observation=observed,
    )
    if observed is not None:
        # Gathered by the write itself: no second job counts the rows.
        timings.log_output(spark, observed.get, output_root(spark, args), args.timings_db, (database, table), args.format)


class Timed:
    """Stage timing that is a no-op unless ``--timings-db`` is given."""

    def __init__(self, args):
        self.args = args
        self.timer = timings.StageTimer()

    @contextmanager
    def stage(self, name: str):
        with self.timer.stage(name):
            yield

    def log(self, spark: SparkSession) -> None:
        if self.args.timings_db:
            timings.log_run(spark, self.timer.record(), output_root(spark, self.args), self.args.timings_db, self.args.format)


def shared(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate read by two outputs: a Parquet table in the shared scratch folder.

    A lost executor does not send the job back to the source scan, and each output reads its columns only.
    """
    path = session.scratch_path(df.sparkSession, "shared")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def start(app: str, inputs=None) -> SparkSession:
    spark = session.get_spark(app)
    session.scratch_root(spark)  # makes sure a checkpoint folder is set
    if inputs:
        session.size_shuffle(spark, inputs)
    return spark
