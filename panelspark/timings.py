"""Wall-time of job stages and the timing log.

A job is timed as: ``load`` (session and source set-up), ``process`` (building the lazy plan -- no data
moves), ``write`` (the actions: this is where the query runs) and ``Total``. The log is a table with one
row per run, appended to, and averaged with :func:`panelspark.operators.average_numeric`.
"""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from panelspark import schemas
from panelspark.sinks import compact, write_table
from panelspark.sources import FILE_FORMATS, table_path, versions

STAGES = ("load", "process", "write")
TIMING_TABLE = "Execution_Times"  # fixed value: the log table name of the recorded workload


class StageTimer:
    """Measure named stages with ``time.perf_counter``.

    >>> timer = StageTimer()
    >>> with timer.stage("load"):
    ...     pass
    >>> sorted(timer.record())
    ['Total_time', 'load_time', 'process_time', 'write_time']
    """

    def __init__(self) -> None:
        self.seconds: dict[str, float] = {}
        self._first: float | None = None
        self._last: float | None = None

    @contextmanager
    def stage(self, name: str):
        begin = time.perf_counter()
        if self._first is None:
            self._first = begin
        try:
            yield
        finally:
            end = time.perf_counter()
            self._last = end
            self.seconds[name] = self.seconds.get(name, 0.0) + (end - begin)

    def record(self) -> dict[str, float]:
        """``{<stage>_time: s, ..., Total_time: s}``; Total runs from the first start to the last end."""
        out = {f"{s}_time": float(self.seconds.get(s, 0.0)) for s in STAGES}
        for name, value in self.seconds.items():
            out.setdefault(f"{name}_time", float(value))
        total = (self._last - self._first) if self._first is not None and self._last is not None else 0.0
        out["Total_time"] = float(total)
        return out


def record_frame(spark: SparkSession, record: dict[str, float]) -> DataFrame:
    """The record as a one-row DataFrame with the timing-log schema."""
    fields = schemas.TIMING_RECORD.fieldNames()
    return spark.createDataFrame([tuple(float(record.get(f, 0.0)) for f in fields)], schemas.TIMING_RECORD)


METRICS_TABLE = "Output_Metrics"
METRICS = "output string, n_rows long, nulls map<string,long>, latest map<string,string>"
LOG_FOLDERS = 20  # runs that have a folder of their own at most


def log_run(spark: SparkSession, record: dict[str, float], root: str, database: str, fmt: str = "parquet") -> None:
    """Append one run to ``<database>.Execution_Times``.

    A file table keeps at most ``LOG_FOLDERS`` folders, however many runs: their rows are then put into one folder, and what
    is no longer named is deleted.
    """
    _append(record_frame(spark, record), root, database, TIMING_TABLE, fmt)


def log_output(spark: SparkSession, metrics: dict, root: str, database: str, output: tuple[str, str], fmt: str = "parquet") -> None:
    """Append the metrics that a write gathered (see :func:`panelspark.sinks.output_metrics`) to ``<database>.Output_Metrics``."""
    row = (".".join(output), int(metrics["n_rows"]), dict(metrics["nulls"]), dict(metrics["latest"]))
    _append(spark.createDataFrame([row], METRICS), root, database, METRICS_TABLE, fmt)


def _append(rows: DataFrame, root: str, database: str, table: str, fmt: str) -> None:
    spark, versioned = rows.sparkSession, fmt in FILE_FORMATS
    write_table(rows, root, database, table, mode="append", fmt=fmt, versioned=versioned)
    if versioned and compact(spark, root, database, table, LOG_FOLDERS, fmt):
        versions.vacuum(spark, table_path(root, database, table), keep=2)
