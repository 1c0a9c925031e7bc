"""Tables with versions: a failed write changes nothing, readers see one version, appends are not lost, folders stay few."""

import os

import pytest
from pyspark.sql import functions as F

from panelspark import sinks, sources, timings
from panelspark.sources import versions


def ids(df):
    return sorted(r.id for r in df.collect())


def read(spark, root):
    return sources.read_table(spark, root, "db", "t")


def test_a_failed_write_leaves_the_old_rows(spark, tmp_root):
    for mode in ("overwrite", "append"):
        sinks.write_table(spark.range(3), tmp_root, "db", "t", versioned=True)
        failing = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("id"))
        with pytest.raises(Exception, match="stop"):
            sinks.write_table(failing, tmp_root, "db", "t", mode=mode, versioned=True)
        assert ids(read(spark, tmp_root)) == [0, 1, 2]


def test_readers_keep_the_version_they_opened(spark, tmp_root):
    sinks.write_table(spark.range(3), tmp_root, "db", "t", versioned=True)
    old = read(spark, tmp_root)
    sinks.write_table(spark.range(5, 7), tmp_root, "db", "t")  # a table with versions stays one
    assert ids(old) == [0, 1, 2] and ids(read(spark, tmp_root)) == [5, 6]
    sinks.write_table(spark.range(9, 10), tmp_root, "db", "t", mode="append")
    versions.vacuum(spark, f"{tmp_root}/db/t", keep=1)
    assert ids(read(spark, tmp_root)) == [5, 6, 9] and len(os.listdir(f"{tmp_root}/db/t/_versions")) == 2


def test_plain_table_becomes_one_with_versions(spark, tmp_root):
    sinks.write_table(spark.range(2), tmp_root, "db", "t")
    sinks.write_table(spark.range(2, 4), tmp_root, "db", "t", mode="append", versioned=True)
    assert ids(read(spark, tmp_root)) == [0, 1, 2, 3]
    assert sinks.compact(spark, tmp_root, "db", "t", most=1) and not sinks.compact(spark, tmp_root, "db", "t", most=1)
    versions.vacuum(spark, f"{tmp_root}/db/t", keep=1)
    assert ids(read(spark, tmp_root)) == [0, 1, 2, 3]
    assert not [n for n in os.listdir(f"{tmp_root}/db/t") if n.startswith("part-")]


def test_log_files_that_are_not_whole_do_not_count(spark, tmp_root):
    sinks.write_table(spark.range(2), tmp_root, "db", "t", versioned=True)
    with open(f"{tmp_root}/db/t/_log/{2:012d}", "w") as f:
        f.write("some-folder")  # a writer that stopped here
    assert ids(read(spark, tmp_root)) == [0, 1]
    sinks.write_table(spark.range(2, 3), tmp_root, "db", "t", mode="append", versioned=True)
    assert ids(read(spark, tmp_root)) == [0, 1, 2] and os.path.exists(f"{tmp_root}/db/t/_log/{3:012d}")


def test_an_append_during_compaction_is_kept(spark, tmp_root):
    for i in range(3):
        sinks.write_table(spark.range(i, i + 1), tmp_root, "db", "t", mode="append", versioned=True)
    table = f"{tmp_root}/db/t"
    found = versions.folders(spark, table)
    name, folder = versions.new_folder(table)
    versions.load(spark.read, spark, table, found).write.parquet(folder)
    sinks.write_table(spark.range(7, 8), tmp_root, "db", "t", mode="append", versioned=True)
    versions.commit(spark, table, name, found)
    assert ids(read(spark, tmp_root)) == [0, 1, 2, 7]


def test_partitioned_versions_prune(spark, tmp_root):
    df = spark.range(10).withColumn("year", 2020 + F.col("id") % 2)
    sinks.write_table(df, tmp_root, "db", "t", partition_by=["year"], versioned=True)
    sinks.write_table(df.select(F.col("id") + 10, "year").toDF("id", "year"), tmp_root, "db", "t", mode="append", partition_by=["year"], versioned=True)
    one = read(spark, tmp_root).filter("year = 2020")
    assert ids(one) == list(range(0, 20, 2))
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_modes_and_formats(spark, tmp_root):
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), tmp_root, "db", "t", mode="ignore", versioned=True)
    sinks.write_table(spark.range(1), tmp_root, "db", "t", versioned=True)
    with pytest.raises(ValueError):
        versions.vacuum(spark, f"{tmp_root}/db/t", keep=0)


def test_timing_log_stays_small(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(timings, "LOG_FOLDERS", 3)
    for i in range(8):
        timings.log_run(spark, {"Total_time": float(i)}, tmp_root, "Q")
    log = sources.read_table(spark, tmp_root, "Q", timings.TIMING_TABLE)
    assert sorted(r.Total_time for r in log.collect()) == [float(i) for i in range(8)]
    assert len(os.listdir(f"{tmp_root}/Q/{timings.TIMING_TABLE}/_versions")) <= 8
    assert len(versions.folders(spark, f"{tmp_root}/Q/{timings.TIMING_TABLE}")) <= 4
