"""JSON documents cut at the records' ends: the rows of Spark's own reading of a whole file, however small the splits are."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from panelspark import sinks, sources

SCHEMA = "a long, s string, o struct<x: long, t: array<string>>, l array<struct<y: long>>"
TRICKY = ["plain", "}", "{", "}{", '"', '\\"', "\\", "\\\\", '"}', '\\"}', "[{", "}]", ",", "é漢\U0001f600", "a\nb", "a\tb", "", "{\"a\": \"}\"}", " } , { "]


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "400"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def record(rng):
    out = {"a": rng.randint(-5, 5), "s": "".join(rng.choice(TRICKY) for _ in range(rng.randint(0, 4)))}
    if rng.random() < 0.5:
        out["o"] = {"x": rng.randint(0, 9), "t": [rng.choice(TRICKY) for _ in range(rng.randint(0, 3))]}
    if rng.random() < 0.5:
        out["l"] = [{"y": i} for i in range(rng.randint(0, 3))]
    if rng.random() < 0.1:
        out["s"] = "long } { \" " * 40  # over several splits
    return out


def layouts(records):
    yield json.dumps(records)
    yield json.dumps(records, ensure_ascii=False, separators=(",", ":"))
    yield json.dumps(records, indent=2)
    yield json.dumps(records, indent="\t") + "\n\n"
    yield "  \r\n" + json.dumps(records, indent=1).replace("\n", "\r\n") + "\r\n"


def norm(df):
    return sorted((json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect()))


@pytest.mark.parametrize("seed", range(2))
def test_rows_equal_reading_whole_files(spark, tmp_root, small_splits, seed):
    rng = random.Random(seed)
    for i, text in enumerate(layouts([record(rng) for _ in range(25)])):
        path = f"{tmp_root}/{i}.json"
        with open(path, "w", newline="", encoding="utf-8") as f:
            f.write(text)
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        whole = spark.read.schema(SCHEMA).option("multiLine", "true").option("mode", "FAILFAST").json(path)
        found = sources.read_json_records(spark, path, schema=whole.schema, layout="document")
        assert norm(found) == norm(whole) and found.schema == whole.schema


def test_many_files_at_once_without_a_schema(spark, tmp_root, small_splits):
    rng = random.Random(9)
    texts = [json.dumps([record(rng) for _ in range(n)], indent=2) for n in (1, 0, 7, 13)] + [json.dumps(record(rng), indent=3), "[]", " ", ""]
    for i, text in enumerate(texts):
        with open(f"{tmp_root}/{i}.json", "w", encoding="utf-8") as f:
            f.write(text)
    found = sources.read_json_records(spark, tmp_root, layout="document")
    expected = spark.read.option("multiLine", "true").json([f"{tmp_root}/{i}.json" for i in range(5) if i != 1])
    assert found.count() == 22 and norm(found) == norm(expected)


@pytest.mark.parametrize("text", ['[{"a": 1', '[{"a": 1}, {"a": 2', '[1, {"a": 1}]', '[{"a": 1}] x', '[{"a": 1}}]', '[{"a": "}]', '{"a": 1} trailing {"a": 2}'])
def test_what_is_not_whole_raises(spark, tmp_root, small_splits, text):
    with open(f"{tmp_root}/bad.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        sources.read_json_records(spark, f"{tmp_root}/bad.json", schema=spark.createDataFrame([], SCHEMA).schema, layout="document").collect()


def test_one_file_is_read_by_many_tasks_without_an_array_value(spark, tmp_root, small_splits):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    sinks.write_json_records(events.coalesce(1), tmp_root, per_array=10_000, layout="document")
    files = [f for f in os.listdir(tmp_root) if f.startswith("part-")]
    assert len(files) == 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    found = sources.read_json_records(spark, tmp_root, schema=events.schema, layout="document")
    scans = spark.read.option("lineSep", "}").text(tmp_root)
    assert scans.rdd.getNumPartitions() > 8 and scans.agg(F.max(F.length("value"))).first()[0] < 1000
    assert found.exceptAll(events).isEmpty() and events.exceptAll(found).isEmpty()


def shuffled_rows(plan):
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return shuffled_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return shuffled_rows(plan.plan())
    children = plan.children()
    here = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
    return here + sum(shuffled_rows(children.apply(i)) for i in range(children.size()))


@pytest.mark.parametrize("per_batch", [2, 7, 10_000])
def test_records_within_a_split_are_not_shuffled(spark, tmp_root, small_splits, per_batch):
    """Pieces of a record may come in several batches and splits; only what crosses the end of a split is shuffled."""
    rng = random.Random(per_batch)
    records = [record(rng) for _ in range(1500)] + [{"a": i, "s": "", "l": [{"y": j} for j in range(i)]} for i in (40, 400)] + [{"a": 1}]
    for i in range(3):
        with open(f"{tmp_root}/{i}.json", "w", encoding="utf-8") as f:
            json.dump(records[i::3], f, ensure_ascii=i == 1, indent=i or None)
    spark.conf.set("spark.sql.files.minPartitionNum", "3")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(per_batch))
    try:
        found = sources.read_json_texts(spark, tmp_root)
        texts = [r.text for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(json.dumps(json.loads(t)) for t in texts) == sorted(map(json.dumps, records))
    assert all(t.startswith("{") and t.endswith("}") for t in texts)
    splits = spark.read.text(tmp_root).rdd.getNumPartitions()
    assert splits > 15 and shuffled_rows(found._jdf.queryExecution().executedPlan()) < len(records)


@pytest.mark.parametrize("text", ["[1, {\"a\": 1}]", '["}", {"a": 1}]', '[{"a": 1}, "x{"]', '[{"a": 1}}]', '{"a": 1}}{{"a": 2}', '[{"a": 1}, 7, {"a": 1}]', '"x"', '[{"a": "}]'])
def test_other_values_between_records_raise(spark, tmp_root, text):
    with open(f"{tmp_root}/bad.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="bad.json: not an array of objects"):
        sources.read_json_texts(spark, f"{tmp_root}/bad.json").collect()


def test_layout_is_checked(spark, tmp_root):
    with pytest.raises(ValueError):
        sinks.write_json_records(spark.range(1), tmp_root, layout="table")
