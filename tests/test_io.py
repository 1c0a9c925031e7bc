import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark import schemas, sinks, sources, timings
from panelspark.operators import averages, profile
from tests.fixtures import county, county_rows

CUSTOMERS = [
    ("Ada", "Birch Road 4"),
    ("Bram", "Quay 17"),
    ("Cleo", "Harbour Lane 2"),
    ("Dirk", "Mill st 80"),
    ("Edda", "Stone Way 9"),
    ("Femke", "Canal 33"),
    ("Gus", "Orchard 5"),
    ("Hale", "Dune Path 71"),
    ("Ines", "Harbour Lane 2"),
    ("Jory", "Willow 12"),
    ("Kees", "Beacon st 3"),
    ("Lune", "Ferry 640"),
]


def test_overwrite_replaces_append_adds(spark, tmp_root):
    df = spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)
    sinks.write_table(df, tmp_root, "mydb", "customers", mode="append")
    sinks.write_table(df, tmp_root, "mydb", "customers", mode="append")
    assert sources.read_table(spark, tmp_root, "mydb", "customers").count() == 24
    sinks.write_table(df, tmp_root, "mydb", "customers", mode="overwrite")
    back = sources.read_table(spark, tmp_root, "mydb", "customers")
    assert sorted(map(tuple, back.collect())) == sorted(CUSTOMERS)


def test_filtered_copy_round_trip(spark, tmp_root):
    df = spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS)
    sinks.write_table(df, tmp_root, "mydb", "customers")
    src = sources.read_table(spark, tmp_root, "mydb", "customers")
    hits = profile.rows_for_key(src, "address", "Harbour Lane 2")
    sinks.write_table(hits, tmp_root, "mydb", "customers1", mode="overwrite")
    back = sources.read_table(spark, tmp_root, "mydb", "customers1")
    assert sorted(r.name for r in back.collect()) == ["Cleo", "Ines"]


def test_bad_mode(spark, tmp_root):
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), tmp_root, "d", "t", mode="upsert")


def test_csv_schema_by_header_name(spark, tmp_root):
    path = os.path.join(tmp_root, "county.csv")
    cols = ["geoid", "date", "state", "county", "extra", "cases", "deaths", "cases_avg", "cases_avg_per_100k",
            "deaths_avg", "deaths_avg_per_100k"]
    with open(path, "w") as fh:
        fh.write(",".join(cols) + "\n")
        for r in county_rows():
            d = dict(zip(schemas.COUNTY_DAILY.fieldNames(), r))
            d["extra"] = "zz"
            fh.write(",".join("" if d[c] is None else str(d[c]) for c in cols) + "\n")
        fh.write("USA-9,not-a-date,Utah,Delta,zz,abc,1,1.0,1.0,1.0,1.0\n")
    with pytest.raises(Exception, match="cannot convert"):
        sources.read_csv(spark, path, schema=schemas.COUNTY_DAILY).collect()
    # all columns of the file, those outside the schema as text
    whole = sources.read_csv(spark, path, schema=schemas.COUNTY_DAILY, bad_values="null", all_columns=True)
    assert whole.columns == cols and whole.filter("extra <> 'zz'").count() == 0
    df = sources.read_csv(spark, path, schema=schemas.COUNTY_DAILY, bad_values="null")
    assert df.columns == schemas.COUNTY_DAILY.fieldNames()
    got = {tuple(r) for r in df.filter(F.col("geoid") != "USA-9").collect()}
    assert got == {tuple(r) for r in county(spark).collect()}
    bad = df.filter(F.col("geoid") == "USA-9").first()
    assert bad.date is None and bad.cases is None and bad.deaths == 1
    # no schema: strings, or inferred with one extra pass
    assert dict(sources.read_csv(spark, path).dtypes)["cases"] == "string"


def test_json_records_round_trip_with_empty_partitions(spark, tmp_root):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = os.path.join(tmp_root, "events_json")
    sinks.write_json_records(ev.repartition(16).filter(F.col("event_id") % 7 == 0), path)
    files = [name for name in os.listdir(path) if name.endswith(".txt")]
    assert len(files) > 1
    for name in files:
        for line in open(os.path.join(path, name)):
            assert isinstance(json.loads(line), list)
    back = sources.read_json_records(spark, path, schema=ev.schema)
    assert back.subtract(ev.filter(F.col("event_id") % 7 == 0)).count() == 0
    assert back.count() == ev.filter(F.col("event_id") % 7 == 0).count()


def test_timing_export_average(spark, tmp_root):
    path = os.path.join(tmp_root, "times.json")
    recs = [
        {"_id": {"$oid": "a1"}, "Total_time": 30.0, "load_time": 20.0, "process_time": 1.0, "write_time": 9.0},
        {"_id": {"$oid": "a2"}, "Total_time": 40.0, "load_time": 25.0, "process_time": 2.0, "write_time": 13.0,
         "host": "n1"},
    ]
    with open(path, "w") as fh:
        json.dump(recs, fh, indent=2)
    df = sources.read_json_records(spark, path)
    assert df.schema["_id"].dataType.fieldNames() == ["$oid"]
    row = averages.average_numeric(df).first().asDict()
    assert row == {"Total_time": 35.0, "load_time": 22.5, "process_time": 1.5, "write_time": 11.0}
    empty = os.path.join(tmp_root, "empty.json")
    with open(empty, "w") as fh:
        fh.write("[]")
    assert sources.read_json_records(spark, empty, schema=schemas.TIMING_EXPORT).count() == 0
    assert averages.average_numeric(sources.read_json_records(spark, empty, schema=schemas.TIMING_EXPORT)).first()[0] is None


def test_stage_timer_and_log(spark, tmp_root):
    timer = timings.StageTimer()
    with timer.stage("load"):
        df = county(spark)
    with timer.stage("process"):
        out = df.groupBy("state").count()
    with timer.stage("write"):
        out.write.format("noop").mode("overwrite").save()
    rec = timer.record()
    assert set(rec) == {"load_time", "process_time", "write_time", "Total_time"}
    assert rec["Total_time"] >= rec["write_time"] >= 0
    timings.log_run(spark, rec, tmp_root, "Query1")
    timings.log_run(spark, rec, tmp_root, "Query1")
    log = sources.read_table(spark, tmp_root, "Query1", "Execution_Times")
    assert log.columns == ["Total_time", "load_time", "process_time", "write_time"]
    assert log.count() == 2
    assert averages.average_numeric(log).first().write_time == pytest.approx(rec["write_time"])


def test_input_bytes_and_shuffle_sizing(spark):
    from panelspark import session

    size = session.input_bytes(spark, ["/root/testdata/sf0.001/lineitem.parquet"])
    assert size == os.path.getsize("/root/testdata/sf0.001/lineitem.parquet")
    # the test session sets spark.sql.shuffle.partitions explicitly: left alone
    assert session.size_shuffle(spark, "/root/testdata/sf0.001/lineitem.parquet") is None


RECORDS = [{"name": n, "n": i} for i, n in enumerate("abcde")]


@pytest.mark.parametrize("layout", ["lines", "one line", "pretty", "array of lines", "objects over lines", "empty"])
def test_json_records_of_any_layout(spark, tmp_root, layout):
    """Never a prefix: all records, or an error."""
    path = os.path.join(tmp_root, "records.json")
    text = {
        "lines": "\n".join(map(json.dumps, RECORDS)),
        "one line": json.dumps(RECORDS),
        "pretty": json.dumps(RECORDS, indent=2),
        "array of lines": "[" + ",\n".join(map(json.dumps, RECORDS)) + "]",
        "objects over lines": "\n".join(json.dumps(r, indent=2) for r in RECORDS),
        "empty": "",
    }[layout]
    with open(path, "w") as fh:
        fh.write(text)
    if layout == "objects over lines":
        with pytest.raises(ValueError):
            sources.read_json_records(spark, path)
        return
    back = sources.read_json_records(spark, path, schema="name string, n long" if layout == "empty" else None)
    assert sorted((r.name, r.n) for r in back.collect()) == ([] if layout == "empty" else [(r["name"], r["n"]) for r in RECORDS])


def test_json_lines_read_as_a_document_fail_or_are_found(spark, tmp_root):
    path = os.path.join(tmp_root, "mixed")
    os.makedirs(path)
    for name, text in (("a.json", "\n".join(map(json.dumps, RECORDS))), ("b.json", json.dumps(RECORDS, indent=1))):
        with open(os.path.join(path, name), "w") as fh:
            fh.write(text)
    assert sources.read_json_records(spark, path).count() == 2 * len(RECORDS)


def test_json_export_is_read_by_several_tasks(spark, tmp_root):
    path = os.path.join(tmp_root, "events_json")
    ev = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    sinks.write_json_records(ev, path)
    back = sources.read_json_records(spark, path, schema=ev.schema)
    assert back.rdd.getNumPartitions() > 1
    assert back.count() == ev.count()


def test_csv_files_of_one_folder_must_agree(spark, tmp_root):
    path = os.path.join(tmp_root, "folder")
    os.makedirs(path)
    for name, text in (("a.csv", "geoid,deaths,cases\nX,1,2\nZ,3,4\n"), ("b.csv", "geoid,cases,deaths\nY,1,2\n")):
        with open(os.path.join(path, name), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, path, schema=schemas.COUNTY_DAILY).collect()


def test_csv_whole_numbers_in_any_form(spark, tmp_root):
    path = os.path.join(tmp_root, "numbers.csv")
    with open(path, "w") as fh:
        fh.write("geoid,cases\na,12.0\nb,1e3\nc,7\nd,\n")
    got = sources.read_csv(spark, path, schema=schemas.COUNTY_DAILY).select("geoid", "cases").collect()
    assert {r.geoid: r.cases for r in got} == {"a": 12, "b": 1000, "c": 7, "d": None}
    with open(path, "a") as fh:
        fh.write("e,1.5\n")
    with pytest.raises(Exception, match="cannot convert"):
        sources.read_csv(spark, path, schema=schemas.COUNTY_DAILY).collect()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_table_formats_round_trip(spark, tmp_root, fmt):
    df = spark.createDataFrame([("a", 1, 2.5), ("b", 2, None)], "name string, n long, x double")
    sinks.write_table(df, tmp_root, "d", "t", fmt=fmt)
    back = sources.read_table(spark, tmp_root, "d", "t", fmt=fmt).select("name", "n", "x")
    assert sorted(map(tuple, back.collect())) == [("a", 1, 2.5), ("b", 2, None)]


def test_text_tables_are_refused(spark, tmp_root):
    with pytest.raises(ValueError):
        sinks.write_table(spark.range(1), tmp_root, "d", "t", fmt="text")
    with pytest.raises(ValueError):
        sources.read_table(spark, tmp_root, "d", "t", fmt="text")


def test_csv_values_that_do_not_convert_are_diverted(spark, tmp_root):
    path = os.path.join(tmp_root, "bad.csv")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("absent", T.StringType())])
    rows = ["1,2020-01-01,x", "2,soon,y", "three,never,", ",,z", "5.0,2020-01-05,", "6.5,2020-01-06,w"]
    with open(path, "w") as fh:
        fh.write("\n".join(["k,day,other", *rows]) + "\n")
    good, bad = sources.divert_csv(spark, path, schema, os.path.join(tmp_root, "diverted"))
    assert good.columns == schema.fieldNames()
    assert {(r.k, str(r.day)) for r in good.collect()} == {(1, "2020-01-01"), (None, "None"), (5, "2020-01-05")}
    got = {(json.loads(r.line)["k"], r.column, r.text) for r in bad.collect()}
    assert got == {("2", "day", "soon"), ("three", "k", "three"), ("three", "day", "never"), ("6.5", "k", "6.5")}
    assert good.count() + bad.select("file", "line").distinct().count() == len(rows)
    assert {os.path.basename(r.file) for r in bad.collect()} == {"bad.csv"}
    assert ", ".join(f"{n} {t}" for n, t in bad.dtypes) == sources.REJECTS
    whole, _ = sources.divert_csv(spark, path, schema, os.path.join(tmp_root, "whole"), all_columns=True)
    assert whole.columns == ["k", "day", "other"] and whole.filter("other = 'z'").count() == 1
    # a file without bad values, and one without rows
    for name, lines in (("fine.csv", rows[:1]), ("empty.csv", [])):
        with open(os.path.join(tmp_root, name), "w") as fh:
            fh.write("\n".join(["k,day,other", *lines]) + "\n")
        good, bad = sources.divert_csv(spark, os.path.join(tmp_root, name), schema, os.path.join(tmp_root, name + ".out"))
        assert good.count() == len(lines) and bad.count() == 0
