import json
import os

import pytest

from panelspark import schemas, sources
from panelspark.jobs import (
    copy_filtered,
    daily_change,
    insert_rows,
    peak_month,
    profile_table,
    quarter_leaders,
    timing_report,
)
from tests.fixtures import county_rows, weekly_rows


def _csv(path, header, rows):
    with open(path, "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(",".join("" if v is None else str(v) for v in r) + "\n")
    return path


@pytest.fixture()
def inputs(tmp_root):
    county = _csv(os.path.join(tmp_root, "us-counties.csv"), schemas.COUNTY_DAILY.fieldNames(), county_rows())
    wcols = ["country", "region", "region_code", "start_date", "year", "week", "population", "covid_deaths",
             "covid_deaths_per_100k"]
    weekly = _csv(os.path.join(tmp_root, "weekly.csv"), wcols, weekly_rows())
    return county, weekly, os.path.join(tmp_root, "tables")


def test_daily_change_job(spark, inputs):
    county, _, root = inputs
    assert daily_change.main(["--input", county, "--output-root", root, "--show", "0", "--timings-db", "Query1"]) == 0
    out = sources.read_table(spark, root, "Query1", "Average_Difference")
    assert out.columns == ["date", "geoid", "cases_avg", "cases_avg_diff", "cases_avg_per_100k_diff"]
    assert out.count() == 8
    assert sources.read_table(spark, root, "Query1", "Execution_Times").count() == 1
    # overwrite by default: a rerun does not duplicate; append does
    daily_change.main(["--input", county, "--output-root", root, "--show", "0"])
    assert sources.read_table(spark, root, "Query1", "Average_Difference").count() == 8
    daily_change.main(["--input", county, "--output-root", root, "--show", "0", "--mode", "append"])
    assert sources.read_table(spark, root, "Query1", "Average_Difference").count() == 16


def test_bad_values_go_to_a_table_of_their_own(spark, inputs):
    county, _, root = inputs
    with open(county, "a") as fh:
        names = schemas.COUNTY_DAILY.fieldNames()
        fh.write(",".join({"geoid": "USA-9", "state": "Utah", "date": "not-a-date", "cases": "abc"}.get(c, "1") for c in names) + "\n")
    common = ["--input", county, "--output-root", root, "--show", "0"]
    with pytest.raises(Exception, match="cannot convert"):
        peak_month.main(common)
    assert peak_month.main([*common, "--bad-values", "divert"]) == 0
    bad = sources.read_table(spark, root, "Rejects", "us-counties.csv")
    assert {(r.column, r.text) for r in bad.collect()} == {("date", "not-a-date"), ("cases", "abc")}
    assert {r.state for r in sources.read_table(spark, root, "Query2", "max_cases_per_year").collect()} >= {"Maine", "Ohio"}


def test_peak_month_job(spark, inputs):
    county, _, root = inputs
    assert peak_month.main(["--input", county, "--output-root", root, "--show", "0"]) == 0
    cases = {(r.state, r.year): r.month for r in sources.read_table(spark, root, "Query2", "max_cases_per_year").collect()}
    assert cases[("Maine", 2020)] == 4 and cases[("Ohio", 2020)] == 3
    deaths = sources.read_table(spark, root, "Query2", "max_deaths_per_year")
    assert deaths.columns == ["state", "year", "month", "total_deaths"]


def test_quarter_leaders_job(spark, inputs):
    _, weekly, root = inputs
    assert quarter_leaders.main(["--input", weekly, "--output-root", root, "--show", "0", "--top", "1"]) == 0
    rows = sources.read_table(spark, root, "Query3", "Max_deaths_year")
    assert rows.count() == 7
    top = sources.read_table(spark, root, "Query3", "Countries_Rancking")
    assert sorted(r.country for r in top.collect()) == ["A", "B", "B", "C"]
    assert quarter_leaders.main(
        ["--input", weekly, "--output-root", root, "--show", "0", "--quarter-mode", "calendar"]
    ) == 0


def test_profile_jobs(spark, inputs, capsys):
    county, weekly, root = inputs
    assert profile_table.main(["--input", weekly, "--output-root", root, "--table", "weekly", "--show", "5"]) == 0
    out = capsys.readouterr().out
    assert "Number of country values: 4" in out and "Number of region_code values: 2" in out
    assert profile_table.main(
        ["--input", county, "--output-root", root, "--table", "county", "--key", "USA-3", "--show", "5"]
    ) == 0
    out = capsys.readouterr().out
    assert "Number of geoid values: 3" in out and "Gamma" in out
    assert sources.read_table(spark, root, "Dataset", "us-counties").count() == len(county_rows())


def test_insert_copy_and_timing_jobs(spark, tmp_root, capsys):
    recs = os.path.join(tmp_root, "customers.json")
    with open(recs, "w") as fh:
        json.dump([{"name": "Ada", "address": "Quay 17"}, {"name": "Bo", "address": "Mill st 80"}], fh)
    root = os.path.join(tmp_root, "tables")
    args = ["--root", root, "--database", "mydb"]
    assert insert_rows.main(["--records", recs, *args, "--table", "customers", "--column", "address", "--value", "Quay 17"]) == 0
    assert "Ada" in capsys.readouterr().out
    assert copy_filtered.main([*args, "--table", "customers", "--target", "customers1", "--column", "address",
                               "--value", "Mill st 80"]) == 0
    assert [r.name for r in sources.read_table(spark, root, "mydb", "customers1").collect()] == ["Bo"]

    times = os.path.join(tmp_root, "times.json")
    with open(times, "w") as fh:
        json.dump([{"_id": {"$oid": "x"}, "Total_time": 2.0, "load_time": 1.0, "process_time": 0.5, "write_time": 0.5}], fh)
    assert timing_report.main(["--json", times]) == 0
    assert "Total_time: 2.0" in capsys.readouterr().out


def test_parquet_copy_then_daily_change(spark, inputs):
    """The recommended flow for large inputs: a year-partitioned parquet copy, then Q1 on it."""
    county, _, root = inputs
    assert profile_table.main(
        ["--input", county, "--output-root", root, "--table", "county", "--show", "0", "--partition-by", "year"]
    ) == 0
    copy = f"{root}/Dataset/us-counties"
    assert any(name.startswith("year=2020") for name in os.listdir(copy))
    out_root = f"{root}/from_parquet"
    assert daily_change.main(["--input", copy, "--input-format", "parquet", "--output-root", out_root, "--show", "0"]) == 0
    from_parquet = {tuple(r) for r in sources.read_table(spark, out_root, "Query1", "Average_Difference").collect()}
    daily_change.main(["--input", county, "--output-root", root, "--show", "0"])
    from_csv = {tuple(r) for r in sources.read_table(spark, root, "Query1", "Average_Difference").collect()}
    assert from_parquet == from_csv and len(from_csv) == 8


def test_insert_by_key_job_runs_twice(spark, tmp_root):
    recs = os.path.join(tmp_root, "customers.json")
    with open(recs, "w") as fh:
        json.dump([{"_id": "7", "name": "Ada"}, {"name": "Bo"}, {"name": "Bo"}], fh)
    root = os.path.join(tmp_root, "tables")
    for _ in range(2):
        assert insert_rows.main(["--records", recs, "--root", root, "--database", "mydb", "--table", "customers", "--key", "_id"]) == 0
        assert sorted(r.name for r in sources.read_table(spark, root, "mydb", "customers").collect()) == ["Ada", "Bo"]


def test_timing_report_of_mixed_documents(tmp_root, capsys):
    times = os.path.join(tmp_root, "times.json")
    with open(times, "w") as fh:
        json.dump([{"Total_time": "n/a", "load_time": 1}, {"Total_time": 4.0, "load_time": 2.5}], fh, indent=2)
    assert timing_report.main(["--json", times]) == 0
    out = capsys.readouterr().out
    assert "Total_time: 4.0" in out and "load_time: 1.75" in out


def test_profile_job_with_sketches(spark, inputs, capsys):
    county, _, root = inputs
    args = ["--input", county, "--output-root", root, "--table", "county", "--show", "0", "--sketch-into", "Profiles.county"]
    for n in (1, 2):  # a second load adds rows, but no values
        assert profile_table.main(args) == 0
        assert f"Number of geoid values: about 3 in {n * len(county_rows())} rows" in capsys.readouterr().out


def test_outputs_are_measured_by_their_write(spark, inputs):
    county, _, root = inputs
    args = ["--input", county, "--output-root", root, "--show", "0", "--timings-db", "Query2", "--versioned"]
    for _ in range(2):
        assert peak_month.main(args) == 0
    log = sources.read_table(spark, root, "Query2", "Output_Metrics").collect()
    assert sorted(r.output for r in log) == ["Query2.max_cases_per_year"] * 2 + ["Query2.max_deaths_per_year"] * 2
    for r in log:
        table = sources.read_table(spark, root, *r.output.split("."))
        assert r.n_rows == table.count() > 0 and set(r.nulls) == set(table.columns)
        assert all(n == table.filter(f"{c} IS NULL").count() for c, n in r.nulls.items())
    assert sources.read_table(spark, root, "Query2", "Execution_Times").count() == 2
