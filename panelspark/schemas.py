"""Explicit schemas of the panel tables (so no inference pass over the input is needed)."""

from __future__ import annotations

from pyspark.sql import types as T

# Daily county panel: one row per (geoid, date); the *_avg columns are trailing 7-day averages that
# arrive in the data.
COUNTY_DAILY = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("geoid", T.StringType()),
        T.StructField("county", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("cases", T.LongType()),
        T.StructField("cases_avg", T.DoubleType()),
        T.StructField("cases_avg_per_100k", T.DoubleType()),
        T.StructField("deaths", T.LongType()),
        T.StructField("deaths_avg", T.DoubleType()),
        T.StructField("deaths_avg_per_100k", T.DoubleType()),
    ]
)

# Weekly country panel: one row per (country, week).
COUNTRY_WEEKLY = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("days", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("population", T.LongType()),
        T.StructField("total_deaths", T.DoubleType()),
        T.StructField("covid_deaths", T.DoubleType()),
        T.StructField("expected_deaths", T.DoubleType()),
        T.StructField("excess_deaths", T.DoubleType()),
        T.StructField("non_covid_deaths", T.DoubleType()),
        T.StructField("covid_deaths_per_100k", T.DoubleType()),
        T.StructField("excess_deaths_per_100k", T.DoubleType()),
        T.StructField("excess_deaths_pct_change", T.DoubleType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
    ]
)

# One row per timed run. Field order is the sorted order a dict-built row gets.
TIMING_RECORD = T.StructType(
    [
        T.StructField("Total_time", T.DoubleType()),
        T.StructField("load_time", T.DoubleType()),
        T.StructField("process_time", T.DoubleType()),
        T.StructField("write_time", T.DoubleType()),
    ]
)

# The exported form adds the document id.
TIMING_EXPORT = T.StructType(
    [T.StructField("_id", T.StructType([T.StructField("$oid", T.StringType())]))] + TIMING_RECORD.fields
)
