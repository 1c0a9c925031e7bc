"""panelspark: analytics on time-indexed panel data (one row per entity and day or week) in PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the DataFrame API, so the
whole query is one Catalyst plan: filters and column pruning reach the scan, aggregations combine
map-side before they shuffle, and no Python runs on rows.

Modules
-------
``session``      SparkSession with settings sized for large shuffles; shared scratch folder.
``schemas``      explicit StructTypes for the panel tables and the timing log.
``sources``      CSV, parquet, JSON-record-array and named-table readers.
``sinks``        table writers (overwrite / append) and the JSON-record-array writer.
``functions``    column expressions: calendar parts, exact sums, inclusive day ranges.
``operators``    panel (lagged change), periods (monthly totals, peak period), leaders (running
                 totals, quarter peak, top-n), profile (distinct values / counts), averages.
``plans``        the composite queries, for the panel tables and for the driver's tables.
``timings``      stage timer and the timing log.
``jobs``         ``spark-submit`` entry points.
"""

__version__ = "0.1.0"
