"""``spark-submit`` entry points, one module per job; each has ``main(argv)``.

    spark-submit --py-files panelspark.zip panelspark/jobs/daily_change.py --input /data/us-counties.csv --output-root s3a://bucket/tables
"""
