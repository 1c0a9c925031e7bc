"""Insert job: append the records of a JSON file (an array of objects) to (database, table), then show
the rows whose column equals a value. With ``--key`` a record is added once, however often the job runs."""

from __future__ import annotations

import argparse
import sys

from panelspark import sinks, sources
from panelspark.jobs import _common as C
from panelspark.operators import merge, profile


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--records", required=True, help="JSON file or folder: arrays of objects, or one object or array a line")
    p.add_argument("--root", default=None)
    p.add_argument("--format", default="parquet")
    p.add_argument("--database", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--column", default=None)
    p.add_argument("--value", default=None)
    p.add_argument("--key", default=None, help="column that identifies a record; made from the record's content where it is absent or null")
    args = p.parse_args(argv)
    spark = C.start("insert_rows")
    root = args.root or C.session.scratch_root(spark) + "/panelspark-tables"
    rows = sources.read_json_records(spark, args.records)
    if args.key is not None:
        known = args.format not in sources.FILE_FORMATS or sources.table_exists(spark, root, args.database, args.table)
        existing = sources.read_table(spark, root, args.database, args.table, fmt=args.format) if known else None
        rows = merge.new_rows(rows, existing, args.key)
    sinks.write_table(rows, root, args.database, args.table, mode="append", fmt=args.format)
    if args.column is not None:
        table = sources.read_table(spark, root, args.database, args.table, fmt=args.format)
        profile.rows_for_key(table, args.column, args.value).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
