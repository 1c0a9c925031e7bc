"""Copy job: read (database, table), keep the rows of one key, write them to another table, read back."""

from __future__ import annotations

import argparse
import sys

from panelspark import sinks, sources
from panelspark.jobs import _common as C
from panelspark.operators import profile
from panelspark.plans import panel_queries as Q


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--root", default=None, help="root of file tables (default: shared scratch folder)")
    p.add_argument("--format", default="parquet")
    p.add_argument("--database", default=Q.COPY_SOURCE[0])
    p.add_argument("--table", default=Q.COPY_SOURCE[1])
    p.add_argument("--target", default=Q.COPY_TARGET)
    p.add_argument("--column", default=Q.COPY_FILTER[0])
    p.add_argument("--value", default=Q.COPY_FILTER[1])
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    args = p.parse_args(argv)
    spark = C.start("copy_filtered")
    root = args.root or C.session.scratch_root(spark) + "/panelspark-tables"
    src = sources.read_table(spark, root, args.database, args.table, fmt=args.format)
    hits = profile.rows_for_key(src, args.column, args.value)
    hits.show()
    sinks.write_table(hits, root, args.database, args.target, mode=args.mode, fmt=args.format)
    sources.read_table(spark, root, args.database, args.target, fmt=args.format).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
