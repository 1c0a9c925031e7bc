"""Profile job: copy a panel table to Dataset.<name>, print its schema, distinct values and counts."""

from __future__ import annotations

import sys

from panelspark import functions as PF
from panelspark import schemas, sinks, sources
from panelspark.jobs import _common as C
from panelspark.operators import profile
from panelspark.plans import panel_queries as Q

SCHEMAS = {"weekly": schemas.COUNTRY_WEEKLY, "county": schemas.COUNTY_DAILY}


def main(argv=None) -> int:
    p = C.parser(__doc__)
    p.add_argument("--table", choices=sorted(Q.PROFILES), required=True)
    p.add_argument("--key-column", default=Q.COUNTY_PROFILE_KEY[0], help="column of the key whose rows are shown")
    p.add_argument("--key", default=None, help=f"show the rows of this key (county default: {Q.COUNTY_PROFILE_KEY[1]})")
    p.add_argument("--sketch-into", default=None, metavar="DB.TABLE", help="append this input's profile there; distinct counts are then estimates over all inputs profiled so")
    args = p.parse_args(argv)
    if args.key is None and args.table == "county":
        args.key = Q.COUNTY_PROFILE_KEY[1]
    copy_table, listed, counted = Q.PROFILES[args.table]
    spark = C.start(f"profile_{args.table}", [args.input])
    df = C.load(spark, args, SCHEMAS[args.table], all_columns=True)
    if "year" in (args.partition_by or "").split(",") and "year" not in df.columns:
        df = df.withColumn("year", PF.year("date"))
    C.write(df, spark, args, *copy_table)
    # Profile the copy just written: each listing below reads only its own column from it, instead of
    # parsing the source text once per listing.
    df = sources.read_table(spark, C.output_root(spark, args), *copy_table, fmt=args.format)
    df.printSchema()
    for c in listed:
        if c not in df.columns and c != "year":
            print(f"No column {c}")
            continue
        values = profile.distinct_values(df, PF.year("date") if c == "year" and c not in df.columns else c, c)
        values.show(profile.row_count(values), truncate=False)  # every value
    if args.sketch_into:
        # Only this input is read; what was profiled before comes from its sketches.
        where = args.sketch_into.split(".", 1)
        sinks.write_table(profile.sketch_profile(df, counted), C.output_root(spark, args), *where, mode="append")
        merged = profile.merge_profiles(sources.read_table(spark, C.output_root(spark, args), *where))
        for row in merged.orderBy("column").collect():  # a row a column
            print(f"Number of {row['column']} values: about {row['n_distinct']} in {row['n_rows']} rows")
    else:
        counts = profile.distinct_counts(df, counted).first().asDict()
        for name, value in counts.items():
            print(f"Number of {name[2:]} values: {value}")
    if args.key is not None:
        profile.rows_for_key(df, args.key_column, args.key).show(args.show)
    return 0


if __name__ == "__main__":
    sys.exit(main())
