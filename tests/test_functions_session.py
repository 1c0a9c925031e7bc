import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from panelspark import functions as PF
from panelspark import session


def test_as_date():
    assert PF.as_date("2020-03-30") == dt.date(2020, 3, 30)
    assert PF.as_date("2020-03-30T12:00:00") == dt.date(2020, 3, 30)
    assert PF.as_date(dt.datetime(2020, 3, 30, 23, 59)) == dt.date(2020, 3, 30)


@pytest.mark.parametrize("dtype", ["date", "timestamp", "timestamp_ntz"])
def test_day_bounds_are_inclusive_calendar_days(spark, dtype):
    values = ["2020-03-29 23:59:59", "2020-03-30 00:00:00", "2020-04-15 23:59:59", "2020-04-16 00:00:00"]
    df = spark.createDataFrame([(v,) for v in values], "s string").select(F.col("s").cast(dtype).alias("t"))
    lo, hi = dt.date(2020, 3, 30), dt.date(2020, 4, 15)
    kept = df.filter(PF.on_or_after("t", lo, dtype) & PF.on_or_before("t", hi, dtype)).count()
    # dates lose the time of day: 03-29, 03-30, 04-15, 04-16 -> two days inside
    assert kept == 2
    assert df.filter(PF.before("t", lo, dtype)).count() == 1


def test_exact_sum_matches_decimal_sum(spark):
    prices = [0.1, 0.2, 0.3, 1234.56, 99999.99, 0.01] * 50
    df = spark.createDataFrame([(p,) for p in prices], "x double").repartition(7)
    exact = df.agg(PF.exact_sum("x", 2).alias("s")).first().s
    decimal = df.agg(F.sum(F.col("x").cast("decimal(18,2)")).cast("double").alias("s")).first().s
    assert exact == decimal
    assert df.agg(PF.exact_sum("x").alias("s")).first().s == pytest.approx(decimal)


def test_quarter_of_month(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = {r.m: r.q for r in df.select("m", PF.quarter_of_month("m").alias("q")).collect()}
    assert got == {m: (m - 1) // 3 + 1 for m in range(1, 13)}
    assert dict(df.select(PF.quarter_of_month("m").alias("q")).dtypes)["q"] == "int"


def test_scratch_root_is_the_checkpoint_folder(spark):
    root = session.scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root == configured.rstrip("/")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(root)


def test_get_spark_leaves_what_was_set(spark):
    assert session.get_spark("other-name") is spark
    keep = {"spark.sql.session.timeZone": "America/New_York", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        session.get_spark("again")
        assert {k: spark.conf.get(k) for k in keep} == keep
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
        session.get_spark("again")
        assert spark._jsparkSession.sessionState().conf().contains("spark.sql.adaptive.skewJoin.enabled")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_no_private_scratch_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://head:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.scratch_root(Session())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_beyond_64_bits(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = [90071992547409.91] * 3 + [0.01] * 7  # over 2**53 units together
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
        exact = sum(Decimal(repr(v)) for v in values)
        assert exact * 100 > 2**53 and df.agg(PF.exact_sum("x", 2).alias("s")).first().s == float(exact)
        big = spark.range(0, 30).select(F.lit(9e15).alias("x"))
        assert big.agg(PF.exact_sum("x", 6).alias("s")).first().s == 2.7e17  # 2.7e23 units
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_sums_keep_what_is_not_finite(spark, ansi):
    """As a plain sum has it, for every mix; groups of nulls stay null."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        nan, inf = float("nan"), float("inf")
        groups = [[1.0, nan, 2.0], [inf, 1.0], [-inf, 1.0, None], [inf, -inf], [None, None], [None, 1.25, -0.25], [0.0, -0.0], [inf, inf], [nan]]
        df = spark.createDataFrame([(g, v) for g, vs in enumerate(groups) for v in vs], "g int, x double").repartition(5)
        both = df.groupBy("g").agg(PF.exact_sum("x", 2).alias("exact"), F.sum("x").alias("plain"))
        assert both.filter(~F.col("exact").eqNullSafe(F.col("plain"))).collect() == [] and both.count() == len(groups)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("scale", [0, 2, 6, 13])
def test_exact_sums_round_as_decimals_do(spark, scale):
    """Halves, negative values, many digits: each value is the decimal it prints as, rounded half up."""
    values = [1.005, 2.675, -1.005, 0.125, 0.5, 1.5, -2.5, 1e15 + 0.3, 123456.7890125, 4.6e15, 1e-9, -7.0, 5e14 + 0.5]
    df = spark.createDataFrame([(v,) for v in values if abs(v) < 10.0 ** (28 - scale)], "x double")
    cast = F.col("x").cast(f"decimal(38,{scale})")
    # Each value by itself and all together.
    for found in (df.groupBy("x").agg(PF.exact_sum("x", scale).alias("a"), F.sum(cast).cast("double").alias("b")), df.agg(PF.exact_sum("x", scale).alias("a"), F.sum(cast).cast("double").alias("b"))):
        assert all(r.a == r.b for r in found.collect())


def test_exact_sums_of_whole_numbers_and_decimals(spark):
    df = spark.createDataFrame([(2**60 + 1, Decimal("1.005")), (2**60 + 1, Decimal("2.675")), (-(2**61), None)], "n long, d decimal(20,3)")
    r = df.agg(PF.exact_sum("n", 0).alias("n"), PF.exact_sum("d", 2).alias("d")).first()
    assert r.n == 2.0 and r.d == 3.69  # 1.01 + 2.68


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_exact_sums_raise_on_overflow(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="too large for an exact sum"):
            spark.range(1).select(F.lit(1e300).alias("x")).agg(PF.exact_sum("x", 2)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_exact_sums_do_not_depend_on_the_partitioning(spark):
    df = spark.range(20_000).select((F.rand(7) * 1e6).alias("x"))
    found = {df.repartition(n).agg(PF.exact_sum("x", 4).alias("s")).first().s for n in (1, 3, 16)}
    assert len(found) == 1


def test_parts_order_as_the_sums_do(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(g, v) for g, v in enumerate([-inf, -1.0, 0.0, 2.5, 2.5, inf, nan, None])], "g int, x double")
    sums = df.groupBy("g").agg(PF.exact_parts("x", 2).alias("p"))
    order = [r.g for r in sums.orderBy(PF.parts_order("p").asc_nulls_last(), "g").collect()]
    assert order == list(range(8))
