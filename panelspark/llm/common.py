"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import session

# A word is a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order (an empty array for a null or blank text)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def id_bucket(doc_id: Column, n: int) -> Column:
    """``crc32(doc_id as text) mod n`` (null for a null id)."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def indices(n: Column) -> Column:
    """``[0, 1, .., n - 1]``; empty for n < 1 (``sequence`` alone would count downwards)."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


# Prefixes run over blocks of this many values, so a text with very many matches costs about
# n * BLOCK steps instead of n * n.
BLOCK = 128


def prefix_sums(values: Column) -> Column:
    """Exclusive prefix sums of an int array."""
    return prefixes(values, 0, lambda a, b: a + b)


def furthest(values: Column) -> Column:
    """For every place of an int array the largest value before it, -1 for none (values are not below -1)."""
    return prefixes(values, -1, lambda a, b: F.greatest(a, b))


def prefixes(values: Column, nothing: int, join: Callable[[Column, Column], Column]) -> Column:
    """Exclusive prefixes of an int array under ``join`` (by index: ``slice`` would copy the whole array each time)."""

    def part(v: Column, start: Column, n: Column) -> Column:
        return F.aggregate(indices(n), F.lit(nothing), lambda acc, k: join(acc, F.coalesce(F.get(v, start + k), F.lit(nothing))))

    def within(v: Column, blocks: Column, i: Column) -> Column:
        b = F.floor(i / F.lit(BLOCK)).cast("int")
        return join(F.get(blocks, b), part(v, b * BLOCK, i % BLOCK))

    def offsets(sums: Column) -> Column:
        return F.transform(sums, lambda _, b: part(sums, F.lit(0), b))

    def over(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / F.lit(BLOCK)).cast("int")
        sums = F.transform(indices(n_blocks), lambda b: part(v, b * BLOCK, F.lit(BLOCK)))
        return let(
            let(sums, offsets),
            lambda blocks: F.transform(indices(F.size(v)), lambda i: within(v, blocks, i)),
        )

    return let(values, over)


# Code points of a piece of a long text: finding a place in a string takes a walk from its start.
PIECE = 1024


def pieces(text: Column) -> Column:
    """The text in strings of ``PIECE`` code points, the last one shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def stretch(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` (from 0) to ``end`` (exclusive) of the text whose :func:`pieces` are ``parts``."""
    first, last = F.floor(start / F.lit(PIECE)).cast("int"), F.floor(end / F.lit(PIECE)).cast("int")
    inner = F.transform(indices(last - first - 1), lambda k: F.get(parts, first + 1 + k))
    across = F.concat(
        F.substring(F.get(parts, first), start % PIECE + 1, F.lit(PIECE)),
        F.array_join(inner, ""),
        F.coalesce(F.substring(F.get(parts, last), F.lit(1), end % PIECE), F.lit("")),
    )
    return F.when(end <= start, "").when(first == last, F.substring(F.get(parts, first), start % PIECE + 1, end - start)).otherwise(across)


def matches(text: Column, pattern: Column | str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start int, end int, hit string>>``.

    Offsets count code points, ends are exclusive; ``hit`` is the given group. The text between matches
    comes from ``split``, the matches from ``regexp_extract_all``: positions are prefix sums of the
    lengths of both. The pattern must not match the empty string.
    """
    rx = F.lit(pattern) if isinstance(pattern, str) else pattern
    gaps = F.transform(F.split(text, rx, -1), lambda s: F.length(s))
    hits = F.regexp_extract_all(text, rx, F.lit(0))
    groups = F.regexp_extract_all(text, rx, F.lit(group)) if group else None

    def place(gap: Column, hit: Column, grp: Column) -> Column:
        steps = F.transform(hit, lambda h, i: F.get(gap, i) + F.length(h))
        return let(
            prefix_sums(steps),
            lambda before: F.transform(
                hit,
                lambda h, i: F.struct(
                    (F.get(before, i) + F.get(gap, i)).alias("start"),
                    (F.get(before, i) + F.get(gap, i) + F.length(h)).alias("end"),
                    F.get(grp, i).alias("hit"),
                ),
            ),
        )

    found = let(
        gaps,
        lambda gap: let(hits, lambda hit: place(gap, hit, hit) if groups is None else let(groups, lambda g: place(gap, hit, g))),
    )
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    return F.when(F.regexp_like(text, rx), found).otherwise(none)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return next(n for i in range(len(taken) + 1) if (n := f"{name}_{i}") not in taken)


_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def stored(df: DataFrame, *name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: cuts the lineage, survives lost executors.

    Inside :func:`temporary` the table belongs to that block and is removed with it.
    """
    spark = df.sparkSession
    path = session.scratch_path(spark, *name)
    owner = _owned.get()
    if owner is not None:
        owner.append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The block of a :func:`temporary`."""

    def __init__(self, outer: list[str] | None) -> None:
        self._outer = outer

    def kept(self, df: DataFrame, *name: str, **options: str) -> DataFrame:
        """``stored``, but the table outlives the block: it belongs to the block around it, if there is one."""
        inner = _owned.set(self._outer)
        try:
            return stored(df, *name, **options)
        finally:
            _owned.reset(inner)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Scratch]:
    """The tables that ``stored`` writes inside the block are removed at its end, also when it fails.

    What the block returns must not read them: give it out as ``kept`` table.
    """
    paths: list[str] = []
    outer = _owned.set(paths)
    try:
        yield Scratch(outer.old_value if isinstance(outer.old_value, list) else None)
    finally:
        _owned.reset(outer)
        removed(spark, paths)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more (without a JVM at hand, as on Spark Connect, they stay)."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:
        return
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    # Shuffle files of finished steps go when the driver collects their plans, which it may not do for long by itself.
    jvm.System.gc()


def file_rows(df: DataFrame) -> list[Column] | None:
    """Path of the file and number in it of every row, if ``df`` is a Parquet table as it was read; else None.

    They are the same at each reading, so rows can be told apart without a copy of the table.
    """
    try:
        plain = df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation"
        meta = df.metadataColumn("_metadata") if plain else None
        at = [meta["file_path"], meta["row_index"]] if plain else None
        return at if at and df.select(*at).columns else None
    except (AnalysisException, AttributeError):  # no such columns in this format; no JVM at hand on Spark Connect
        return None
