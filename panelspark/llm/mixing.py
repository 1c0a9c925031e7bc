"""Mixing sources to target weights.

Tokens are summed per source (map-side, so a hot source is combined before it shuffles), targets follow
from the weights, and each document is taken ``floor(rate)`` times plus once more with probability equal
to the fraction, where ``rate = target / tokens of the source``. The coin is a hash of the seed, the
source and the document id, so reruns agree.

Targets: all tokens are shared by weight; a target stops at ``max_repeat`` times its source's tokens and
the excess is shared again by weight among the others until none is above. That is ``min(max_repeat *
tokens, level * weight)`` for one water level, found by a few aggregations over the table of sources, each
returning one row.

No source is gathered anywhere: sources are numbered by a range partitioning of the (aggregated) source
table with one offset per partition, and the per-source rates are joined back by Spark's choice (broadcast
below its size threshold, else a sort-merge join whose skewed partitions adaptive execution splits).

Defined cases: a null text has size 0; a null source is a source of its own, numbered last; a source
without words has target 0 and its documents are not taken; a null id is hashed as such; repeated rows get the same
coin; an empty table gives an empty result; columns of any name pass through :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import stored, words

SEED = 20240517


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def numbered_sources(sources: DataFrame) -> DataFrame:
    """``source_rank`` from 0 by code point, null last, without sorting all sources in one task."""
    ranged = stored(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "mix_sources"
    )
    # One row per partition, so at most as many as there are shuffle partitions.
    per_part = ranged.groupBy("part").count()
    before = per_part.select(
        "part", (F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    joined = ranged.withColumn("inside", inside).join(before, "part")
    return joined.select("source", "source_size", (F.col("inside") + F.coalesce("before", F.lit(0))).alias("source_rank"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_rank") % len(weights) + 1).cast("int"))
    ranked = stored(
        numbered_sources(sums).select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_repeat).alias("most")),
        "mix_targets",
    )
    everything = ranked.agg(F.sum("source_size").alias("t")).first()["t"] or 0
    # Raise the water level until no further source reaches its cap. Each round caps at least one more
    # source; its result is one row.
    rest, weight_sum, level = everything, 0, None
    while True:
        capped = F.lit(False) if level is None else F.col("most") < F.lit(level) * F.col("weight")
        row = ranked.agg(
            F.sum(F.when(capped, F.col("most")).otherwise(0)).alias("full"), F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("w")
        ).first()
        rest, weight_sum = everything - (row["full"] or 0), row["w"] or 0
        raised = rest / weight_sum if weight_sum else level or 0.0
        if level is not None and raised <= level:
            break
        level = raised
    share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weight_sum or 1))
    target = F.when(F.col("most") < F.lit(level) * F.col("weight"), F.col("most").cast("double")).otherwise(F.least(share, F.col("most").cast("double")))
    return ranked.select("source", "source_size", target.alias("target"))


def coin(*key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the key: the first 52 bits of a digest, so that any SQL engine can repeat it."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def copies(rate: Column, *key: Column, seed: int = SEED) -> Column:
    """``floor(rate)`` plus one with probability ``rate - floor(rate)``, by a hash of the key."""
    whole = F.floor(rate)
    return F.coalesce(whole + F.when(coin(*key, seed=seed) < rate - whole, 1).otherwise(0), F.lit(0)).cast("int")


def with_rates(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows with the size, target and rate of their source (null sources match each other)."""
    t = targets.withColumnRenamed("source", "mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return sized.join(t, F.col("source").eqNullSafe(F.col("mix_source"))).drop("mix_source").withColumn("rate", rate)


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) for every document; texts are read once."""
    sized = stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "mix_sizes")
    rated = with_rates(sized, source_targets(sized, weights, max_repeat))
    return rated.withColumn("copies", copies(F.col("rate"), F.col("source"), F.col("doc_id"), seed=seed))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3, seed: int = SEED) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken, with its own columns."""
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    sized = own.select(F.col("row.source").alias("source"), size_of(F.col("row.text")).alias("size"))
    rated = with_rates(own.select("row", F.col("row.source").alias("source")), source_targets(sized, weights, max_repeat))
    times = copies(F.col("rate"), F.col("source"), F.col("row.doc_id"), seed=seed)
    taken = rated.select("row", times.alias("times")).filter("times > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("n")).select("row.*")
