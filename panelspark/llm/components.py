"""Connected components of a large link table by smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); ``label`` is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then the label of its label, so
    labels travel twice as far each time; it ends with a round that changes nothing. Minima combine
    map-side, so a node with very many links is no group of its own, and every round is a written
    table, so nothing is recomputed when an executor is lost.
    """
    links = links.filter("a <> b")
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("l"))
        near = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = moved.join(of_label, "label").select("node", F.least("label", "far").alias("label"), (F.least("label", "far") != F.col("old")).alias("changed"))
        step = stored(jumped, "labels")
        labels = step.select("node", "label")
        if step.filter("changed").isEmpty():
            return labels
