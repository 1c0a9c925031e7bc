"""The corpus pipeline: quality classifier, near-duplicates, secrets, mixing, packing.

``run`` applies the stages to the documents table; each stage's result is written as Parquet to the shared
scratch folder and read again as the next one's input. A result is removed once the next one is written, a stage's other tables with its end. All stages but the last return the columns of the
documents. Null texts and ids, repeated rows, empty tables and extra columns are treated as the operators' modules say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import session
from panelspark.llm import line_crf, minhash, mixing, packing, secrets
from panelspark.llm.common import removed, table, temporary, unused

KEEP_FROM = 0.3  # document quality from which a document stays
SHINGLE, SIMILAR = 5, 80  # words of a shingle, per cent


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are mostly bad go; the classifier learns from all labelled documents."""
    model = line_crf.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    score = unused(docs, "score")
    return line_crf.score_documents(docs, model, score=score).filter(F.col(score) >= KEEP_FROM).drop(score)


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return minhash.deduplicate(docs, SHINGLE, SIMILAR)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; found secrets are cut out of the text."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("near-duplicates", duplicates_stage),
    ("secret scans", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The classifier, the near-duplicates and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with temporary(spark):
            path = session.scratch_path(spark, "pipeline", name.replace(" ", "-"))
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            removed(spark, [before])
        before = path
    return docs
