"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm.decontaminate import drop_contaminated
from mercato.llm.exact_dedup import drop_copies
from mercato.llm.mixing import mixed
from mercato.llm.quality import keep_good
from mercato.llm.shared import table, written
from mercato.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return drop_copies(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with size, source_size, target, copies and taken."""
    return mixed(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mix),
]

# The classifier, the fingerprints and the random order have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
