"""Digests of files of any length, computed by many tasks.

A line's digest is its SHA-256. A block is a fixed number of lines; its digest is the SHA-256
of its lines' digests in order, and a file's that of its blocks' (all in lowercase hex). So
one file is hashed by as many tasks as it has splits and blocks, no value grows with the
file but the list of its blocks, and the same digest can be computed from the rows a file
was written from, without the file. Only digests and numbers are moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_LINES = 10_000


def _of_list(part: str, at: str):
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(at, part))), lambda x: x[part])
    return F.sha2(F.array_join(ordered, ""), 256)


def digests(lines: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """file, lines, digest of rows (file, number from 0, value)."""
    hashed = lines.select("file", "number", F.sha2("value", 256).alias("line"), F.floor(F.col("number") / block_lines).alias("block"))
    blocks = hashed.groupBy("file", "block").agg(_of_list("line", "number").alias("part"), F.count(F.lit(1)).alias("n"))
    return blocks.groupBy("file").agg(F.sum("n").alias("lines"), _of_list("part", "block").alias("digest"))


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file (its full path), number, value of every line; a carriage return belongs to its line.

    Ids rise along a split. Splits are counted first, one row each, so no line is moved to be numbered.
    """
    text = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    splits = text.groupBy("file", "split").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("shift"))
    return text.join(splits, ["file", "split"]).select("file", (F.col("id") + F.col("shift")).alias("number"), "value")


def file_digests(spark: SparkSession, path: str | list[str], block_lines: int = BLOCK_LINES) -> DataFrame:
    """file, lines, digest of every text file under ``path``."""
    return digests(numbered_lines(spark, path), block_lines)


def compared(found: DataFrame, listed: DataFrame) -> DataFrame:
    """file, status (ok, changed, missing, unlisted), found_lines, found_digest of files found or listed, each as file, lines, digest."""
    there = found.select("file", F.col("lines").alias("found_lines"), F.col("digest").alias("found_digest"))
    both = listed.join(there, "file", "full")
    status = (F.when(F.col("found_digest").isNull(), "missing").when(F.col("digest").isNull(), "unlisted")
              .when((F.col("digest") == F.col("found_digest")) & (F.col("lines") == F.col("found_lines")), "ok").otherwise("changed"))
    return both.select("file", status.alias("status"), "found_lines", "found_digest")
