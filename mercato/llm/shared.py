"""Helpers the text operators share: written tables, text normalisation, size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.scratch import scratch_path as scratch_path
from mercato.sources.scratch import written as written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A side of at most this many narrow rows (ids, hashes) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000

# Words of runs of letters, digits and everything beyond ASCII, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the quick built-in, which then means the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def full_text(text: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(text), F.lit(""))


def packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct ``doc``, so that helper columns cannot clash with the caller's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether a written side has at most ``limit`` rows."""
    return df.limit(limit + 1).count() <= limit


def checked(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A side to join with: broadcast if its counted rows stay within ``limit``, else left to a shuffled join."""
    return F.broadcast(df) if small_enough(df, limit) else df


def row_hash(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells apart rows that share an id, or have none, by their text."""
    return F.xxhash64(F.coalesce(F.col(doc_id), F.lit(-1)), full_text(text))


def matched(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Packed documents joined with rows that have their doc_id and row_hash.

    Those rows are counted first. Few of them are broadcast and the texts stay where they
    are; many are joined by shuffling.
    """
    held = packed(docs).withColumn("_hash", row_hash("doc.doc_id", "doc.text"))
    return held.join(checked(rows), F.col("doc.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("row_hash")), how)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, row_hash) is not in ``dropped``."""
    return matched(docs, dropped.select("doc_id", "row_hash"), "left_anti").select("doc.*")
