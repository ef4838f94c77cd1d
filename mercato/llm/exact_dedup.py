"""Exact de-duplication with a heavy-hitter split.

Texts are equal if identical after lower-casing A-Z; SHA-256 of that text stands for it.

1. A Misra-Gries summary per partition, merged by adding counters, names at most
   ``counters`` digests that may hold more than one row in ``counters + 1``.
2. Those candidates are counted exactly. The verified heavy ones, at most ``counters``
   rows by construction, are broadcast, and their copies are settled in the map tasks.
3. All other digests, each rarer than one row in ``counters + 1``, take an ordinary shuffle.

Defined cases: a null text is empty; a null id sorts below every id; of rows equal in
text and id one arbitrary row stays; an empty table gives an empty result; other columns
are carried by ``drop_copies`` and ignored by ``copy_groups``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ascii_lower, full_text, packed, written

COUNTERS = 1024


def _digest(text: str = "text"):
    return F.unhex(F.sha2(ascii_lower(full_text(text)), 256))


def _summaries(counters: int):
    def of_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: pd.Series = pd.Series(dtype="int64")
        for batch in batches:
            seen = seen.add(batch["digest"].value_counts(), fill_value=0)
            if len(seen) > counters:
                seen = seen.nlargest(counters + 1)
                seen = seen[:-1] - seen.iloc[-1]
                seen = seen[seen > 0]
        yield pd.DataFrame({"digest": seen.index, "seen": seen.astype("int64").values})

    return of_partition


def heavy_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests held by more than one row in ``counters + 1``: digest, winner (doc_id, row), group_size.

    A digest that frequent in all is that frequent in some partition, so some summary
    names it; merging keeps the ``counters`` largest sums, as Misra-Gries summaries merge.
    """
    total = digests.count()
    summaries = digests.select("digest").mapInPandas(_summaries(counters), "digest binary, seen bigint")
    merged = summaries.groupBy("digest").agg(F.sum("seen").alias("seen"))
    candidates = merged.orderBy(F.desc("seen"), "digest").limit(counters).select("digest")
    exact = digests.join(F.broadcast(candidates), "digest").groupBy("digest").agg(
        F.max(F.struct("doc_id", "row")).alias("winner"), F.count(F.lit(1)).alias("group_size"))
    return written(exact.filter(F.col("group_size") * (counters + 1) > total).filter("group_size > 1"), "heavy-digests")


def _digest_table(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id", _digest().alias("digest")).withColumn("row", F.monotonically_increasing_id()), "digests")


def copy_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, heavy."""
    digests = _digest_table(docs)
    heavy = heavy_digests(digests, counters)
    split = digests.join(F.broadcast(heavy), "digest", "left")
    group = Window.partitionBy("digest")
    light = (digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
             .withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
             .withColumn("group_size", F.count(F.lit(1)).over(group)))
    wanted = [F.col("doc_id"), F.col("winner.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("winner.row")).alias("kept"),
              F.lower(F.hex("digest")).alias("text_sha256")]
    return (split.filter("winner is not null").select(*wanted, F.lit(True).alias("heavy"))
            .unionByName(light.select(*wanted, F.lit(False).alias("heavy"))))


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the one with the largest doc_id."""
    heavy = heavy_digests(_digest_table(docs), counters).select("digest", F.col("winner.doc_id").alias("keep"), F.lit(True).alias("heavy"))
    left = packed(docs).withColumn("digest", _digest("doc.text")).join(F.broadcast(heavy), "digest", "left")
    left = left.filter(F.col("heavy").isNull() | F.col("doc.doc_id").eqNullSafe(F.col("keep")))
    first = Window.partitionBy("digest").orderBy(F.col("doc.doc_id").desc_nulls_last())
    return left.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("doc.*")
