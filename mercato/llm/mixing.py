"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share all
words of the input; a target stops at ``MAX_COPIES`` times its source and the excess goes
to the others by weight.

A source whose target is r times its size gives every document floor(r) certain whole
copies. The words left over are drawn as one more copy of some documents, with inclusion
probabilities proportional to size: p = size / t, and certain from size t on, where t is
the size at which the expected words are those left over. Documents are ranked by Pareto's
ratio, random odds u/(1-u) over inclusion odds p/(1-p), and taken whole in that order while
the words still fit the source's target; so the sample's size is fixed in words. Behind the
first document that does not fit the ranking goes on among those that do, larger sizes
first and by rank within a size, until no document left is as small as the words missing.
One closing document per source, the one whose size is nearest to those, is added if that
brings the total nearer.

The cut in the ranking is found by two histogram refinements per source, so even a source
with a third of all rows is never gathered in one task: a window sees at most ``BUCKETS``
rows of counts, or the documents of one bucket of a bucket. Thresholds and the filling by
size work on one row per source and size.

Defined cases: a null text has size 0; documents of size 0 take 0; a null source is a
source of its own; u is a hash of id and text, so reruns agree and identical rows rank
together; no words at all gives targets of 0; other columns are ignored, or carried by
``mixed``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import checked, full_text, matched, row_hash, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096
SEED = 20240229


@F.pandas_udf(T.LongType())
def _word_count(texts: pd.Series) -> pd.Series:
    return pd.Series([len(t.encode().split()) for t in texts], dtype="int64")  # bytes split at ASCII white space only


def _sizes(docs: DataFrame) -> DataFrame:
    noise = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.coalesce(F.col("doc_id"), F.lit(-1)), full_text()), 11)
    return written(docs.select("doc_id", "source", row_hash().alias("row_hash"), _word_count(full_text()).alias("size"), noise.alias("noise"))
                   .withColumn("row", F.monotonically_increasing_id()), "sizes")


def _numbered(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, their position in code-point order, without one task that sorts them all."""
    order = F.col("source").asc_nulls_last()
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = written(sources.repartitionByRange(order).sortWithinPartitions(order)
                     .withColumn("part", F.spark_partition_id()).withColumn("offset", in_part), "sources")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", before)
    return ranged.join(parts, "part").select("source", "source_size", (F.col("before") + F.col("offset")).alias("place"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """place, source, source_size, target. Only totals reach the driver."""
    sources = _numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(max_copies)), "weights")
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, -1
    while True:
        over = F.col("most") < F.col("weight") * F.lit(share)
        held, open_weight, n = sources.agg(F.sum(F.when(over, F.col("most")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
                                           F.sum(over.cast("int"))).first()
        if n == full or not open_weight or not words:
            break
        share, full = (words - held) / open_weight, n
    return sources.select("place", "source", "source_size", F.least("most", F.col("weight") * F.lit(share)).alias("target"))


def _cut(counts: DataFrame, start: str) -> DataFrame:
    """Per source the first bucket that no longer fits, and the words before it."""
    running = F.sum("words").over(Window.partitionBy("place").orderBy("bucket"))
    return (counts.withColumn("upto", F.col(start) + running).filter("upto > rest").groupBy("place")
            .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
            .select("place", F.col("cut.bucket").alias("bucket"), F.col("cut.before").alias("before")))


def _thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """place, least_certain: the size from which on a document is certain, for sources with words left over."""
    known = checked(targets.filter("rest > 0").select(F.col("source").alias("_source"), "place", "rest"))
    by_size = sizes.filter("size > 0").groupBy("source", "size").agg(F.sum("size").alias("words"))
    by_size = by_size.join(known, F.col("source").eqNullSafe(F.col("_source"))).select("place", "rest", "size", F.col("words").cast("double"))
    larger = Window.partitionBy("place").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("place").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    summed = by_size.withColumn("above", F.coalesce(F.sum("words").over(larger), F.lit(0.0))).withColumn("squares", F.sum(F.col("size") * F.col("words")).over(smaller))
    reached = summed.filter((F.col("above") < F.col("rest")) & (F.col("above") + F.col("squares") / F.col("size") >= F.col("rest")))
    best = reached.groupBy("place").agg(F.max(F.struct("size", "above", "squares", "rest")).alias("at"))
    return best.select("place", (F.col("at.squares") / (F.col("at.rest") - F.col("at.above"))).alias("least_certain"))


def _fill(left: DataFrame, gaps: DataFrame) -> DataFrame:
    """Rows of ``left`` that fill each source's ``gap``, larger sizes first and by rank within a size: place, row, size.

    A fold over one row per size decides how many documents of a size are taken; fewer than
    ``gap`` are, and a gap is smaller than one document.
    """
    fitting = left.join(checked(gaps.filter("gap >= 1")), "place").filter("size <= gap")
    counted = fitting.groupBy("place", "gap", "size").agg(F.count(F.lit(1)).alias("n"))
    folded = counted.groupBy("place", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"))
    takes = folded.withColumn("done", F.expr("""aggregate(sizes, struct(cast(floor(gap) as bigint) as gap, cast(array() as array<struct<size: bigint, take: bigint>>) as picks),
        (a, s) -> if(s.size > a.gap, a, struct(a.gap - least(s.n, a.gap div s.size) * s.size as gap, array_append(a.picks, struct(s.size as size, least(s.n, a.gap div s.size) as take)) as picks)))"""))
    takes = written(takes.select("place", F.explode("done.picks").alias("pick")).select("place", "pick.size", "pick.take"), "fill")
    most = takes.agg(F.max("take")).first()[0] or 0
    order = Window.partitionBy("place", "size").orderBy("rank", "noise", "doc_id", "row")
    ranked = left.join(checked(takes), ["place", "size"]).withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    return written(ranked.filter(F.col("nth") <= F.col("take")).select("place", "row", "size"), "filled")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, source, row_hash, size, source_size, target, copies, taken."""
    sizes = _sizes(docs)
    targets = source_targets(sizes, weights, max_copies)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = targets.withColumn("whole", F.floor(rate)).withColumn("chance", rate - F.floor(rate))
    targets = written(targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    targets = written(targets.join(_thresholds(sizes, targets), "place", "left"), "thresholds")
    u = (F.col("noise") + 0.5) / float(1 << 53)
    odds = F.col("size") / (F.col("least_certain") - F.col("size"))
    ratio = (u / (1 - u)) / odds
    rank = (F.when(F.col("least_certain").isNull() | (F.col("size") == 0), 1.0)
            .when(F.col("size") >= F.col("least_certain"), 0.0).otherwise(ratio / (1 + ratio)))  # Pareto's ratio, brought into 0 to 1
    known = checked(targets.withColumnRenamed("source", "_source"))
    ranked = written(sizes.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("rank", rank)
                     .withColumn("coarse", F.least(F.floor(F.col("rank") * buckets), F.lit(buckets - 1)))
                     .withColumn("fine", F.least(F.floor((F.col("rank") * buckets - F.col("coarse")) * buckets), F.lit(buckets - 1))), "ranked")
    filled = ranked.filter("size > 0")
    coarse = filled.groupBy("place", "rest", F.col("coarse").alias("bucket")).agg(F.sum("size").alias("words")).withColumn("start", F.lit(0))
    outer = written(_cut(coarse, "start").select("place", F.col("bucket").alias("outer"), F.col("before").alias("start")), "coarse-cut")
    inside = filled.join(checked(outer), "place").filter("coarse = outer")
    fine = inside.groupBy("place", "rest", "start", F.col("fine").alias("bucket")).agg(F.sum("size").alias("words"))
    cuts = written(outer.join(_cut(fine, "start").select("place", F.col("bucket").alias("inner"), F.col("before").alias("base")), "place"), "cuts")
    order = Window.partitionBy("place").orderBy("rank", "noise", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    edge = (filled.join(checked(cuts), "place").filter("coarse = outer and fine = inner")
            .withColumn("upto", F.col("base") + F.sum("size").over(order)))
    edge = written(edge.select("place", "row", "rest", "base", "upto", (F.col("upto") <= F.col("rest")).alias("fits")), "edge")
    reached = cuts.select("place", "base").join(edge.filter("fits").groupBy("place").agg(F.max("upto").alias("upto")), "place", "left")
    reached = reached.select("place", F.coalesce("upto", "base").alias("reached"))
    marks = written(targets.select("place").join(cuts, "place", "left").join(reached, "place", "left"), "marks")
    first = (F.col("coarse") < F.col("outer")) | ((F.col("coarse") == F.col("outer")) & (F.col("fine") < F.col("inner")))
    chosen = F.when(F.col("outer").isNull() | (F.col("chance") == 0), F.lit(False)).otherwise(first | F.coalesce("fits", F.lit(False)))
    picked = written(ranked.join(checked(marks), "place").join(checked(edge.select("row", "fits").filter("fits")), "row", "left")
                     .withColumn("chosen", chosen), "ranked-out")
    left = picked.filter("not chosen and size > 0 and least_certain is not null")
    gaps = marks.join(targets.select("place", "rest"), "place").select("place", (F.col("rest") - F.col("reached")).alias("gap")).filter("gap is not null")
    filled_up = _fill(left, gaps)
    added = filled_up.groupBy("place").agg(F.sum("size").alias("added"))
    picked = picked.join(checked(filled_up.select("row", F.lit(True).alias("fills"))), "row", "left").join(checked(written(added, "added")), "place", "left")
    missing = F.col("rest") - F.col("reached") - F.coalesce("added", F.lit(0))
    off = F.abs(F.col("size") - missing)
    closing = (picked.filter("not chosen and fills is null and size > 0 and least_certain is not null").filter(off < missing)
               .groupBy("place").agg(F.min(F.struct(off.alias("off"), "rank", "noise", "doc_id", "row")).alias("best"))
               .select(F.col("best.row").alias("row"), F.lit(True).alias("closes")))
    picked = picked.join(checked(written(closing, "closing")), "row", "left")
    picked = picked.withColumn("chosen", F.col("chosen") | F.coalesce("fills", F.lit(False)))
    copies = F.col("whole") + (F.col("chosen") | F.coalesce("closes", F.lit(False))).cast("int")
    return picked.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("bigint")).select(
        "doc_id", "source", "row_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents the mix takes, once each, with size, source_size, target, copies and taken.

    Columns of those names in ``docs`` are replaced.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    plan = plan_mix(docs).filter("taken > 0").groupBy("doc_id", "row_hash").agg(*[F.first(c).alias(c) for c in added])
    return matched(docs, written(plan, "mix"), "inner").select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in added], *added)
