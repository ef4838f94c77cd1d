"""Picking rows: latest version, rank within a key, version valid at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key: newest first, then smallest ``tie_break``; NULLs lose.

    Written as ``row_number() = 1`` because Spark then limits each map task to one
    row per key *before* the shuffle, so a key with very many copies stays cheap.
    """
    order = [F.col(c).desc_nulls_last() for c in newest] + [F.col(c).asc_nulls_last() for c in tie_break]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_value(value: str, *newest: str) -> Column:
    """Aggregate: ``value`` of the newest row; equal times fall back to the value itself."""
    return F.max(F.struct(*newest, value))[value]


def rank_within(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], name: str) -> DataFrame:
    """``row_number()`` per key without ever sorting one key in one task.

    ``bucket`` must not decrease along ``order`` (for instance the day of the first
    order column). Rows are numbered inside (key, bucket); the number of rows in
    earlier buckets comes from a running total over bucket counts, which is one row
    per key and bucket however large the key is.
    """
    # Structs are never NULL and compare NULL parts as equal, so the join is a plain
    # equality that keeps the window's partitioning.
    bucketed = df.withColumn("_key", F.struct(*keys)).withColumn("_bucket", F.struct(bucket.alias("b")))
    earlier = Window.partitionBy("_key").orderBy(F.col("_bucket.b").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .select("_key", "_bucket", "_before")
    )
    inside = Window.partitionBy("_key", "_bucket").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    numbered = bucketed.withColumn("_inside", F.row_number().over(inside))
    return numbered.join(offsets, ["_key", "_bucket"]).select(*df.columns, (F.col("_inside") + F.col("_before")).alias(name))


def first_of_each(df: DataFrame, key: str, order: Sequence[str], row_id: str, out: str) -> DataFrame:
    """Ids of the first row of every key, as a one-column distinct frame.

    A plain aggregate, so a hot key is reduced on the map side. The caller joins the
    ids back on ``row_id``, which is unique, instead of on the hot key.
    """
    columns = list(dict.fromkeys([*order, row_id]))
    first = df.groupBy(key).agg(F.min(F.struct(*columns)).alias("_first"))
    return first.select(F.col("_first")[row_id].alias(out)).distinct()


def in_force(at: Column, start: Column, end: Column) -> Column:
    """Half-open validity ``[start, end)``; a NULL end is open."""
    return (start <= at) & (end.isNull() | (at < end))


def in_force_closed(at: Column, start: Column, end: Column) -> Column:
    """Closed validity ``[start, end]`` without an open end."""
    return (start <= at) & (at <= end)


def segments(
    versions: DataFrame,
    key: str,
    take: Sequence[str],
    start: str = "valid_from_utc",
    end: str = "valid_to_utc",
    tie: str = "source_row_id",
    unit: Callable[[str], Column] = F.to_date,
) -> DataFrame:
    """Versions as ranges ``[_first, _until)`` of ``unit`` that never overlap within a key.

    Where versions overlap, the latest start wins, then the largest ``tie``, then the
    largest values of ``take``. Versions are reduced to one per key and validity period and
    cut wherever one starts or ends. A key's ranges are numbered; a version covers a run of
    numbers, which is laid on dyadic blocks (at most two per level), and each block keeps
    its best version. A range then asks the one block per level that holds it. So n
    versions of one key cost n log n rows, spread by block, however much they overlap.
    The work is on the size of the dimension, not of the facts that are looked up.

    Versions without a start or with an end not after it are in force nowhere, but still cut.
    """
    spans = versions.filter(F.col(key).isNotNull()).withColumn("_start", unit(start)).withColumn("_end", unit(end))
    best = F.struct(F.col(start).alias("_from"), F.col(tie).alias("_tie"), *take)
    spans = latest_by(spans, [key, "_start", "_end"], newest=[start, tie, *take]).select(F.col(key).alias("_key"), "_start", "_end", best.alias("_best"))

    edges = spans.select("*", F.explode(F.array("_start", "_end")).alias("_first")).filter(F.col("_first").isNotNull())
    of_key = Window.partitionBy("_key")
    in_order = of_key.orderBy("_first")
    # Only distinct borders are numbered: on days, a key has no more than the calendar.
    ranges = edges.select("_key", "_first").distinct().select(
        "_key", "_first", F.lead("_first").over(in_order).alias("_until"),
        (F.row_number().over(in_order) - 1).alias("_no"), F.count(F.lit(1)).over(of_key).cast("int").alias("_count"))

    runs = edges.join(ranges.drop("_until"), ["_key", "_first"]).groupBy("_key", "_start", "_end").agg(
        F.max("_best").alias("_best"),
        F.max(F.when(F.col("_first") == F.col("_start"), F.col("_no"))).alias("_lo"),
        F.coalesce(F.max(F.when(F.col("_first") == F.col("_end"), F.col("_no"))), F.max("_count")).alias("_hi"),
    ).filter("_lo < _hi")
    blocks = runs.select("_key", "_best", F.inline(_dyadic_blocks())).groupBy("_key", "_level", "_block").agg(F.max("_best").alias("_best"))
    asked = ranges.select("_key", "_first", "_until", F.explode(F.expr(f"sequence(0, {_top_level('_count')})")).alias("_level"), "_no").withColumn("_block", F.expr("shiftright(_no, _level)"))
    found = asked.join(blocks, ["_key", "_level", "_block"]).groupBy("_key", "_first").agg(F.first("_until").alias("_until"), F.max("_best").alias("_best"))
    return found.select("_key", "_first", "_until", *[F.col("_best")[c].alias(c) for c in take])


def _top_level(size: str) -> str:
    """SQL for the largest level whose blocks are no longer than ``size`` numbers."""
    return f"length(bin({size})) - 1"


def _dyadic_blocks() -> Column:
    """(_level, _block) of the fewest dyadic blocks that make up the numbers from _lo up to, not including, _hi.

    At a level, what the finer levels left over runs from ceil(_lo / 2^level) to floor(_hi / 2^level);
    an odd border there belongs to no coarser block and is taken.
    """
    return F.expr(f"""
        filter(flatten(transform(sequence(0, {_top_level('_hi - _lo')}), l -> transform(
            array(-shiftright(-_lo, l), shiftright(_hi, l) - 1),
            (b, side) -> named_struct('_level', l, '_block', if(
                -shiftright(-_lo, l) < shiftright(_hi, l) and b % 2 = if(side = 0, 1, 0), b, null))))),
            x -> x._block is not null)""")


def _lookup(facts: DataFrame, ranges: DataFrame, key: str, at: str, take: Sequence[str]) -> DataFrame:
    fits = (F.col(key) == F.col("_key")) & in_force(F.col(at), F.col("_first"), F.col("_until"))
    return facts.join(ranges, fits, "left").select(*facts.columns, *take)


def version_on_day(days: DataFrame, versions: DataFrame, key: str, day: str, take: Sequence[str], **columns: str) -> DataFrame:
    """Left join each row to the one version of its key in force on its day.

    The segments do not overlap, so the join gives one row per row: the wide side is
    neither sorted nor grouped again, and stays where it is if the segments are small
    enough for the planner to broadcast.
    """
    return _lookup(days, segments(versions, key, take, **columns), key, day, take)


# A key's days are dealt over so many tasks, by year in turn.
_TURNS = 4


def turn_of(day: str | Column) -> Column:
    """The turn a day's year takes; NULL for NULL."""
    return F.pmod(F.year(day), F.lit(_TURNS))


def in_turns(ranges: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """A copy of each range of days ``[start, end)`` for each turn its days have, at most one a turn; empty ranges go."""
    first, last = F.year(start), F.year(F.date_sub(end, 1))
    years = F.sequence(first, F.least(last, first + F.lit(_TURNS - 1)))  # least leaves out the NULL of an open end
    standing = ranges.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    return standing.withColumn(name, F.explode(years)).withColumn(name, F.pmod(name, F.lit(_TURNS)))


def version_on_dealt_day(
    days: DataFrame, versions: DataFrame, key: str, day: str, turn: str, take: Sequence[str], **columns: str
) -> DataFrame:
    """As ``version_on_day``, for rows that are in partitions by key and turn: only versions move, a copy to each turn."""
    ranges = in_turns(segments(versions, key, take, **columns), "_first", "_until", "_turn_of_range")
    fits = (F.col(key) == F.col("_key")) & (F.col(turn) == F.col("_turn_of_range")) & in_force(F.col(day), F.col("_first"), F.col("_until"))
    # Hashed, so that the days are not sorted for it.
    return days.join(ranges.hint("shuffle_hash"), fits, "left").select(*days.columns, *take)


def version_at(facts: DataFrame, versions: DataFrame, key: str, at: str, take: Sequence[str], **columns: str) -> DataFrame:
    """Left join each fact to the one version of its key in force at its instant.

    As ``version_on_day``, with ranges of instants. Nothing groups the facts after the
    join, so adaptive execution may split a hot key's facts over many tasks.
    """
    return _lookup(facts, segments(versions, key, take, unit=F.col, **columns), key, at, take)
