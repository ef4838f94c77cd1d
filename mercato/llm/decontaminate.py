"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item's window is ``window`` consecutive words (a shorter item is one window), taken as
the set of its shingles of ``SHINGLE_WORDS`` words and their places. A window occurs only
where all of its shingles do, so one of them is prefix enough, and the rarest one is
cheapest: shingles are ordered by how often the whole corpus holds them, and windows with
a shingle that never occurs are dropped. Each place of the prefix shingle proposes one
start, which must lie inside the document (length and position bounds); the words there
are then compared with the window exactly.

One pass over the texts writes the places of item shingles with the words around them, and
one row per document that carries its word count. Item shingles are broadcast if their
count allows it; the words of a text are then looked at only where a shingle is met, so a
long text costs its length. Otherwise hashes alone are shuffled, and the places found meet
their texts afterwards.

Defined cases: null or wordless texts and items have no words; an item without id is named
by the empty string; items that share an id are one item; rows are told apart by
themselves, so repeated ids or rows each get a row; an empty benchmark leaves everything
clean; other columns are ignored, or carried by ``drop_contaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .shared import WORD, ascii_lower, checked, full_text, row_hash, without, written

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
_DOCUMENT = 0  # place 0 is the document's own row; shingle places count from 1


def words(text: str = "text") -> Column:
    return F.regexp_extract_all(ascii_lower(full_text(text)), F.lit(WORD), F.lit(0))


def _shingle_at(array: str, size: int):
    return lambda at: F.xxhash64(*[F.get(F.col(array), at + i) for i in range(size)])


def _starts(count: Column, size) -> Column:
    """0, 1, ... for all runs of ``size`` words in ``count``; empty if there is none."""
    return F.when(count >= size, F.sequence(F.lit(0), (count - size).cast("int"))).otherwise(F.array().cast("array<int>"))


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item, win (its words), size: every window of every item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words().alias("w"))
    sized = items.withColumn("size", F.least(F.size("w"), F.lit(window))).filter("size > 0")
    return sized.select("item", "size", "w", F.explode(_starts(F.size("w"), F.col("size"))).alias("at")).select(
        "item", "size", F.expr("slice(w, at + 1, size)").alias("win"))


def _shingles(windows: DataFrame) -> DataFrame:
    """win, size, part (words in a shingle), at, hash: the shingles of distinct windows."""
    sized = windows.select("win", "size").distinct().withColumn("part", F.least("size", F.lit(SHINGLE_WORDS)))
    placed = sized.withColumn("at", F.explode(_starts(F.col("size"), F.col("part"))))
    # Words beyond a shorter shingle are null, which the hash passes over.
    inside = [F.when(F.col("part") > i, F.get("win", F.col("at") + i)) for i in range(SHINGLE_WORDS)]
    return placed.withColumn("hash", F.xxhash64(*inside))


def _around(hits: DataFrame, window: int, part: int) -> DataFrame:
    """Places with ``around``, the words that a window over them may hold, and ``first``, where those start."""
    first = F.greatest(F.lit(0), F.col("place") - 1 - (window - part))
    hits = hits.withColumn("part", F.lit(part)).withColumn("first", first)
    return hits.select("row", "doc_id", "row_hash", "n_words", "part", "place", "hash", "first",
                       F.when(F.col("place") == _DOCUMENT, F.array().cast("array<string>"))
                       .otherwise(F.slice("w", F.col("first") + 1, F.col("place") - 1 + window - F.col("first"))).alias("around"))


def _places(docs: DataFrame, shingles: DataFrame, window: int, parts: list[int]) -> DataFrame:
    """Where documents hold item shingles: row, doc_id, row_hash, n_words, place, hash, first, around."""
    texts = docs.select("doc_id", row_hash().alias("row_hash"), words().alias("w")).withColumn("n_words", F.size("w"))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    sizes = sorted({*parts, SHINGLE_WORDS}, reverse=True)
    sides = {part: written(shingles.filter(F.col("part") == part).select("hash").distinct(), "item-shingles") for part in sizes}
    moved = not all(shared.small_enough(side) for side in sides.values())
    own = F.lit(_DOCUMENT).cast("bigint")
    if moved:  # row ids must hold in every pass
        texts = written(texts, "words")
    found = None
    for part, side in sides.items():
        # A column of its own, so that the explode and the look-up behind it are compiled as one and no row is copied per place.
        laid = texts.withColumn("hashes", F.concat(F.array(own), F.transform(_starts(F.col("n_words"), part), _shingle_at("w", part))))
        if moved:
            laid = laid.select("row", F.posexplode("hashes").alias("place", "hash")).filter(F.col("place") > _DOCUMENT)
            hits = laid.join(side, "hash").join(texts, "row")
        else:
            if part == SHINGLE_WORDS:  # this pass brings the documents' own rows too
                side = side.unionByName(side.sparkSession.range(1).select(own.alias("hash"))).distinct()
            laid = laid.select("row", "doc_id", "row_hash", "n_words", "w", F.posexplode("hashes").alias("place", "hash"))
            hits = laid.join(F.broadcast(side), "hash")
        hits = _around(hits, window, part)
        found = hits if found is None else found.unionByName(hits.filter(F.col("place") > _DOCUMENT))
    if moved:
        found = found.unionByName(_around(texts.withColumn("place", F.lit(_DOCUMENT)).withColumn("hash", own), window, SHINGLE_WORDS))
    return written(found, "shingle-places")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per document: doc_id, row_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    windows = written(item_windows(benchmark, window), "item-windows")
    shingles = written(_shingles(windows), "window-shingles")
    parts = [r[0] for r in shingles.select("part").distinct().collect()]  # at most SHINGLE_WORDS numbers
    places = _places(docs, shingles, window, parts)
    hits = places.filter(F.col("place") > _DOCUMENT)
    rarity = written(hits.groupBy("part", "hash").agg(F.count(F.lit(1)).alias("often")), "rarity")
    ordered = shingles.join(checked(rarity), ["part", "hash"], "left").groupBy("win", "size", "part").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "at", "hash")).alias("prefix"))
    prefix = ordered.filter("prefix.often > 0").select("win", "size", "part", F.col("prefix.at").alias("at"), F.col("prefix.hash").alias("hash"))
    start = F.col("place") - 1 - F.col("at")
    proposed = hits.join(checked(written(prefix, "prefixes")), ["part", "hash"]).withColumn("start", start)
    inside = proposed.filter((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    same = F.expr("slice(around, start - first + 1, size)") == F.col("win")
    matches = written(inside.filter(same).select("row", "start", "size", "win"), "window-matches")

    end = F.col("start") + F.col("size")
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select("row", "start", end.alias("end")).distinct().withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(before), "start")))
    covered = spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("n_hit"))
    named = matches.select("row", "win").distinct().join(checked(windows.select("win", "item").distinct()), "win").select("row", "item").distinct()
    listed = named.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    own = places.filter(F.col("place") == _DOCUMENT).select("row", "doc_id", "row_hash", F.col("n_words").cast("bigint"))
    result = own.join(covered, "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return result.select("doc_id", "row_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
                         F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    gone = contamination(docs, benchmark, window).filter("contaminated").select("doc_id", "row_hash").distinct()
    return without(docs, written(gone, "contaminated"))
