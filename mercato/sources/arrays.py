"""JSON array files read by many tasks.

An array has no line that ends a record, so the text is cut behind every ``}`` byte, where
a file may be split anywhere, and what each cut means is found by prefix sums:

1. A fragment counts its quotes, and the brackets outside strings for both cases: that it
   begins inside a string, or outside. Escapes never lie across a cut, as ``\\}`` is no escape.
2. Each block of a file (one input split) sums its fragments. One row per block carries the
   quotes' parity and the depth from block to block.
3. With its block's entry state, a fragment knows its own. A cut at depth one, outside a
   string, ends an element; the number of such cuts before is the fragment's piece.
4. Fragments of a piece are put together, first inside the block, then the few that go on
   into the next. A piece is parsed as an array, so elements that are no objects count too.

The text moves twice, in pieces of a block and of an element; no task holds a file. All of it
is DataFrame functions. A file that is not well formed gives a record without text for each
piece that cannot be read, where the whole-file reader gives one for the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import written

_BLOCK = ["file", "block"]


def _depth(text: Column) -> Column:
    """Opened less closed brackets."""
    return F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text up to each ``}`` with its place, quotes, and depth change if begun outside (d0) or inside (d1) a string."""
    text = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')
    text = text.withColumn("_parts", parts)
    turn = lambda odd: F.array_join(F.filter("_parts", lambda _, i: i % 2 == odd), " ")
    text = text.withColumn("quotes", F.size("_parts") - 1).withColumn("_d0", _depth(turn(0))).withColumn("_d1", _depth(turn(1)))
    ends_outside = F.col("quotes") % 2  # of a fragment begun outside: 0; the bracket at its end then counts
    return text.select("value", "file", "file_name", "block", "id", "quotes",
                       (F.col("_d0") - (1 - ends_outside)).alias("d0"), (F.col("_d1") - ends_outside).alias("d1"))


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, file_name, piece, text: the text between two element ends, without the array's brackets and commas."""
    inside = Window.partitionBy(*_BLOCK).orderBy("id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    # Written, as the blocks' sums and the pieces both read them.
    parts = written(_fragments(spark, path), "array-fragments").withColumn("_odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    # as seen from the block's start, begun outside (s0) or inside (s1) a string
    same, other = F.when(F.col("_odd") == 0, F.col("d0")).otherwise(F.col("d1")), F.when(F.col("_odd") == 0, F.col("d1")).otherwise(F.col("d0"))
    parts = parts.withColumn("_s0", same).withColumn("_s1", other)
    blocks = parts.groupBy(*_BLOCK).agg(F.sum("quotes").alias("q"), F.sum("_s0").alias("s0"), F.sum("_s1").alias("s1"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_in", F.coalesce(F.sum("q").over(earlier), F.lit(0)) % 2)
    blocks = blocks.withColumn("_change", F.when(F.col("_in") == 0, F.col("s0")).otherwise(F.col("s1")))
    blocks = blocks.select(*_BLOCK, "_in", F.coalesce(F.sum("_change").over(earlier), F.lit(0)).alias("_base"),
                           F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull().alias("_last_block"))
    known = parts.join(blocks, _BLOCK)
    change = F.when(F.col("_in") == 0, F.col("_s0")).otherwise(F.col("_s1"))
    depth = F.col("_base") + F.sum(change).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    last = F.col("_last_block") & F.lead("id").over(inside).isNull()  # what follows the last cut of a file
    closed = (F.col("_in") + F.col("_odd") + F.col("quotes")) % 2 == 0
    known = known.withColumn("_last", last).withColumn("_end", ((depth == 1) & closed & ~F.col("_last")).cast("int"))
    known = known.withColumn("_piece", F.coalesce(F.sum("_end").over(before), F.lit(0)))
    ends = known.groupBy(*_BLOCK).agg(F.sum("_end").alias("_ends"))
    ends = ends.select(*_BLOCK, F.coalesce(F.sum("_ends").over(earlier), F.lit(0)).alias("_from"))
    text = F.when(F.col("_last"), F.col("value")).otherwise(F.concat("value", F.lit("}")))
    placed = known.withColumn("_text", text)
    joined = lambda column, at: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, column))), lambda x: x[column]), "")
    in_block = placed.groupBy(*_BLOCK, "file_name", "_piece").agg(joined("_text", "id").alias("_text"), F.max("_last").alias("_last"))
    whole = in_block.join(ends, _BLOCK).withColumn("piece", F.col("_piece") + F.col("_from"))
    whole = whole.groupBy("file", "file_name", "piece").agg(joined("_text", "block").alias("text"), F.max("_last").alias("_last"))
    body = F.regexp_replace("text", F.when(F.col("piece") == 0, F.lit(r"^[\s\x{FEFF}]*\[")).otherwise(F.lit(r"^\s*,")), F.lit(""))
    return whole.select("file", "file_name", "piece", F.when(F.col("_last"), F.regexp_replace(body, r"\]\s*$", "")).otherwise(body).alias("text"))


# Pieces numbered together in one step.
_RUN = 4096


def split_array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``raw``, ``file_name`` and ``row_number`` of the elements of one-array JSON files, as ``raw.array_records`` gives them."""
    elements = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), "array<variant>")
    # Parsed once and written, as numbering and the records both read them.
    texts = F.transform(elements, lambda e: F.to_json(e)).alias("elements")
    parsed = written(_pieces(spark, path).select("file", "file_name", "piece", texts), "array-pieces")
    parsed = parsed.withColumn("n", F.coalesce(F.size("elements"), F.lit(1)))
    # Numbers run over a file: counted in runs of pieces, then over the runs. Only counts move.
    counts = parsed.select("file", "piece", "n", F.floor(F.col("piece") / _RUN).alias("run"))
    runs = counts.groupBy("file", "run").agg(F.sum("n").alias("run_n"))
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("file", "run", F.coalesce(F.sum("run_n").over(earlier), F.lit(0)).alias("run_from"))
    inside = Window.partitionBy("file", "run").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, ["file", "run"])
    starts = starts.select("file", "piece", (F.col("own") + F.col("run_from")).alias("start"))
    kept = parsed.filter(F.col("elements").isNull() | (F.size("elements") > 0)).join(starts, ["file", "piece"])
    return kept.select("file_name", "start", F.posexplode_outer("elements").alias("at", "element")).select(
        F.col("element").alias("raw"), "file_name", (F.col("start") + F.coalesce("at", F.lit(0))).cast("int").alias("row_number"))
