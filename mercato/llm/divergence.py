"""Source divergence audit by one-hot level products.

Every (lang, source) group gives each term that its language keeps a share ``p`` that
depends only on the group's count of the term, its *level*. So two groups are compared by
the joint table of their levels: how many terms stand at level a in one and b in the other.

1. Tasks count terms per group, and the documents that hold them, in bounded dictionaries;
   Spark sums them. A language keeps the terms of at least ``min_docs`` of its documents.
2. Kept terms are dealt into chunks of some ``CHUNK`` terms of like frequency, and sources
   into blocks of ``SOURCES``. A chunk meets each pair of source blocks once.
3. In a chunk every (source, level) is an indicator column over the terms, level zero
   included. The left columns' transpose times the right columns is the joint table of
   every pair of groups at once. Terms are halved until their columns are few, so that a
   product stays small; it adds ones only, below 2**24, and is exact.
4. Each cell is priced in integers and summed by pair; Spark adds the chunks.

Defined cases: null text, lang and source are empty strings; a group without terms is
compared as one of level zero throughout; a language without kept terms has pairs of value
zero and no terms; repeated rows count as often as they stand there, ids do not matter;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import checked, written

CHUNK = 1024
SOURCES = 64
MIN_DOCS = 10
TOP = 10

# A product has at most about this many columns a side, unless LEAST_TERMS terms have more.
COLUMNS = 1024
LEAST_TERMS = 32

# Entries a task's dictionaries hold before they are handed on, and bytes of text split at a time.
ENTRIES = 300_000
PIECE = 1 << 22

# Bytes of letters, A-Z lower-cased, and of everything beyond ASCII; all others part terms.
_TERMS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_PAIRS = "lang string, a int, b int, value bigint"


def _terms_of(text: bytes) -> Counter:
    """Occurrences of each term in one text."""
    flat, found, start = text.translate(_TERMS), Counter(), 0
    while start < len(flat):
        end = flat.find(b" ", start + PIECE)
        end = len(flat) if end < 0 else end
        found.update(flat[start:end].split())
        start = end
    return found


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by group and term; a row without a term says that the group occurs."""
    counts: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), held in counts.items():
            terms = [None, *held]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *held.values()], pa.int64()), pa.array([0, *(docs[lang, source][t] for t in held)], pa.int64()),
            ], names=["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    entries = 0
    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(langs, sources, texts, strict=True):
            found, held = _terms_of(text.as_py()), counts[lang, source]
            before = len(held)
            held.update(found)
            docs[lang, source].update(found.keys())
            entries += len(held) - before
            if entries > ENTRIES:
                yield from handed_on()
                entries = 0
    yield from handed_on()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Written table of the kept terms: lang, source, term, n, lang_n (in the language), lead.

    ``lead`` is 1 in one row of each term. A row without a term stands for each group.
    """
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    counted = docs.select(*text).mapInArrow(_count_terms, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    spread = counted.select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("docs"),
                            F.when(F.col("term").isNotNull() & (F.col("source") == F.min("source").over(term)), 1).otherwise(0).alias("lead"))
    return written(spread.filter((F.col("docs") >= min_docs) | F.col("term").isNull()).drop("docs"), "term-counts")


def _share(count: str, total: str, terms: str = "terms"):
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), in decimals so that no count overflows."""
    return F.expr(f"1 + (cast({count} as decimal(28,0)) + 2) * 1000000000 div ({total} + 2 * {terms})").cast("bigint")


def _groups(kept: DataFrame) -> DataFrame:
    """One written row per group: its total and number, and its language's total, terms and groups."""
    lang = Window.partitionBy("lang")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("lead").alias("leads"))
    return written(totals.select("lang", "source", "total", F.sum("total").over(lang).alias("lang_total"), F.sum("leads").over(lang).alias("terms"),
                                 (F.row_number().over(lang.orderBy("source")) - 1).alias("number"), F.count(F.lit(1)).over(lang).alias("groups")), "groups")


def joint_tables(levels: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Joint level tables of every left with every right source, by blocks of terms.

    ``levels[t, s]`` is the level of term t in source s; ``left`` and ``right`` are columns of it.
    Yields (left source, a term at the left level, right source, a term at the right level, number of terms)
    as arrays over the cells that are not zero; a table's cells are the sum over the blocks.
    """
    terms = len(levels)
    if not terms:
        return
    ranks = np.unique(levels, return_inverse=True)[1].reshape(levels.shape).astype(np.int64)
    width = ranks.max() + 1

    def columns(sources):
        keys = ranks[:, sources] + np.arange(len(sources)) * width
        found, first, code = np.unique(keys, return_index=True, return_inverse=True)
        return found // width, first // len(sources), code.reshape(keys.shape)

    sides = [columns(left), columns(right)]
    if max(len(s) for s, _, _ in sides) > COLUMNS and terms > LEAST_TERMS:
        half = terms // 2
        for rows in (slice(0, half), slice(half, terms)):
            for a, ta, b, tb, n in joint_tables(levels[rows], left, right):
                yield a, ta + rows.start, b, tb + rows.start, n
        return
    hot = []
    for source, _, code in sides:
        hot.append(np.zeros((terms, len(source)), np.float32))
        hot[-1][np.arange(terms)[:, None], code] = 1
    product = hot[0].T @ hot[1]
    at, bt = np.nonzero(product)
    yield left[sides[0][0][at]], sides[0][1][at], right[sides[1][0][bt]], sides[1][1][bt], product[at, bt].astype(np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _priced(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The summed price of each pair of groups over the terms of one chunk."""
    lang, _, _, low, high = key
    marks = rows[rows["term"].isna()].sort_values("number")
    numbers = marks["number"].to_numpy()
    held = rows[rows["term"].notna()].sort_values(["lang_n", "term"])
    codes, names = pd.factorize(held["term"])
    at, column = codes, np.searchsorted(numbers, held["number"].to_numpy())
    levels = np.zeros((len(names), len(numbers)), np.int64)
    shares = np.tile(marks["p"].to_numpy(), (len(names), 1))
    levels[at, column], shares[at, column] = held["n"].to_numpy(), held["p"].to_numpy()
    block = numbers // SOURCES
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    sums = np.zeros((len(numbers), len(numbers)), np.int64)
    for a, ta, b, tb, n in joint_tables(levels, left, right):
        np.add.at(sums, (a, b), n * price(shares[ta, a], shares[tb, b]))
    a, b = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    once = numbers[a] < numbers[b]
    a, b = a[once], b[once]
    return pd.DataFrame({"lang": lang, "a": numbers[a], "b": numbers[b], "value": sums[a, b]})


def _pair_sums(rows: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value for every two groups of a language, a before b."""
    scale = F.floor(F.log2("lang_n")).cast("int")
    sizes = written(kept.filter("lead = 1").groupBy("lang", scale.alias("scale")).agg(F.count(F.lit(1)).alias("size"))
                    .withColumn("chunks", F.ceil(F.col("size") / CHUNK).cast("int")), "chunk-sizes")
    dealt = (rows.withColumn("scale", scale).join(checked(sizes.select("lang", "scale", "chunks")), ["lang", "scale"])
             .withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int")))
    # Each chunk also gets its groups at level zero. Chunk -1 holds no terms: it names the pairs of every language.
    chunks = (sizes.select("lang", "scale", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
              .unionByName(groups.select("lang", F.lit(-1).alias("scale"), F.lit(-1).alias("chunk")).distinct()))
    marks = groups.join(chunks, "lang").select("lang", "scale", "chunk", "number", "groups", F.lit(None).cast("string").alias("term"),
                                               F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("lang_n"),
                                               F.when(F.col("terms") > 0, _share("0", "total")).otherwise(0).alias("p"))
    own, other = F.floor(F.col("number") / SOURCES).cast("int"), F.col("other")
    met = (dealt.select(*marks.columns).unionByName(marks)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("groups") - 1) / SOURCES).cast("int"))))
           .select("lang", "scale", "chunk", F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), "number", "term", "n", "lang_n", "p"))
    return met.groupBy("lang", "scale", "chunk", "low", "high").applyInPandas(_priced, _PAIRS).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank.

    ``pair`` prices the group against every other source of its language, ``term`` lists the
    ``top`` terms that the group uses more than its language does.
    """
    kept = kept_counts(docs, min_docs)
    groups = _groups(kept)
    rows = (kept.filter("term is not null").join(checked(groups), ["lang", "source"])
            .withColumn("p", _share("n", "total")).withColumn("q", _share("lang_n", "lang_total")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    more = rows.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    terms = more.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)

    sums = _pair_sums(rows, kept, groups)
    both = sums.withColumn("way", F.explode(F.array(F.struct(F.col("a").alias("own"), F.col("b").alias("other")), F.struct(F.col("b").alias("own"), F.col("a").alias("other")))))
    names = checked(groups.select("lang", "number", "source"))
    named = (both.select("lang", "way.own", "way.other", "value")
             .join(names.withColumnRenamed("number", "own"), ["lang", "own"])
             .join(names.withColumnRenamed("number", "other").withColumnRenamed("source", "item"), ["lang", "other"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    return named.withColumn("rank", F.row_number().over(ranked)).unionByName(terms)
