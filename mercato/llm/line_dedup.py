"""Cross-site line removal by distinct-site spread, in DataFrame functions only.

A line's key is the hash of its text without spaces at either end. Each map task
keeps one HyperLogLog sketch of sites per key, and sketches merge by aggregation, so a
line that stands everywhere travels as one small sketch per task. Estimates clearly above
``sites`` are boilerplate, clearly below are kept, and keys near the threshold get an exact
distinct count of their (key, site) pairs. With the two-sided margin ``NEAR`` (five
standard errors of the sketch, and one site at least) it decides as exact counts do.

Removed keys meet the (document, line number, key) rows in a shuffled join; a document's
removed line numbers then come back to its text in order, broadcast if their count allows
it, and the text is the slices between them, so a long text costs its length.

Defined cases: null text is empty; blank lines have no key, are never removed and do not
count; a null site is a site of its own; a line repeated inside one site counts once;
repeated ids or rows each get a row; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import checked, full_text, row_hash, written

SITES = 5
LOG_BUCKETS = 12
NEAR = 5 * 1.04 / (1 << (LOG_BUCKETS // 2))


def _keys(lines: Column) -> Column:
    """Key of each line; null for blank ones."""
    return F.transform(lines, lambda x: F.when(F.trim(x) != "", F.xxhash64(F.trim(x))))


def spread_lines(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """The keys of (key, site) rows that stand on at least ``sites`` distinct sites."""
    name = F.when(F.col("site").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("site")))
    named = lines.select("key", name.alias("site"))
    sketched = written(named.groupBy("key").agg(F.hll_sketch_agg("site", LOG_BUCKETS).alias("sketch"))
                       .select("key", F.hll_sketch_estimate("sketch").alias("about")), "line-spread")
    margin = max(1.0, sites * NEAR)
    near = sketched.filter(F.col("about").between(sites - margin, sites + margin)).select("key")
    exact = (named.join(checked(written(near, "near-lines")), "key").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= sites).select("key"))
    return sketched.filter(F.col("about") > sites + margin).select("key").unionByName(exact)


def clean_lines(docs: DataFrame, site: str = "source", sites: int = SITES) -> DataFrame:
    """One row per document: doc_id, text (kept lines), n_lines, n_removed."""
    split = docs.select("doc_id", F.col(site).alias("site"), row_hash().alias("row_hash"), F.split(full_text(), "\n", -1).alias("lines"))
    keyed = written(split.select("doc_id", "row_hash", "site", F.posexplode(_keys(F.col("lines"))).alias("at", "key")).filter("key is not null"), "lines")
    gone = written(spread_lines(keyed.select("key", "site"), sites), "spread-lines")
    marked = keyed.join(checked(gone), "key", "left_semi").groupBy("doc_id", "row_hash").agg(F.array_sort(F.collect_set("at")).alias("out"))
    marked = written(marked.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "out", F.concat(F.array(F.lit(-1)), "out").alias("cuts")), "removed-lines")
    whole = split.join(checked(marked), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row_hash") == F.col("_hash")), "left")
    until = lambda k: F.coalesce(F.get(F.col("cuts"), k + 1), F.size("lines"))
    between = F.flatten(F.transform("cuts", lambda cut, k: F.slice(F.col("lines"), cut + 2, until(k) - cut - 1)))
    kept = F.when(F.col("out").isNull(), F.col("lines")).otherwise(between)
    return whole.select("doc_id", F.array_join(kept, "\n").alias("text"),
                        F.size(F.filter("lines", lambda x: F.trim(x) != "")).cast("bigint").alias("n_lines"),
                        F.coalesce(F.size("out"), F.lit(0)).cast("bigint").alias("n_removed"))
