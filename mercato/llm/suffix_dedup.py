"""Removal of long repeated byte strings through a run-length compressed suffix index.

Exact rule: a byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else, in the same document or another; strings never cross documents.

Every string (window) of that length belongs to its minimizer: the place of its smallest
gram hash, leftmost on ties. Equal windows have equal minimizers, so whatever repeats
meets under one anchor. Neighbouring windows of one minimizer form a context, the bytes
that cover them all.

1. One pass writes each context's place, anchor and hash. Anchors that stand once cannot
   repeat and are dropped after a count (combined in the tasks).
2. Contexts that stand twice whole are repeated whole; copies of any number are settled by
   counts, never gathered.
3. Contexts left single beside others of their anchor go to the index, one copy each. An
   anchor with more than ``HOT`` of them is dealt out further: its windows are cut in
   slices by their distance to the anchor, and each piece is dealt by the core of bytes
   that all windows of its slice share. Where more than ``HOT`` pieces share a core, as at
   the ends of a passage in many documents, they are never gathered: equal pieces are
   settled by counts, one of each is cut in single windows, and these are counted.
4. Per bucket of about ``BUCKET_BYTES`` the contexts form one text. Its suffixes are sorted,
   the Burrows-Wheeler transform is run-compressed, and suffix positions are sampled at
   the ends of its runs with the length they share with the neighbour. Inside a run those
   lengths fall by one per byte, so streaming over the text from one sample to the next
   gives each position's matching statistic: the longest string there that also starts
   elsewhere. Positions with ``LENGTH`` and more mark their bytes.

Defined cases: a null text is empty; shorter texts keep all bytes; repeated rows (also of
one id) repeat one another; a null id is an id like others; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import checked, full_text, row_hash, written

LENGTH = 200
GRAM = 64
BUCKET_BYTES = 1 << 19
HOT = 2048
SLICES = 8
CHUNK_BYTES = 1 << 19
_LOW = np.uint64(0xFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) at each place, by doubling."""
    h, base, done = raw.astype(np.uint64) + np.uint64(1), np.array([_ODD]), 1
    while done < gram:
        h = h[:-done] * base + h[done:]
        base = base * base
        done *= 2
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def contexts_of(texts: list, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor's distance from it, anchor hash, context hash) per context of some byte strings."""
    joined = b"".join(texts)
    raw, sizes = np.frombuffer(joined, dtype=np.uint8), np.array([len(t) for t in texts], dtype=np.int64)
    none = np.empty(0, dtype=np.int64)
    if len(raw) < length:
        return none, none, none, none, none, none
    hashes = _gram_hashes(raw, gram)
    least = (hashes << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)  # hash before place: leftmost of equal ones
    wide, done = length - gram + 1, 1
    while 2 * done <= wide:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < wide:
        least = np.minimum(least[: len(least) - (wide - done)], least[wide - done:])
    text = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    begins, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes)
    window = np.flatnonzero(np.arange(len(least)) + length <= ends[text])
    if not len(window):
        return none, none, none, none, none, none
    place, owner = (least[window] & _LOW).astype(np.int64), text[window]
    first = np.concatenate([[0], np.flatnonzero((np.diff(place) != 0) | (np.diff(owner) != 0)) + 1])
    many = np.diff(np.append(first, len(window)))
    start = window[first]
    whole = [xxhash.xxh3_64_intdigest(joined[s:s + n + length - 1]) for s, n in zip(start.tolist(), many.tolist(), strict=True)]
    anchor = place[first]
    return owner[first], start - begins[owner[first]], many, anchor - start, hashes[anchor].view(np.int64), np.array(whole, dtype=np.uint64).view(np.int64)


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES`` each."""
    start, upto = 0, np.cumsum(sizes)
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CHUNK_BYTES, side="right")))
        yield start, end
        start = end


def _find_contexts(length: int, gram: int):
    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = (batch.column(k) for k in ("id", "row_hash", "text"))
            for start, end in _groups(pc.binary_length(texts).to_numpy()):
                # Arrow's buffers are the UTF-8 bytes themselves; no Python text is made.
                owner, first, many, lead, anchor, context = contexts_of([t.as_buffer() for t in texts[start:end]], length, gram)
                at = pa.array(owner + start)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), keys.take(at), *[pa.array(x, pa.int32()) for x in (first, many, lead)], pa.array(anchor), pa.array(context)],
                    names=["id", "row_hash", "first", "many", "lead", "anchor", "context"])

    return of_partition


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of some strings, with samples at the run ends.

    Symbols are bytes plus one; beyond a string's end everything is 0, so no match leaves it.
    """

    def __init__(self, strings: list[bytes]) -> None:
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        ends = np.cumsum(sizes + 1) - 1
        n = int(ends[-1]) + 1 if len(strings) else 0
        self.symbols = np.zeros(n, dtype=np.uint8)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        self.symbols[inside] = np.frombuffer(b"".join(strings), dtype=np.uint8) + np.uint8(1)
        self.left = np.repeat(ends, sizes + 1) - np.arange(n)  # symbols up to the string's end
        self.order = self._sorted(int(sizes.max(initial=0)))
        before = self.symbols[self.order - 1]  # position -1 is the last end, symbol 0, as before any first string
        # A suffix that begins a string extends to nothing on its left, so it is a run of its own.
        self.heads = np.concatenate([[0], np.flatnonzero((np.diff(before) != 0) | (before[1:] == 0)) + 1]) if n else np.empty(0, np.int64)
        self.run_symbols = before[self.heads]

    def _sorted(self, longest: int) -> np.ndarray:
        """Suffix order by prefix doubling from packed words of 8; equal suffixes by position."""
        n = len(self.symbols)
        padded = np.concatenate([self.symbols, np.zeros(8, np.uint8)])
        word = np.zeros(n, dtype=np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | np.where(self.left > i, padded[i:i + n], 0).astype(np.uint64)
        order = np.argsort(word, kind="stable")
        fresh = np.concatenate([[True], np.diff(word[order]) != 0]) if n else np.empty(0, bool)
        depth = 8
        while True:
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(fresh)
            # Only suffixes that still tie with a neighbour are sorted on; ties keep their slots.
            tied = ~fresh | np.concatenate([~fresh[1:], [False]]) if n else fresh
            slots = np.flatnonzero(tied)
            if depth > longest or not len(slots):
                return order
            there = order[slots]
            beyond = np.where(self.left[there] > depth, rank[np.minimum(there + depth, n - 1)], 0)
            key = rank[there] * (n + 1) + beyond
            sub = np.argsort(key, kind="stable")
            order[slots] = there[sub]
            fresh[slots] = np.concatenate([[True], np.diff(key[sub]) != 0])
            depth *= 2

    def _shared(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Symbols that the suffixes at a and b share, counted up to ``most``."""
        room = np.minimum(np.minimum(self.left[a], self.left[b]), most)
        same, live = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
        while len(live):
            step = np.minimum(room[live] - same[live], 16)
            span = np.arange(16)[None, :]
            x, y = ((p[live] + same[live])[:, None] + span for p in (a, b))
            top = len(self.symbols) - 1
            equal = (self.symbols[np.minimum(x, top)] == self.symbols[np.minimum(y, top)]) & (span < step[:, None])
            run = np.where(equal.all(axis=1), 16, equal.argmin(axis=1))
            same[live] += run
            live = live[(run == 16) & (same[live] < room[live])]
        return same

    def statistics(self, most: int) -> np.ndarray:
        """Per text position the longest string there that also starts elsewhere, up to ``most``.

        Samples: positions at the heads of runs (against the suffix before) and at their
        tails (against the suffix after). From one sampled position to the next the shared
        length falls by one per position, so one forward pass restores all of them.
        """
        n, best = len(self.symbols), np.zeros(len(self.symbols), dtype=np.int64)
        if n < 2:
            return best
        tails = np.append(self.heads[1:], n) - 1
        for ranks, step in ((self.heads, -1), (tails, 1)):
            ranks = ranks[(ranks + step >= 0) & (ranks + step < n)]
            sampled = self.order[ranks]
            # Counted further than ``most``, since a sample serves the positions after it too.
            shared = self._shared(sampled, self.order[ranks + step], n)
            reach = np.zeros(n, dtype=np.int64)
            reach[sampled] = sampled + shared
            last = np.zeros(n, dtype=np.int64)
            last[sampled] = sampled
            np.maximum.accumulate(last, out=last)
            best = np.maximum(best, reach[last] - np.arange(n))
        return np.minimum(best, most)


def _index_bucket(length: int):
    def of_bucket(bucket: pd.DataFrame) -> pd.DataFrame:
        strings = [bytes(s) for s in bucket["bytes"]]
        matched = RunIndex(strings).statistics(length) >= length
        single = bucket["single"].to_numpy()
        found = []
        start = 0
        for i, s in enumerate(strings):
            if single[i]:
                hits = np.flatnonzero(matched[start:start + len(s)])
                if len(hits):
                    cut = np.flatnonzero(np.diff(hits) > 1)
                    found.append((i, hits[np.append(0, cut + 1)], hits[np.append(cut, len(hits) - 1)]))
            start += len(s) + 1
        at = np.array([i for i, low, _ in found for _ in low], dtype=np.int64)
        low = np.concatenate([x for _, x, _ in found] or [np.empty(0, np.int64)])
        high = np.concatenate([x for _, _, x in found] or [np.empty(0, np.int64)])
        first = bucket["first"].to_numpy()[at]
        return pd.DataFrame({"id": bucket["id"].to_numpy()[at], "row_hash": bucket["row_hash"].to_numpy()[at], "low": first + low, "high": first + high + length})

    return of_bucket


def _texts(docs: DataFrame) -> DataFrame:
    """Rows equal in id and text have equal spans, so those two are key enough; no id counts as -1 there."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id"), F.lit(-1)).cast("bigint").alias("id"), row_hash().alias("row_hash"), full_text().alias("text"))


def _named(texts: DataFrame, rows: DataFrame, how: str = "left_semi") -> DataFrame:
    """The texts that ``rows`` name, or the others (``left_anti``).

    Only one narrow key per text is broadcast, and only if their count allows it; so a
    join that follows moves the texts it needs and no others.
    """
    return texts.join(checked(written(rows.select("id", "row_hash").distinct(), "named-texts")), ["id", "row_hash"], how)


def _counted(crowded: DataFrame, length: int) -> DataFrame:
    """Spans of pieces whose core too many share: by counts of whole pieces, then of single windows."""
    place = ["id", "row_hash", "first", "single"]
    held = written(crowded.withColumn("many", F.octet_length("bytes") - (length - 1)).withColumn("piece", F.xxhash64("bytes")), "crowded-pieces")
    kinds = written(held.groupBy("deal", "piece", "many").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*place, "bytes")).alias("at")), "piece-kinds")
    copies = held.join(kinds.filter("n > 1").select("deal", "piece", "many"), ["deal", "piece", "many"], "left_semi")
    whole = copies.select("id", "row_hash", F.col("first").cast("bigint").alias("low"), (F.col("first") + F.col("many") + (length - 1)).cast("bigint").alias("high"))
    one = kinds.select("deal", "many", "n", "at.*").withColumn("step", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    windows = written(one.select("deal", F.xxhash64(F.expr(f"substring(bytes, step + 1, {length})")).alias("window"), "id", "row_hash",
                                 (F.col("first") + F.col("step")).cast("bigint").alias("low"), (F.col("single") & (F.col("n") == 1)).alias("open")), "single-windows")
    several = windows.groupBy("deal", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("deal", "window")
    met = windows.filter("open").join(several, ["deal", "window"], "left_semi")
    return whole.unionByName(met.select("id", "row_hash", "low", (F.col("low") + length).alias("high")))


def _pieces(asked: DataFrame, length: int, width: int) -> DataFrame:
    """Contexts to index, with what they are dealt by; those of hot anchors cut in aligned slices."""
    plain = asked.filter("not hot").select("id", "row_hash", "first", "many", "single", F.col("anchor").alias("deal"), "hot", "raw")
    nearest = F.col("lead") - F.col("many") + 1  # distances of the context's windows: nearest to lead
    cut = asked.filter("hot").withColumn("slice", F.explode(F.sequence(F.floor(nearest / width).cast("int"), F.floor(F.col("lead") / width).cast("int"))))
    far, near = F.least(F.col("lead"), (F.col("slice") + 1) * width - 1), F.greatest(nearest, F.col("slice") * width)
    core = F.expr(f"substring(raw, first + lead - slice * {width} + 1, {length - width + 1})")
    cut = cut.select("id", "row_hash", (F.col("first") + F.col("lead") - far).alias("first"), (far - near + 1).alias("many"), "single",
                     F.xxhash64("anchor", "slice", core).alias("deal"), "hot", "raw")
    return plain.unionByName(cut).select("id", "row_hash", "first", "single", "deal", "hot", F.expr(f"substring(raw, first + 1, many + {length - 1})").alias("bytes"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """id, row_hash, low, high: byte spans (they may overlap) that repeat."""
    texts = _texts(docs).drop("doc_id")
    places = written(texts.filter(F.octet_length("text") >= length).mapInArrow(
        _find_contexts(length, gram), "id bigint, row_hash bigint, first int, many int, lead int, anchor bigint, context bigint"), "contexts")
    twice = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("least"), F.max("context").alias("most")).filter("n > 1")
    twice = written(twice.select("anchor", (F.col("least") != F.col("most")).alias("mixed")), "shared-anchors")
    shared = written(places.join(twice, "anchor"), "shared-contexts")
    kinds = written(shared.filter("mixed").groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row_hash", "first", "many", "lead")).alias("at")), "context-kinds")

    whole_kinds = written(kinds.filter("n > 1").select("anchor", "context"), "whole-kinds")
    whole = shared.filter("not mixed").unionByName(shared.filter("mixed").join(whole_kinds, ["anchor", "context"], "left_semi").select(*shared.columns))
    whole = whole.select("id", "row_hash", F.col("first").cast("bigint").alias("low"), (F.col("first") + F.col("many") + (length - 1)).cast("bigint").alias("high"))

    open_anchors = kinds.groupBy("anchor").agg(F.min("n").alias("fewest"), F.count(F.lit(1)).alias("kinds")).filter("fewest = 1")
    open_anchors = written(open_anchors.select("anchor", (F.col("kinds") > hot).alias("hot")), "open-anchors")
    asked = written(kinds.join(open_anchors, "anchor").select("anchor", "hot", (F.col("n") == 1).alias("single"), "at.*"), "asked-contexts")
    met = _named(texts, asked).join(asked, ["id", "row_hash"]).withColumn("raw", F.col("text").cast("binary"))
    pieces = written(_pieces(met, length, -(-(length - gram + 1) // SLICES)), "pieces")
    cores = pieces.groupBy("deal").agg(F.count(F.lit(1)).alias("n"), F.bool_and("hot").alias("hot")).filter(F.col("hot") & (F.col("n") > hot))
    cores = checked(written(cores.select("deal"), "crowded-cores"))
    crowded, pieces = pieces.join(cores, "deal", "left_semi"), written(pieces.join(cores, "deal", "left_anti"), "bucket-pieces")
    size = pieces.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    dealt = pieces.withColumn("bucket", F.pmod("deal", F.lit(max(1, -(-size // bucket_bytes)))))
    partial = dealt.groupBy("bucket").applyInPandas(_index_bucket(length), "id bigint, row_hash bigint, low bigint, high bigint")
    return whole.unionByName(partial).unionByName(_counted(crowded, length))


def _runs(spans: DataFrame) -> DataFrame:
    """Overlapping and touching spans of a text as maximal runs; one exchange serves all steps."""
    text = ["id", "row_hash"]
    before = Window.partitionBy(*text).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*text).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("low") > F.max("high").over(before), F.lit(True)).cast("int")
    marked = spans.distinct().withColumn("opens", opens).withColumn("run", F.sum("opens").over(upto))
    return marked.groupBy(*text, "run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("run")


def _clean(text: str, low, high) -> tuple[int, int, str]:
    """Removed bytes, runs and the digest of what is left, for runs that do not meet."""
    raw, kept, at = text.encode(), hashlib.sha256(), 0
    for b, e in sorted(zip(low, high, strict=True)):
        kept.update(raw[at:b])
        at = e
    kept.update(raw[at:])
    return int(sum(high) - sum(low)), len(low), kept.hexdigest()


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, length, gram, bucket_bytes, hot)
    runs = written(_runs(spans), "runs")
    per_text = runs.groupBy("id", "row_hash").agg(F.collect_list(F.struct("low", "high")).alias("runs"))

    @F.pandas_udf("n_removed bigint, n_spans bigint, kept_sha256 string")
    def clean(text: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_clean(*x) for x in zip(text, low, high, strict=True)], columns=["n_removed", "n_spans", "kept_sha256"])

    texts, n_bytes = _texts(docs), F.octet_length("text").cast("bigint").alias("n_bytes")
    cut = _named(texts, runs).join(per_text, ["id", "row_hash"])
    cut = cut.select("doc_id", n_bytes, clean("text", "runs.low", "runs.high").alias("r")).select("doc_id", "n_bytes", "r.*")
    whole = _named(texts, runs, "left_anti").select(
        "doc_id", n_bytes, F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
    return cut.unionByName(whole)
