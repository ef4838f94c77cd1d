"""SimHash near-duplicates found through a Gray-ordered hierarchical index.

Fingerprints: 64 bits, a bit is set if more than half of the shingle hashes set it.

Index: distinct fingerprints are sorted by Gray rank, which keeps codes with many equal
bits side by side, and cut into cells of about ``cell_codes``. A node stands for a run of
neighbouring codes and keeps the bits that all of them share, less those that its parent
has already. A search adds up the differing shared bits from the root downwards and drops
a whole node once they exceed the limit. Nodes above the cells are few (bounded by
``MAX_CELLS``) and go to every task, which sends each code to the cells it may match;
inside a cell the same tree continues down to single codes.

Links between cells go one way (to the cell of higher number), and a cell emits a spanning
forest of its links, never all pairs. The forests' components are the groups.

Defined cases: a null text is empty; a text without words has fingerprint zero and links
like any other; shorter texts are one shingle; rows with equal fingerprints share a group;
a null id never becomes a component id unless the whole group has none; an empty table
gives an empty result; other columns are ignored, or carried by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import full_text, row_hash, without, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CELL_CODES = 2048
MAX_CELLS = 1 << 16
FAN_OUT = 16
FRONTIER = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of one text."""
    words = text.encode().lower().split()  # bytes: lower-cases A-Z only and splits at ASCII white space only
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < shingle_words else map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[start:start + 65536].view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, row_hash, fp per row, written once."""
    @F.pandas_udf("bigint")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle_words) for t in texts], dtype="int64")

    return written(docs.select("doc_id", row_hash().alias("row_hash"), of_texts(full_text()).alias("fp")), "fingerprints")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the reflected Gray sequence."""
    rank = codes.view(np.uint64).copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank.view(np.int64)


class GrayTree:
    """Levels of nodes over leaves given by the bits all their codes set (low) or any sets (high)."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.size = len(low)
        lows, highs = [low], [high]
        while len(lows[-1]) > FAN_OUT:
            starts = np.arange(0, len(lows[-1]), FAN_OUT)
            lows.append(np.bitwise_and.reduceat(lows[-1], starts))
            highs.append(np.bitwise_or.reduceat(highs[-1], starts))
        shared = [~(lo ^ hi) for lo, hi in zip(lows, highs, strict=True)]
        own = [s & ~np.repeat(up, FAN_OUT)[: len(s)] for s, up in zip(shared, shared[1:], strict=False)] + shared[-1:]
        self.levels = list(zip(lows, own, strict=True))[::-1]

    def search(self, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, leaf index) whose accumulated differences stay within the limit, in blocks."""
        low, own = self.levels[0]
        step = max(1, FRONTIER // max(1, len(low)))
        for start in range(0, len(queries), step):
            part = np.arange(start, min(start + step, len(queries)))
            q = np.repeat(part, len(low))
            node = np.tile(np.arange(len(low)), len(part))
            yield from self._down(queries, q, node, np.zeros(len(q), np.uint8), 0, limit)

    def _down(self, queries, q, node, far, level, limit):
        low, own = self.levels[level]
        far = far + np.bitwise_count((queries[q] ^ low[node]) & own[node])
        near = far <= limit
        q, node, far = q[near], node[near], far[near]
        if level == len(self.levels) - 1:
            if len(q):
                yield q, node
            return
        width = len(self.levels[level + 1][0])
        for start in range(0, len(q), FRONTIER // FAN_OUT):
            part = slice(start, start + FRONTIER // FAN_OUT)
            child = (node[part, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
            there = child < width
            yield from self._down(queries, np.repeat(q[part], FAN_OUT)[there], child[there], np.repeat(far[part], FAN_OUT)[there], level + 1, limit)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked positions their smallest common label, in place."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        lowest = np.minimum(x, y)
        np.minimum.at(labels, x, lowest)
        np.minimum.at(labels, y, lowest)
        while not np.array_equal(up := labels[labels], labels):
            labels[:] = up


def _cell_links(limit: int):
    def of_cell(cell: pd.DataFrame) -> pd.DataFrame:
        home = cell["home"].to_numpy()
        own = cell.loc[home, "fp"].to_numpy().view(np.uint64)
        own = own[np.argsort(gray_rank(own), kind="stable")]
        codes = np.concatenate([own, cell.loc[~home, "fp"].to_numpy().view(np.uint64)])
        labels = np.arange(len(codes))
        if len(own):
            for q, leaf in GrayTree(own, own).search(codes, limit):
                _merge(labels, q, leaf)
        linked = labels != np.arange(len(codes))
        return pd.DataFrame({"a": codes[linked].view(np.int64), "b": codes[labels[linked]].view(np.int64)})

    return of_cell


def near_links(codes: DataFrame, limit: int = MAX_BITS, cell_codes: int = CELL_CODES) -> DataFrame:
    """Links (a, b) whose components are those of all distinct codes ``fp`` within ``limit`` bits."""
    total = codes.count()
    cells = max(1, min(MAX_CELLS, -(-total // cell_codes)))

    @F.pandas_udf("bigint")
    def rank(fp: pd.Series) -> pd.Series:
        return pd.Series(gray_rank(fp.to_numpy()))

    ranked = written(codes.select("fp", rank("fp").alias("rank")), "gray-ranks")
    # Cell borders are quantiles of the rank, so crowded regions get more and narrower cells.
    borders = ranked.agg(F.percentile_approx("rank", [i / cells for i in range(1, cells)], 20 * cells)).first()[0] if cells > 1 and total else []
    edges = np.unique(np.array(borders, dtype=np.int64))

    @F.pandas_udf("int")
    def cell_of(ranks: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ranks.to_numpy(), side="left").astype("int32"))

    # Written, so that no task runs two Python functions, each with a process of its own.
    placed = written(ranked.select("fp", cell_of("rank").alias("cell")), "placed-codes")
    nodes = placed.groupBy("cell").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")).orderBy("cell").collect()  # at most MAX_CELLS
    number = np.array([n["cell"] for n in nodes], dtype=np.int64)
    low, high = (np.array([n[k] for n in nodes], dtype=np.int64).view(np.uint64) for k in ("low", "high"))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = GrayTree(low, high)
        for batch in batches:
            fp, own = batch["fp"].to_numpy(), batch["cell"].to_numpy()
            yield pd.DataFrame({"cell": own, "fp": fp, "home": True})
            for q, leaf in tree.search(fp.view(np.uint64), limit):
                onward = number[leaf] > own[q]
                yield pd.DataFrame({"cell": number[leaf[onward]], "fp": fp[q[onward]], "home": False})

    routed = placed.mapInPandas(route, "cell int, fp bigint, home boolean")
    return routed.groupBy("cell").applyInPandas(_cell_links(limit), "a bigint, b bigint")


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, limit: int = MAX_BITS, cell_codes: int = CELL_CODES) -> DataFrame:
    """One row per document: doc_id, row_hash, fp, component_id (smallest id of the group)."""
    prints = fingerprints(docs, shingle_words)
    codes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "codes")
    roots = written(components(near_links(codes, limit, cell_codes)), "roots")
    member = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(lowest, "root").select("fp", "component_id")
    return prints.join(named, "fp")


def drop_near_copies(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, limit: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest doc_id."""
    groups = near_groups(docs, shingle_words, limit)
    gone = groups.filter(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    return without(docs, written(gone.select("doc_id", "row_hash").distinct(), "near-copies"))
