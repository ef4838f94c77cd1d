import random

import numpy as np
import pytest
import xxhash
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes
from pyspark.sql import functions as F

from mercato.llm import simhash


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, limit):
    """Component root per code, comparing all pairs."""
    codes = sorted(set(prints))
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= limit:
                root[find(a)] = find(b)
    return {c: find(c) for c in codes}


def test_spark_hashes_shingles_alike(spark):
    text = "Ä b\tc  D"
    h = spark.range(1).select(F.xxhash64(F.lit("Ä b c"))).first()[0] % (1 << 64)
    assert h == xxhash.xxh64_intdigest("Ä b c".encode(), seed=42)
    assert simhash.fingerprint(text) % (1 << 64) == print_by_hand(text)


@pytest.mark.parametrize("cell_codes", [3, 64, 2048])
@pytest.mark.parametrize("rows", [odd_rows(), prose(250)], ids=["odd", "prose"])
def test_groups_equal_brute_force(spark, rows, cell_codes):
    got = simhash.near_groups(with_clashes(frame(spark, rows)), cell_codes=cell_codes).collect()
    prints = [print_by_hand(r[1]) for r in rows]
    root = groups_by_hand(prints, 2)
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[root[p]] = min(least.get(root[p], r[0]), r[0])
    want = sorted(((r[0], p, least.get(root[p])) for r, p in zip(rows, prints, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == want


@pytest.mark.parametrize("limit", [0, 1, 2, 4])
def test_links_join_crowded_codes(spark, limit):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    codes = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & (1 << 64) - 1 for c in centres for _ in range(60)} | {rng.getrandbits(64) for _ in range(200)}
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), limit, cell_codes=16)
    from mercato.llm.components import components

    root = {r.node % (1 << 64): r.root % (1 << 64) for r in components(links).collect()}
    want = groups_by_hand(codes, limit)
    for a in codes:
        for b in codes:
            assert (want[a] == want[b]) == (root.get(a, a) == root.get(b, b))


def test_gray_rank_steps_change_one_bit():
    codes = np.arange(64, dtype=np.uint64)
    order = codes[np.argsort(simhash.gray_rank(codes))]
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(order, order[1:], strict=False))


def test_components_of_long_paths(spark):
    from mercato.llm.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 200: 150}


def test_smallest_id_of_a_group_stays(spark):
    rows = [doc(5, "a b c d"), doc(3, "A b c D"), doc(9, "a  b\nc d"), doc(None, "a b c d"), doc(4, "wholly other words stand here"), doc(6, None), doc(8, "")]
    docs = with_clashes(frame(spark, rows))
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 6]


def test_empty(spark):
    assert simhash.near_groups(spark.createDataFrame([], DOC)).count() == 0
    assert simhash.drop_near_copies(spark.createDataFrame([], DOC)).count() == 0
