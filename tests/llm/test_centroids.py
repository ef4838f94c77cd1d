import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def made(n, seed=1, spread=1.0, dimensions=64):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(dimensions)] for _ in range(9)]
    return [(i, [float(np.float32(m + rng.gauss(0, spread / 4))) for m in rng.choice(middles)], 0) for i in range(n)]


def by_hand(rows, k, rounds, dimensions=64):
    kept = [(i, [math.floor(64 * x) for x in e]) for i, e, _ in rows if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    points = [e for _, e in first]
    near = lambda e: min((sum((a - b) ** 2 for a, b in zip(e, p, strict=True)), c) for c, p in enumerate(points))
    for _ in range(rounds):
        own = [[e for _, e in kept if near(e)[1] == c] for c in range(len(points))]
        points = [[sum(x) // len(o) for x in zip(*o, strict=True)] if o else p for o, p in zip(own, points, strict=True)]
    last = [(i, *reversed(near(e))) for i, e in kept]
    inertia = [sum(d for _, c, d in last if c == k) for k in range(len(points))]
    fits = lambda x: x if x < 1 << 63 else None
    whole = lambda xs: None if any(x >= 1 << 63 for x in xs) else fits(sum(xs))
    return sorted(((i, c, fits(d), whole([d for _, b, d in last if b == c]), whole([d for *_, d in last]),
                    hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest()) for i, c, d in last), key=repr) if inertia else []


ODD = [(500, None, 1), (501, [], 1), (502, [1.0] * 63, 1), (503, [1.0] * 65, 1), (504, [None] + [1.0] * 63, 1), (505, [float("nan")] + [1.0] * 63, 1),
       (506, [float("inf")] + [0.0] * 63, 1), (None, [0.5] * 64, None), (None, [0.25] * 64, None), (7, [-0.001] * 64, 1), (7, [-0.001] * 64, 1), (8, [0.0] * 64, None)]


@pytest.mark.parametrize("rows,k", [(made(300), 16), (made(200) + ODD, 16), (ODD, 16), (made(5), 16), ([(1, [0.5] * 64, 0)] * 40 + made(30), 4), (made(120, spread=1e5), 8)],
                         ids=["plain", "odd", "only odd", "few", "hot vector", "large"])
def test_equals_brute_force(spark, rows, k):
    vectors = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("cluster", "distance", "digest", "component")}).repartition(3)
    got = centroids.clusters(vectors, k)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(rows, k, 3)


def test_components_beyond_every_integer_type(spark):
    rows = [(i, [float(np.float32(x * 10.0**p)) for x in e], 0) for i, (e, p) in enumerate(zip((e for _, e, _ in made(40)), [0, 7, 12, 36] * 10, strict=True))]
    got = centroids.clusters(spark.createDataFrame(rows, SCHEMA).repartition(2), 5)
    want = by_hand(rows, 5, 3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and any(r[2] is None for r in want)


@pytest.mark.parametrize("dimensions", [1, 5, 64])
def test_search_is_exact_with_ties_and_skips_most(dimensions):
    rng = np.random.default_rng(dimensions)
    points = rng.integers(-50, 50, (60, dimensions)).tolist()
    points += points[:20]
    vectors = rng.integers(-60, 60, (500, dimensions))
    search = centroids.Search(points)
    number, best = search.nearest(vectors)
    all_pairs = ((vectors[:, None] - np.array(points)[None]) ** 2).sum(axis=2)
    assert (best == all_pairs.min(axis=1)).all() and (number == all_pairs.argmin(axis=1)).all()
    assert search.tested < all_pairs.size or dimensions == 64  # even noise in many dimensions has like means and deviations
    wide = centroids.Search(points).nearest(vectors.astype(object))
    assert wide[0].tolist() == number.tolist() and wide[1].tolist() == best.tolist()


def test_inequalities_reject_far_centroids():
    rng = np.random.default_rng(0)
    points = [(rng.integers(-9, 9, 64) + 100 * i).tolist() for i in range(50)]
    search = centroids.Search(points)
    search.nearest(np.array(points) + 1)
    assert search.tested <= 3 * 50


def test_empty(spark):
    assert centroids.clusters(spark.createDataFrame([], SCHEMA)).count() == 0
