"""Reusable operators against brute force."""

import random
import time
import statistics

import numpy as np
from pyspark.sql import functions as F

from mercato.operators import checks as c
from mercato.operators.versions import latest_by, rank_within, segments, version_at, version_on_day
from makers import only


def test_rank_matches_plain_sort_with_one_heavy_key(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(5)}", f"2026-07-{rnd.randrange(1, 9):02d}", f"id{i:04d}") for i in range(600)]
    rows.append((None, "2026-07-01", "n1"))
    df = spark.createDataFrame(rows, "k string, at string, id string").withColumn("at", F.to_timestamp_ntz("at"))
    got = {r["id"]: r["rank"] for r in rank_within(df, ["k"], F.to_date("at"), ["at", "id"], "rank").collect()}
    seen, want = {}, {}
    for k, at, i in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        seen[k] = want[i] = seen.get(k, 0) + 1
    assert got == want


def test_latest_by_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    found = latest_by(df, ["k"], ["v"])
    assert {tuple(r) for r in found.collect()} == {(0, 99), (1, 97), (2, 98)}
    plan = found._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_version_at_matches_brute_force(spark):
    rnd = random.Random(5)

    def stamp():
        return f"2026-07-{rnd.randrange(1, 20):02d} {rnd.randrange(24):02d}:00:00"

    versions = []
    for i in range(60):
        a, b = sorted([stamp(), stamp()])
        versions.append((f"c{rnd.randrange(4)}", a, None if rnd.random() < 0.2 else b, f"v{i:02d}", f"s{i}"))
    facts = [(f"f{i}", f"c{rnd.randrange(5)}", stamp()) for i in range(200)]
    fv = spark.createDataFrame(versions, "c string, valid_from_utc string, valid_to_utc string, source_row_id string, segment string")
    fv = fv.withColumns({x: F.to_timestamp_ntz(x) for x in ("valid_from_utc", "valid_to_utc")})
    ff = spark.createDataFrame(facts, "id string, c string, at string").withColumn("at", F.to_timestamp_ntz("at"))
    got = {r["id"]: r["segment"] for r in version_at(ff, fv, "c", "at", ["segment"]).collect()}
    want = {}
    for fid, key, at in facts:
        fits = [v for v in versions if v[0] == key and v[1] <= at and (v[2] is None or at < v[2])]
        want[fid] = max(fits, key=lambda v: (v[1], v[3]))[4] if fits else None
    assert got == want


def test_daily_segments_match_brute_force(spark):
    rnd = random.Random(11)
    versions = []
    for i in range(50):
        a, b = sorted(rnd.sample(range(1, 28), 2))
        versions.append((f"p{rnd.randrange(4)}", f"2026-07-{a:02d}", None if rnd.random() < 0.2 else f"2026-07-{b:02d}", f"v{i:02d}", f"s{i}"))
    days = [(f"p{p}", f"2026-07-{d:02d}") for p in range(5) for d in range(1, 29)]
    fv = spark.createDataFrame(versions, "p string, valid_from_utc string, valid_to_utc string, source_row_id string, segment string")
    fv = fv.withColumns({x: F.to_date(x) for x in ("valid_from_utc", "valid_to_utc")})
    fd = spark.createDataFrame(days, "p string, day string").withColumn("day", F.to_date("day"))
    rows = version_on_day(fd, fv, "p", "day", ["segment"]).collect()
    assert len(rows) == len(days)
    for r in rows:
        fits = [v for v in versions if v[0] == r["p"] and v[1] <= str(r["day"]) and (v[2] is None or str(r["day"]) < v[2])]
        assert r["segment"] == (max(fits, key=lambda v: (v[1], v[3]))[4] if fits else None)


def test_many_overlapping_versions_of_one_product_take_seconds(spark):
    n = 100_000
    versions = spark.range(n).selectExpr(
        "'p' AS p", "id AS valid_from_utc", f"CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN id + 1 ELSE {2 * n} - id END AS valid_to_utc", "id AS source_row_id", "id AS v")
    begun = time.monotonic()
    got = segments(versions, "p", ["v"], unit=F.col).collect()
    assert time.monotonic() - begun < 60
    winners = {r["_first"]: (r["_until"], r["v"]) for r in got}
    # Up to n each start wins at once; beyond n the latest version still in force.
    assert all(winners[i][1] == i for i in range(n))
    open_end = max(i for i in range(n) if i % 7 == 0)
    ends = sorted(first for first in winners if first >= n)
    want = [max([open_end] + [i for i in (2 * n - first - 1 - k for k in range(12)) if 0 <= i < n and i % 5 and i % 7]) for first in ends]
    assert [winners[first][1] for first in ends] == want and winners[ends[-1]][0] is None


def test_versions_in_force_nowhere_still_cut(spark):
    rows = [("p", 0, 10, 1, "wide"), ("p", 4, 4, 2, "empty"), ("p", 7, 2, 3, "reversed"), ("p", None, 9, 4, "startless"), (None, 0, 1, 5, "keyless"), ("p", 0, 10, None, "loses")]
    frame = spark.createDataFrame(rows, "p string, valid_from_utc int, valid_to_utc int, source_row_id int, v string")
    got = sorted((r["_first"], r["_until"], r["v"]) for r in segments(frame, "p", ["v"], unit=F.col).collect())
    assert got == [(a, b, "wide") for a, b in zip([0, 2, 4, 7, 9], [2, 4, 7, 9, 10], strict=True)]
    assert segments(frame.limit(0), "p", ["v"], unit=F.col).count() == 0


def test_exact_profile_equals_numpy(spark):
    rnd = random.Random(7)
    values = [round(rnd.gauss(500, 4000), 2) for _ in range(501)] + [12.5] * 40
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, n int").withColumn("x", F.col("x").cast("decimal(14,2)"))
    rows = {r["metric"]: r for r in c.exact_profile(df, ["x", "n"]).collect()}
    x = rows["x"]
    assert x["count"] == len(values) and x["min"] == min(values) and x["max"] == max(values)
    assert np.allclose([x["q25"], x["q50"], x["q75"]], np.percentile(values, [25, 50, 75]))
    assert np.isclose(x["mean"], statistics.mean(values)) and np.isclose(x["stddev"], statistics.stdev(values))
    assert rows["n"]["q50"] == (len(values) - 1) / 2


def test_profile_columns(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), (None, 2, None)], "name string, n int, empty int")
    rows = {r["column_name"]: tuple(r[x] for x in ("row_count", "value_count", "distinct_count", "column_class"))
            for r in c.profile_columns(df).collect()}
    assert rows == {"name": (3, 2, 1, "categorical"), "n": (3, 3, 2, "numeric"), "empty": (3, 0, 0, "categorical")}


def test_full_difference_keeps_one_sided_rows(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", 2), ("z", 5)], "k string, b int")
    assert {tuple(r) for r in c.full_difference(a, b, ["k"], "a", "b").collect()} == {("x", 1, 0, 1), ("z", 0, 5, -5)}


def test_members_and_non_members(spark):
    a, b = spark.range(4), spark.createDataFrame([(1,), (1,), (3,)], "id bigint")
    assert c.members(a, b, "id").count() == 2 and c.non_members(a, b, "id").count() == 2


def test_rules_on_empty_input(spark):
    row = only(c.grain(spark.range(0), ["id"]))
    assert tuple(row) == (0, 0, 0, 0)
