from collections import defaultdict

import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

from mercato.llm import mixing


def size(text):
    return len((text or "").encode().split())


def targets_by_hand(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        weights = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else weight[s] * rest / weights for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s]}
        if over <= capped:
            return sizes, target
        capped |= over


CASES = {"odd": odd_rows(), "prose": prose(400), "tiny source": prose(200) + [doc(900, "one two", "a0"), doc(901, "x", None)], "one": [doc(1, "a b c")],
         "skewed": [doc(i, "w " * 4, "a") for i in range(1000)] + [doc(1000, "w " * 6000, "a")] + [doc(2000 + i, "w " * 7, "b") for i in range(300)],
         "wide": [doc(i, "w " * (1 + i * i % 97 + (3000 if i % 50 == 0 else 0)), f"s{i % 4}") for i in range(800)],
         "wordless": [doc(1, ""), doc(2, None)]}


@pytest.mark.parametrize("buckets", [4, 4096])
@pytest.mark.parametrize("name", CASES)
def test_targets_and_taken(spark, name, buckets):
    rows = CASES[name]
    sizes, target = targets_by_hand(rows)
    got = mixing.plan_mix(with_clashes(frame(spark, rows)), buckets=buckets).collect()
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((r[0], size(r[1])) for r in rows if r[0] is not None)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, want in target.items():
        largest = max(r.size for r in got if r.source == s)
        assert abs(taken[s] - want) <= max(1, largest / 2)  # at worst half of one document away
        unplaced = [r.size for r in got if r.source == s and r.size and r.copies < min(3, int(want / sizes[s]) + 1)] if sizes[s] else []
        assert not unplaced or abs(taken[s] - want) <= max(1, min(unplaced)), s


def test_reruns_agree(spark):
    docs = frame(spark, prose(300))
    first = sorted((r.doc_id, r.taken) for r in mixing.plan_mix(docs).collect())
    assert first == sorted((r.doc_id, r.taken) for r in mixing.plan_mix(docs.repartition(7)).collect())


def test_ranking_does_not_favour_ids(spark):
    """Every document of a source has the same chance of the extra copy."""
    rows = [doc(i, "w " * 10, "a" if i % 2 else "b") for i in range(4000)]
    got = [r for r in mixing.plan_mix(frame(spark, rows)).collect() if r.source == "b"]
    low = sum(r.copies for r in got if r.doc_id < 2000)
    assert abs(low / sum(r.copies for r in got) - 0.5) < 0.05


def test_skewed_source_meets_its_target(spark):
    """One document of most of a source's words is certain, the small ones make up the rest."""
    got = [r for r in mixing.plan_mix(frame(spark, CASES["skewed"])).collect() if r.source == "a"]
    want = got[0].target
    assert abs(sum(r.taken for r in got) - want) < 4


def test_inclusion_is_proportional_to_size(spark):
    rows = [doc(i, "w " * (10 if i % 2 else 20), "b") for i in range(4000)] + [doc(9000 + i, "w " * 15, "a") for i in range(4000)]
    got = [r for r in mixing.plan_mix(frame(spark, rows)).collect() if r.source == "b"]
    rate = {n: sum(r.copies for r in got if r.size == n) / 2000 for n in (10, 20)}
    assert rate[20] / rate[10] == pytest.approx(2, rel=0.15)


def test_mixed_carries_columns(spark):
    rows = odd_rows() + prose(100, seed=9)
    docs = with_clashes(frame(spark, rows))
    out = mixing.mixed(docs)
    assert [c for c in out.columns if c not in ("size", "source_size", "target", "copies", "taken")] == [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    assert all(r.taken > 0 and r["key"] == "own key" for r in out.collect())


def test_empty(spark):
    assert mixing.plan_mix(spark.createDataFrame([], DOC)).count() == 0
    assert mixing.mixed(spark.createDataFrame([], DOC)).count() == 0
