import time
from collections import defaultdict

import pytest
from llm_samples import DOC, doc, frame, odd_rows, with_clashes

from mercato.llm import line_dedup


def by_hand(rows, sites):
    spread = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            spread[line.strip(" ")].add(r[3])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        gone = [bool(x.strip(" ")) and len(spread[x.strip(" ")]) >= sites for x in lines]
        out.append((r[0], "\n".join(x for x, g in zip(lines, gone, strict=True) if not g), sum(bool(x.strip(" ")) for x in lines), sum(gone)))
    return sorted(out, key=repr)


ROWS = odd_rows() + [doc(100 + i, f"own line {i}\n shared by {i % 7}  \n\nAll rights reserved.\nshared by {i % 3}", f"site{i % 9}") for i in range(60)] + [
    doc(300 + i, "everywhere\nlocal\nlocal", None if i == 5 else f"t{i}") for i in range(40)] + [doc(400, "local\n"), doc(100, None)]


@pytest.mark.parametrize("sites", [2, 5, 9, 30])
def test_equals_brute_force(spark, sites):
    got = line_dedup.clean_lines(with_clashes(frame(spark, ROWS)).repartition(5), sites=sites)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=repr) == by_hand(ROWS, sites)


def test_estimates_decide_far_from_the_threshold(spark):
    """Many sites: only keys near the threshold are counted exactly, and the decision is that of exact counts."""
    rows = [(k, f"s{s}") for k in range(1, 60) for s in range(k * 25)]
    got = {r.key for r in line_dedup.spread_lines(spark.createDataFrame(rows, "key bigint, site string").repartition(6), sites=700).collect()}
    assert got == {k for k in range(1, 60) if k * 25 >= 700}


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("mercato.llm.shared.small_enough", lambda df, limit=0: False)
    got = line_dedup.clean_lines(frame(spark, ROWS), sites=5)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()), key=repr) == by_hand(ROWS, 5)


def test_one_very_long_text_costs_its_length(spark):
    lines = [f"shared {i}" if i % 2 else f"own {i}" for i in range(500_000)]
    rows = [doc(1, "\n".join(lines), "s1"), doc(2, "\n".join(lines[1::2]), "s2"), doc(3, "\n".join(lines), "s1")]
    begun = time.monotonic()
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.clean_lines(frame(spark, rows), sites=2).collect()}
    assert time.monotonic() - begun < 60
    assert got == {1: ("\n".join(lines[::2]), 500_000, 250_000), 2: ("", 250_000, 250_000), 3: ("\n".join(lines[::2]), 500_000, 250_000)}


def test_no_python_on_the_main_path(spark):
    plan = line_dedup.clean_lines(frame(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty(spark):
    assert line_dedup.clean_lines(spark.createDataFrame([], DOC)).count() == 0
