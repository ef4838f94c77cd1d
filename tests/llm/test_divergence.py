import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

from mercato.llm import divergence


def terms(text):
    return [t.encode().lower().decode() for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def by_hand(rows, min_docs, top):
    groups, held, spread = defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups[lang][source].update(terms(text))
        held[lang].update(terms(text))
        spread[lang].update(set(terms(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t in held[lang] if spread[lang][t] >= min_docs]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in sources.items()}, shares(held[lang])
        price = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            more = [(t, price(p[s][t], q[t])) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", more, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


MANY = [doc(i, f"{t} w{i % 7} ab{'abc'[i % 3]} x" * (i % 5 + 1), f"s{i % 70}", "en") for i, t in enumerate(["alpha Beta", "beta é", "É gamma"] * 60)]


@pytest.mark.parametrize("min_docs", [1, 3, 10])
@pytest.mark.parametrize("rows", [odd_rows(), prose(150), [*MANY, doc(900, "no kept term", "lonely", "xx"), doc(901, "", "quiet", "xx"), doc(902, None, None, None)]],
                         ids=["odd", "prose", "many sources"])
def test_equals_brute_force(spark, rows, min_docs):
    got = divergence.audit(with_clashes(frame(spark, rows)).repartition(3), min_docs, 4)
    assert sorted(tuple(r) for r in got.collect()) == by_hand(rows, min_docs, 4)


@pytest.mark.parametrize("setting", [("SOURCES", 3), ("CHUNK", 7), ("ENTRIES", 5), ("PIECE", 4), ("COLUMNS", 4)])
def test_blocks_and_bounds_change_nothing(spark, monkeypatch, setting):
    """Functions travel by value, with the module's settings as they are."""
    monkeypatch.setattr(divergence, *setting)
    monkeypatch.setattr(divergence, "LEAST_TERMS", 2)
    rows = prose(80)
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows).repartition(2), 2, 3).collect()) == by_hand(rows, 2, 3)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("mercato.llm.shared.small_enough", lambda df, limit=0: False)
    rows = prose(80)
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows), 2, 3).collect()) == by_hand(rows, 2, 3)


def test_products_give_whole_joint_tables(monkeypatch):
    rng = np.random.default_rng(3)
    levels = np.floor(rng.pareto(1, (200, 6)) * 2).astype(np.int64)
    monkeypatch.setattr(divergence, "COLUMNS", 16)
    tables = Counter()
    for a, ta, b, tb, n in divergence.joint_tables(levels, np.array([0, 2, 3]), np.array([1, 3, 5])):
        for cell in zip(a, levels[ta, a], b, levels[tb, b], n, strict=True):
            tables[tuple(int(x) for x in cell[:4])] += int(cell[4])
    assert tables == Counter((a, int(r[a]), b, int(r[b])) for r in levels for a in (0, 2, 3) for b in (1, 3, 5))


def test_large_counts_stay_exact(spark):
    """Shares of counts whose product with a billion no long holds."""
    df = spark.sql("SELECT 20000000000 AS n, 60000000000 AS total, 3 AS terms").select(divergence._share("n", "total").alias("p"))
    assert df.first().p == 1 + 10**9 * (20000000000 + 2) // (60000000000 + 6)


def test_one_very_long_text(spark):
    rows = [doc(1, " ".join(f"t{'abcdefghij'[i % 10]}x{'abc'[i % 3]}" for i in range(400_000))), doc(2, "tax " * 1000, "b")]
    assert sorted(tuple(r) for r in divergence.audit(frame(spark, rows), 1, 5).collect()) == by_hand(rows, 1, 5)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], DOC)).count() == 0
