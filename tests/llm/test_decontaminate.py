import hashlib
import re
import time

import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

from mercato.llm import decontaminate

ITEM = "item_id bigint, text string"


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def by_hand(rows, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for r in rows:
        w, hit, named = words(r[1]), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    named |= windows[tuple(w[i:i + n])]
        out.append((r[0], len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ROWS = odd_rows() + prose(120) + [doc(800, "É-a b, C d. e f g h i j k l"), doc(801, "x a b c d e f g h i j a b c d e f g h i j y")]
ITEMS = [(1, "é a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, "quick brown"), (4, "fox"), (5, None), (6, "..."), (7, "a b c d e f g h i j"), (None, "under the old tree"),
         (10, prose(120)[3][1]), (2, "the lazy dog and then it sleeps for a while under the old tree and more"), (11, "k l never there"), (12, "one two three four five")]


@pytest.mark.parametrize("items", [ITEMS, ITEMS[:1], []], ids=["many", "one", "none"])
def test_equals_brute_force(spark, items):
    got = decontaminate.contamination(with_clashes(frame(spark, ROWS)), frame(spark, items, ITEM))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=repr) == by_hand(ROWS, items)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("mercato.llm.shared.small_enough", lambda df, limit=0: False)
    got = decontaminate.contamination(frame(spark, ROWS), frame(spark, ITEMS, ITEM)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(ROWS, ITEMS)


def test_one_very_long_text_costs_its_length(spark):
    w = [f"w{i % 9973}" for i in range(500_000)]
    w[400_000:400_010] = [f"item{i}" for i in range(10)]
    begun = time.monotonic()
    got = decontaminate.contamination(frame(spark, [doc(1, " ".join(w))]), frame(spark, [(1, " ".join(w[400_000:400_010]))], ITEM)).first()
    assert time.monotonic() - begun < 60
    assert (got.n_words, got.n_hit, got.n_items) == (500_000, 10, 1)


def test_contaminated_rows_go(spark):
    docs = with_clashes(frame(spark, ROWS))
    left = decontaminate.drop_contaminated(docs, frame(spark, ITEMS, ITEM))
    assert left.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(repr(r[0]) for r in by_hand(ROWS, ITEMS) if not r[-1])


def test_no_python_on_the_main_path(spark):
    plan = decontaminate.contamination(frame(spark, ROWS), frame(spark, ITEMS, ITEM))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_empty(spark):
    assert decontaminate.contamination(spark.createDataFrame([], DOC), frame(spark, ITEMS, ITEM)).count() == 0
