import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_samples import DOC, doc, frame, odd_rows, prose, with_clashes

from mercato.llm import suffix_dedup


def by_hand(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        edge = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                edge[i] += 1
                edge[i + length] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((r[0], len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=repr)


def repetitive():
    rng = random.Random(8)
    base = "".join(rng.choices("ab ", k=900))
    rows = [doc(i, base[: rng.randint(0, 500)] + "".join(rng.choices("abc", k=rng.randint(0, 90))) + base[rng.randint(0, 800):]) for i in range(60)]
    return rows + [doc(200, "a" * 700), doc(201, "a" * 199), doc(202, "ab" * 300), doc(203, "é" * 150), doc(204, base), doc(204, base)]


CASES = {"odd": [r for r in odd_rows() if r[0] not in (8, 9)] + [doc(8, "w1 w2 " * 400)], "prose": prose(120), "repetitive": repetitive()}


@pytest.mark.parametrize("options", [{}, {"hot": 1}, {"bucket_bytes": 3000, "hot": 3}], ids=["plain", "hot", "buckets"])
@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name, options):
    rows = CASES[name]
    got = suffix_dedup.remove_repeats(with_clashes(frame(spark, rows)).repartition(3), **options).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == by_hand(rows, 200)


@pytest.mark.parametrize("length, gram", [(20, 4), (33, 8), (64, 64)])
def test_other_lengths(spark, length, gram):
    got = suffix_dedup.remove_repeats(frame(spark, prose(60)), length, gram, hot=4).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == by_hand(prose(60), length)


def test_run_index_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(40):
        strings = ["".join(rng.choices("ab", k=rng.randint(1, 25))).encode() for _ in range(rng.randint(1, 8))] + [b"\x00\xc3\xa9"]
        index = suffix_dedup.RunIndex(strings)
        want = []
        suffixes = [(i, k) for i, s in enumerate(strings) for k in range(len(s))]
        for i, k in suffixes:
            best = 0
            for j, m in suffixes:
                if (i, k) != (j, m):
                    n = 0
                    while k + n < len(strings[i]) and m + n < len(strings[j]) and strings[i][k + n] == strings[j][m + n]:
                        n += 1
                    best = max(best, n)
            want.append(best)
        got = index.statistics(10_000)
        inside = np.flatnonzero(index.symbols)
        assert got[inside].tolist() == want
        # The runs, unrolled, are the transform of the sorted suffixes.
        assert np.repeat(index.run_symbols, np.diff(np.append(index.heads, len(index.order)))).tolist() == index.symbols[index.order - 1].tolist()


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("mercato.llm.shared.small_enough", lambda df, limit=0: False)
    got = suffix_dedup.remove_repeats(frame(spark, repetitive()), hot=2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_hand(repetitive(), 200)


def test_a_passage_in_all_documents_fills_no_bucket(spark, monkeypatch):
    rng = random.Random(5)
    side = lambda: "".join(rng.choices("abcdefgh ", k=300))
    passage = side()
    rows = [doc(i, side() + passage + side()) for i in range(80)] + [doc(100, passage), doc(101, passage[:250] + side())]
    build = suffix_dedup._index_bucket

    def watched(length):
        run = build(length)

        def of_bucket(bucket):
            assert bucket["bytes"].str.len().sum() < 9000
            return run(bucket)

        return of_bucket

    monkeypatch.setattr(suffix_dedup, "_index_bucket", watched)
    got = suffix_dedup.remove_repeats(frame(spark, rows), bucket_bytes=2000, hot=8).collect()
    assert sorted((tuple(r) for r in got), key=repr) == by_hand(rows, 200)


def test_empty(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOC)).count() == 0
