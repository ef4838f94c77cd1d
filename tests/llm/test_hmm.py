import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from llm_samples import DOC, frame, odd_rows, prose, with_clashes

from mercato.llm import hmm

ROWS = [r for r in odd_rows() if r[0] not in (8, 9)] + prose(150)
HELD = {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in ROWS}


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def model_of(states=2, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    emit, move, start = rng.uniform(0.1, 1, (classes, states)), rng.uniform(0.1, 1, (states, states)), rng.uniform(0.1, 1, states)
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, sequence):
    """(probability, states) of every path."""
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emit[sequence[0], path[0]]
        for a, b, c in zip(path, path[1:], sequence[1:], strict=False):
            p *= model.move[a, b] * model.emit[c, b]
        yield p, path


SEQUENCES = [np.array(s, dtype="<i4") for s in ([0], [1, 2, 0, 1], [2, 2], [0, 1, 2, 0, 1, 1, 2])]


def test_forward_equals_the_sum_over_paths():
    model = model_of()
    want = [math.log10(sum(p for p, _ in paths(model, s))) for s in SEQUENCES]
    assert model.forward(SEQUENCES) == pytest.approx(want)


def test_expected_counts_equal_the_sum_over_paths():
    model = model_of()
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for s in SEQUENCES:
        total = sum(p for p, _ in paths(model, s))
        for p, path in paths(model, s):
            start[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p / total
            for c, k in zip(s, path, strict=True):
                emit[c, k] += p / total
    for got, want in zip(model.expected(SEQUENCES), (start, move, emit), strict=True):
        assert np.allclose(got, want, rtol=1e-4)


@pytest.fixture(scope="module")
def scored(spark):
    return hmm.lm_scores(with_clashes(frame(spark, ROWS)), class_words=50, rare_classes=4, states=3, rounds=2).collect()


def test_base_scores_equal_brute_force(scored):
    bag = Counter(t for r in ROWS if not HELD[r[0]] for t in tokens(r[1]))
    n, v = sum(bag.values()), len(bag)
    want = [(r[0], HELD[r[0]], len(tokens(r[1])), sum(t in bag for t in tokens(r[1])), n, round(sum(math.log10((bag[t] + 1) / (n + v + 1)) for t in tokens(r[1])), 6)) for r in ROWS]
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored), key=repr) == sorted(want, key=repr)


def test_scores_are_log_probabilities(scored):
    assert all(r.score < 0 and math.isfinite(r.score) for r in scored)


def test_rounds_raise_the_likelihood_of_training_texts(spark):
    docs = frame(spark, prose(120))
    sums = [sum(r.score for r in hmm.lm_scores(docs, class_words=60, rare_classes=4, states=3, rounds=k).collect() if not r.held_out) for k in (0, 1, 3)]
    assert sums[0] < sums[1] < sums[2]


def test_small_counters_give_the_same_counts(spark, monkeypatch):
    texts = frame(spark, prose(60)).select("text")
    whole = {r.word and bytes(r.word): r.n for r in hmm.word_counts(texts).collect()}
    monkeypatch.setattr(hmm, "COUNTER_WORDS", 5)
    assert whole == {r.word and bytes(r.word): r.n for r in hmm.word_counts(texts).collect()} == dict(Counter(t for r in prose(60) for t in tokens(r[1])))


def test_no_training_text_and_empty(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = hmm.lm_scores(frame(spark, [(held, "a b", "en", "s", 3)])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and math.isfinite(row.score)
    assert hmm.lm_scores(spark.createDataFrame([], DOC)).count() == 0


def test_small_slices_give_the_same_scores(spark, scored, monkeypatch):
    monkeypatch.setattr(hmm, "SLICE_ROWS", 7)
    again = hmm.lm_scores(frame(spark, ROWS), class_words=50, rare_classes=4, states=3, rounds=2).collect()
    assert sorted(((r.doc_id, r.n_known, round(r.base_score, 6)) for r in again), key=repr) == sorted(((r.doc_id, r.n_known, round(r.base_score, 6)) for r in scored), key=repr)
    assert sum(r.score for r in again) == pytest.approx(sum(r.score for r in scored), rel=1e-5)


def test_words_beyond_the_dictionary_have_counts_of_their_own(spark):
    """A round over rare words equals one over a dictionary that holds them all, given the same first guess."""
    docs = frame(spark, prose(120))
    small, large = ({r.doc_id: r.score for r in hmm.lm_scores(docs, class_words=k, rare_classes=4, states=1, rounds=1).collect()} for k in (5, 100_000))
    assert small == pytest.approx(large, rel=1e-6)


def test_rare_words_part_by_state(spark):
    """Two kinds of texts without a common word: the states learn them though no word is in the dictionary."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + k * k) % 40}" for k in range(60)), "en", "s", 300) for i in range(80)]
    first, last = (sum(r.score for r in hmm.lm_scores(frame(spark, rows), class_words=1, rare_classes=4, states=2, rounds=k).collect()) for k in (0, 8))
    assert last > first + 80 * 60 * 0.2


@pytest.mark.parametrize("fan_in", [2, 16])
def test_two_rounds_of_three_states_equal_one_machine(spark, monkeypatch, fan_in):
    """Baum-Welch over blocks and tables beside plain sums over all sequences, from the same first guess."""
    monkeypatch.setattr(hmm, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(hmm, "FAN_IN", fan_in)
    rows, states, classes = prose(60), 3, 10_000
    got = {r.doc_id: r.score for r in hmm.lm_scores(frame(spark, rows).repartition(3), class_words=classes, rare_classes=4, states=states, rounds=2).collect()}
    train = [tokens(r[1]) for r in rows if not (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2)]
    bag = Counter(t for text in train for t in text)
    order = sorted((w for w in bag if w is not None), key=lambda w: (-bag[w], w))
    number = {w: i for i, w in enumerate(order)} | {None: len(order)}
    counts = np.array([bag[w] for w in order] + [bag[None]], float)
    noise = np.random.default_rng(hmm.SEED).uniform(0.5, 1.5, (len(counts), states))
    emit = (counts[:, None] + hmm.SMOOTH) * noise
    start, move = np.full(states, 1 / states), np.full((states, states), (1 - hmm.STAY) / states) + np.eye(states) * hmm.STAY
    for _ in range(2):
        s, m, e = hmm.Model(start, move, emit / (emit.sum(axis=0) + 4 * hmm.SMOOTH)).expected([np.array([number[t] for t in text]) for text in train])
        start, move, emit = s + hmm.SMOOTH, m + hmm.SMOOTH, e + hmm.SMOOTH
        start, move = start / start.sum(), move / move.sum(axis=1, keepdims=True)
    weights = np.concatenate([emit, np.full((1, states), hmm.SMOOTH)]) / (emit.sum(axis=0) + 4 * hmm.SMOOTH)
    want = hmm.Model(start, move, weights).forward([np.array([number.get(t, len(counts)) for t in tokens(r[1])]) for r in rows])
    assert [got[r[0]] for r in rows] == pytest.approx(list(want), rel=1e-5)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(3)
    for numbers in (np.empty(0, "<i4"), np.arange(1, dtype="<i4"), rng.integers(0, 300, 5000).astype("<i4"), rng.random((700, 6)).astype("<f4")):
        packed = hmm._pack(numbers)
        assert np.array_equal(hmm._unpack(packed, numbers.dtype), numbers.ravel())
    assert len(hmm._pack(rng.integers(0, 300, 5000).astype("<i4"))) < 8000


def test_a_team_of_blocks_leaves_one_sum():
    """Blocks that one task goes through send their counts together, and nothing is lost by that."""
    frequent, states = {b"a": 0, b"b": 1}, 2
    blocks, words = [], []
    for number, text in enumerate(["a x b x", "b y x z", "a a y"]):
        block = hmm._Block(False)
        block.add(str(number), text, frequent)
        blocks.append(block.row(len(frequent)).assign(block=number, n_words=len(block.others)))
        for word, code in block.others.items():
            no = b"xyz".index(word)
            words.append((number, code - len(frequent) - 1, no, 1 if word == b"z" else 2, 1.0 + no, 2.0))
    words = pd.DataFrame(words, columns=["block", "at", "word_no", "n", "w0", "w1"])
    frequent_weights = np.array([[3.0, 2.0], [2.0, 2.5], [3.0, 3.0]])
    sent = (np.array([0.5, 0.5]), np.array([[0.8, 0.2], [0.3, 0.7]]), frequent_weights, np.array([30.0, 31.0]))
    expect, size = hmm._expectations(sent), len(frequent_weights) + 2 + states
    whole = expect(pd.concat(blocks), words)
    apart = [expect(b, words[words["block"] == k]) for k, b in enumerate(blocks)]
    assert whole["few"].notna().sum() == 1 and len(whole) == len(blocks) + 2  # a row per block, and one each for x and y
    held = lambda rows: rows[rows["few"].notna()]
    assert np.allclose(hmm._added(held(whole), size, states), hmm._added(pd.concat([held(a) for a in apart]), size, states), rtol=1e-6)
    counts = lambda rows: rows[rows["word_no"] >= 0].groupby("word_no")[["w0", "w1"]].sum()
    assert np.allclose(counts(whole), counts(pd.concat(apart)), rtol=1e-6)
    assert [hmm._unpack(x, "<f4").size // states for x in whole["once"].dropna()] == [0, 1, 0]
