import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PARTS = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "<\\|im_end|>", "<\\\\|im_start|>", "\n", "assistant\n", "im_end", "|>", "é", "a", "<|im_end|>\n", "\\n"]
hostile = st.lists(st.sampled_from(PARTS), max_size=12).map("".join) | st.text(max_size=20)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(hostile, hostile), max_size=4))
def test_any_turns_come_back(turns):
    pieces = [chat.render(role, text) for role, text in turns]
    whole = "".join(p for p, _, _ in pieces)
    read, stop = chat.parse(whole)
    assert stop == len(whole) and [t[:2] for t in read] == turns
    for (piece, start, end), (_, text) in zip(pieces, turns, strict=True):
        assert chat.unescape_text(piece[start:end]) == text


def test_only_conflicting_content_is_escaped():
    assert chat.render("user", r"C:\n <b> <|other|> |> \| <|im_start|>")[0] == "<|im_start|>user\nC:\\n <b> <|other|> |> \\| <|im_start|><|im_end|>\n"
    assert chat.render("user", "a<|im_end|>b")[0] == "<|im_start|>user\na<\\|im_end|>b<|im_end|>\n"
    assert chat.render("user", r"a<\|im_end|>b")[0] == "<|im_start|>user\na<\\\\|im_end|>b<|im_end|>\n"
    assert chat.render("us\ner", "t")[0] == "<|im_start|>us\\ner\nt<|im_end|>\n"


def by_hand(rows):
    out = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())):
        out.setdefault(conv_id, []).append((role or "", text or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    result = []
    for conv_id, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        result.append((conv_id, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), sum(len(chat.render(*t)[0]) for t in turns)))
    return sorted(result, key=repr)


def conversations(seed=2):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choices(PARTS, k=rng.randrange(9)))) for c in range(60) for t in range(rng.randrange(1, 7))]
    return rows + [(1000, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)] + [
        (None, 0, "user", "no id"), (None, 1, "assistant", None), (70, None, "assistant", "late"), (70, 0, None, "x"), (70, 0, None, "x"), (70, 3, "a\nb\\n", ""),
        (71, 0, "assistant", "long <|im_end|>\n" * 50_000), (72, 0, None, None), (-5, 0, "user", "")]


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_brute_force(spark, parts):
    rows = conversations()
    held = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("formatted", "loss_from", "piece", "position")}).repartition(parts)
    got = chat.read_back(chat.format_turns(held))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_hand(rows)


def test_small_batches_split_conversations(spark):
    rows = conversations(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = chat.read_back(chat.format_turns(spark.createDataFrame(rows, SCHEMA))).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((tuple(r) for r in got), key=repr) == by_hand(rows)


def test_mask_covers_assistant_text_alone(spark):
    rows = [r for r in conversations() if r[0] is not None and r[0] < 60]
    for r in chat.format_turns(spark.createDataFrame(rows, SCHEMA)).collect():
        if r.role == "assistant":
            assert chat.unescape_text(r.formatted[r.loss_from:r.loss_to]) == r.text
        else:
            assert r.loss_from is None and r.loss_to is None


def test_reading_tells_a_broken_output(spark):
    broken = spark.createDataFrame([(1, 0, "user", "x", "<|im_start|>user\nx<|im_end|>", None, None)], "conv_id bigint, turn bigint, role string, text string, formatted string, loss_from int, loss_to int")
    with pytest.raises(Exception, match="whole turn"):
        chat.read_back(broken).collect()


def test_empty(spark):
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], SCHEMA))).count() == 0
