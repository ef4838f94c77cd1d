"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``. The grammar is
deterministic and never looks past a turn's end, so turns parse alike alone and in a row:

* a turn starts with ``<|im_start|>``; its role goes to the next newline, its text to the
  next ``<|im_end|>`` with the newline behind it;
* in a text, a control string with backslashes behind its ``<`` stands for the same with one less;
* in a role, ``\\n`` stands for a newline and ``\\\\`` for a backslash.

Every rendered turn is parsed again and compared with its source. A role or text that did
not come back is escaped, and the turn is rendered and parsed anew, until all is identical.
Text that the grammar returns as it is stays untouched.

``format_turns`` works row by row: nothing moves, however long a conversation is. Its output
is the formatted piece of each turn and the part of it under the loss mask (the assistant's
text without its end mark). ``read_back`` deals the pieces by conversation, sorts them there
and streams them through the same parser with running digests: a task holds one batch of
pieces and one open turn, never a conversation. A SHA-256 over a whole conversation is
sequential by its nature, so one conversation is read by one task.

Defined cases: null role and text are empty; a null turn follows the others; equal turns
are ordered by role, then text, and each repeated row is a turn; a null conv_id is one
conversation of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"

_CONTROL = re.compile(r"<(\\*)\|(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|(im_start|im_end)\|>")
_ROLE_ESCAPES = re.compile(r"\\(n|\\)")

_PIECES = "conv_id bigint, turn bigint, role string, text string, formatted string, loss_from int, loss_to int"
_READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def escape_text(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|\2|>", text)


def unescape_text(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text) if "<\\" in text else text


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPES.sub(lambda m: "\n" if m[1] == "n" else "\\", role) if "\\" in role else role


def parse(formatted: str, start: int = 0) -> tuple[list[tuple[str, str, int, int]], int]:
    """(role, text, where the text starts and ends) of each whole turn, and where parsing stopped."""
    turns = []
    while formatted.startswith(START, start):
        line = formatted.find("\n", start)
        end = formatted.find(END, line + 1) if line >= 0 else -1
        if end < 0 or not formatted.startswith("\n", end + len(END)):
            break
        turns.append((unescape_role(formatted[start + len(START):line]), unescape_text(formatted[line + 1:end]), line + 1, end))
        start = end + len(END) + 1
    return turns, start


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of a turn that parses to exactly this turn, and where its text stands in it."""
    shown_role, shown_text = role, text
    while True:
        piece = f"{START}{shown_role}\n{shown_text}{END}\n"
        turns, stop = parse(piece)
        if stop == len(piece) and [t[:2] for t in turns] == [(role, text)]:
            return piece, turns[0][2], turns[0][3]
        escaped = (shown_role if turns and turns[0][0] == role else escape_role(role),
                   shown_text if turns and turns[0][1] == text and len(turns) == 1 and stop == len(piece) else escape_text(text))
        if escaped == (shown_role, shown_text):
            raise AssertionError("an escaped turn must come back as it was")
        shown_role, shown_text = escaped


def _format(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pieces = [render(role, text) for role, text in zip(batch["role"], batch["text"], strict=True)]
        formatted, starts, ends = zip(*pieces, strict=True) if pieces else ((), (), ())
        learned = batch["role"] == LEARNED
        yield batch.assign(formatted=list(formatted), loss_from=pd.Series(starts, batch.index, dtype="Int32").where(learned),
                           loss_to=pd.Series(ends, batch.index, dtype="Int32").where(learned))


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, role, text, formatted, loss_from and loss_to (code points of ``formatted``; null: no loss)."""
    plain = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInPandas(_format, _PIECES)


class _Reader:
    """Reads one conversation's pieces as one stream."""

    def __init__(self):
        self.open, self.turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.read, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss_from, loss_to) -> None:
        if not pd.isna(loss_from):
            learned = unescape_text(piece[int(loss_from):int(loss_to)])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        self.chars += len(piece)
        self.open += piece
        found, stop = parse(self.open)
        self.open = self.open[stop:]
        for role, text, _, _ in found:
            self.turns += 1
            self.read.update(f"{role}\n{text}\n".encode())

    def row(self, conv_id):
        if self.open:
            raise ValueError(f"conversation {conv_id} does not end with a whole turn")
        return conv_id, self.turns, self.read.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split(" ")[0] for c in _READ.split(", ")]

    def frame(rows):
        return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

    reader, current, first = _Reader(), None, True
    for batch in batches:
        done = []
        ids = [None if pd.isna(c) else int(c) for c in batch["conv_id"]]
        for conv_id, piece, start, end in zip(ids, batch["formatted"], batch["loss_from"], batch["loss_to"], strict=True):
            if first or conv_id != current:
                if not first:
                    done.append(reader.row(current))
                reader, current, first = _Reader(), conv_id, False
            reader.feed(piece, start, end)
        yield frame(done)
    if not first:
        yield frame([reader.row(current)])


def read_back(pieces: DataFrame) -> DataFrame:
    """What the formatted pieces say, per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The order of the turns is that of ``turn``, role and text; only the formatted pieces and the mask are read.
    """
    ordered = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text")
               .select(F.col("conv_id").cast("bigint").alias("conv_id"), "formatted", "loss_from", "loss_to"))
    return ordered.mapInPandas(_read, _READ)
