"""Each oracle is ``WITH <the named parts it mentions> SELECT ...``."""

from __future__ import annotations

import re

from .answers import ANSWERS
from .parts import PARTS


def _needed(sql: str, seen: dict[str, str]) -> None:
    for word in re.findall(r"[a-z_0-9]+", sql):
        if word in PARTS and word not in seen:
            _needed(PARTS[word], seen)
            seen[word] = PARTS[word]


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, answer in ANSWERS.items():
        parts: dict[str, str] = {}
        _needed(answer, parts)
        body = ",\n".join(f"{name} AS (\n{sql.strip()}\n)" for name, sql in parts.items())
        out[key] = f"WITH {body}\n{answer.strip()}" if body else answer.strip()
    return out
