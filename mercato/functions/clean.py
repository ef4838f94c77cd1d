"""Typing and cleaning of source text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .metrics import col

# Timestamp spellings accepted besides ISO 8601.
EXTRA_TIME_PATTERNS = ("yyyy/MM/dd HH:mm:ss", "dd-MM-yyyy HH:mm:ss", "yyyyMMddHHmmss")

# Date spellings accepted besides ISO 8601.
EXTRA_DAY_PATTERNS = ("yyyy/MM/dd", "dd-MM-yyyy", "yyyyMMdd")


def utc(text: Column | str, source_zone: str = "UTC") -> Column:
    """An instant from text; a spelling without offset is read in ``source_zone``.

    Needs the session zone UTC. Unreadable text gives NULL, never an error.
    """
    text = F.trim(col(text))
    has_offset = text.rlike(r"(Z|UTC|[+-]\d{2}:?\d{2}|[+-]\d{2})$") & text.rlike(r"\d:\d")
    parsed = F.coalesce(
        F.try_to_timestamp(text),
        *[F.try_to_timestamp(text, F.lit(p)) for p in EXTRA_TIME_PATTERNS],
    )
    if source_zone == "UTC":
        return parsed
    return F.when(has_offset, parsed).otherwise(F.to_utc_timestamp(parsed, source_zone))


def plain_day(text: Column | str, source_zone: str = "UTC") -> Column:
    """A date from text. Only a text that carries a time of day has a zone to shift from."""
    text = F.trim(col(text))
    has_time = text.rlike(r"\d:\d|^\d{14}$")
    dates = [text.try_cast("date"), *[F.to_date(F.try_to_timestamp(text, F.lit(p))) for p in EXTRA_DAY_PATTERNS]]
    return F.when(has_time, F.to_date(utc(text, source_zone))).otherwise(F.coalesce(*dates))


def canonical(status: Column | str, aliases: Mapping[str, str] | None = None) -> Column:
    """Upper-case, trimmed, underscored status with known aliases replaced."""
    text = F.upper(F.trim(col(status)))
    text = F.regexp_replace(text, r"[\s-]+", "_")
    if not aliases:
        return text
    pairs = [F.lit(x) for kv in aliases.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), text)


def record_sha(raw: Column | str) -> Column:
    return F.sha2(col(raw), 256)


def reasons(*rules: tuple[Column, str]) -> Column:
    """Array of the reasons whose condition holds; a NULL condition does not."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(reason)) for broken, reason in rules]))


def _iso(name: str, with_offset: bool) -> Column:
    """ISO 8601: seconds, microseconds where there are any, and the offset of an instant."""
    fraction = F.when(F.date_format(name, "SSSSSS") == "000000", F.lit("")).otherwise(F.date_format(name, ".SSSSSS"))
    parts = [F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), fraction]
    return F.concat(*parts, F.date_format(name, "xxx")) if with_offset else F.concat(*parts)


def json_friendly(schema) -> list[Column]:
    """Decimals as double, dates and times as ISO text, other columns unchanged."""
    out = []
    for field in schema.fields:
        kind = field.dataType.typeName()
        if kind == "decimal":
            out.append(F.col(field.name).cast("double").alias(field.name))
        elif kind == "date":
            out.append(F.date_format(field.name, "yyyy-MM-dd").alias(field.name))
        elif kind in ("timestamp", "timestamp_ntz"):
            out.append(_iso(field.name, kind == "timestamp").alias(field.name))
        else:
            out.append(F.col(field.name))
    return out
