"""Records flattened to any depth, whatever keys they hold.

The keys come from the records: one distributed pass merges the schema of every record, and
only that schema reaches the driver. Each path to a value becomes a column named by its keys
joined with dots, typed as found; arrays, and values whose type differs between records,
stay JSON text. A second pass over the same records counts what nobody declared.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import Source

# A record used as a map would make columns without end; an object with more keys stays JSON text.
MOST_KEYS = 1000
_QUOTED = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


@dataclass(frozen=True)
class Leaf:
    """A path of keys to a value, and the type it has in all records (None: JSON text)."""

    keys: tuple[str, ...]
    kind: str | None

    @property
    def name(self) -> str:
        return ".".join(self.keys)

    def value(self, record: Column) -> Column:
        found = F.try_variant_get(record, _path(self.keys), self.kind or "variant")
        return found if self.kind else F.when(~F.is_variant_null(found), F.to_json(found))


def _path(keys: tuple[str, ...]) -> str:
    return "$" + "".join(f'["{k}"]' if "'" in k else f"['{k}']" for k in keys)


def _leaves(kind: T.DataType, keys: tuple[str, ...]) -> list[Leaf]:
    if isinstance(kind, T.StructType) and keys and not kind.fields:
        return [Leaf(keys, None)]
    speakable = isinstance(kind, T.StructType) and len(kind) <= MOST_KEYS and not any("'" in f.name and '"' in f.name for f in kind)
    if speakable:
        return [leaf for f in kind for leaf in _leaves(f.dataType, (*keys, f.name))]
    scalar = not isinstance(kind, (T.StructType, T.ArrayType, T.VariantType, T.NullType))
    return [Leaf(keys, kind.simpleString() if scalar else None)] if keys else []


def found_leaves(records: DataFrame, raw: str = "raw") -> list[Leaf]:
    """The paths to values of all records of a feed, by name."""
    merged = records.agg(F.schema_of_variant_agg(F.try_parse_json(raw))).head()[0]
    if not merged or not merged.startswith("OBJECT<"):  # no record, or none that is an object
        return []
    ddl = _QUOTED.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], merged)
    return sorted(_leaves(T.DataType.fromDDL(ddl), ()), key=lambda leaf: leaf.name)


def flatten_any(records: DataFrame, raw: str = "raw", keep: tuple[str, ...] = (), leaves: list[Leaf] | None = None) -> DataFrame:
    """One column per path found in the records, and the columns to ``keep``; unreadable records have nulls."""
    leaves = found_leaves(records, raw) if leaves is None else leaves
    parsed = records.withColumn("_record", F.try_parse_json(raw))
    return parsed.select(*[leaf.value(F.col("_record")).alias(leaf.name) for leaf in leaves], *keep)


def declared_paths(source: Source) -> set[str]:
    return {f"payload.{c}" if c in source.nested else c for c in source.columns}


def drift(records: DataFrame, source: Source, raw: str = "raw") -> DataFrame:
    """Paths that records hold and nobody declared, and declared ones that none holds: path, kind, record_count, declared."""
    leaves, declared = found_leaves(records, raw), declared_paths(source)
    spark = records.sparkSession
    schema = "path string, kind string, record_count bigint, declared boolean"
    absent = spark.createDataFrame([(p, None, 0, True) for p in sorted(declared - {x.name for x in leaves})], schema)
    unknown = [x for x in leaves if x.name not in declared]
    if not unknown:
        return absent
    parsed = records.select(F.try_parse_json(raw).alias("_record"))
    found = [F.try_variant_get("_record", _path(x.keys), "variant") for x in unknown]
    counts = parsed.agg(*[F.count_if(v.isNotNull() & ~F.is_variant_null(v)).alias(f"n{i}") for i, v in enumerate(found)])
    rows = F.array(*[F.struct(F.lit(x.name).alias("path"), F.lit(x.kind or "json").alias("kind"), F.col(f"n{i}").alias("record_count"), F.lit(False).alias("declared"))
                     for i, x in enumerate(unknown)])
    return counts.select(F.inline(rows)).unionByName(absent)
