"""Silver: typed, UTC, canonical, referentially checked and de-duplicated records.

Raw text is parsed with every leaf as text and cast with ``try_cast``, so nothing
fails on bad input: each broken rule adds a reason, and records with reasons go to
the rejected records instead of the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import canonical, plain_day, reasons, utc
from ..operators.versions import latest_by
from ..schemas import STATUS_ALIASES, Reference, Source

LINEAGE = ["record_sha", "file_name", "row_number", "run_id"]


def flatten(bronze: DataFrame, source: Source) -> DataFrame:
    """One text column per silver column (``payload`` opened), lineage kept."""
    flat = [c for c in source.columns if c not in source.nested]
    parts = [f"{c} string" for c in flat]
    if source.nested:
        parts.append("payload struct<" + ", ".join(f"{c}: string" for c in source.nested) + ">")
    parts.append("_corrupt string")
    parsed = F.from_json("raw", ", ".join(parts), {"columnNameOfCorruptRecord": "_corrupt"})
    fields = [F.col(f"_r.{c}").alias(c) for c in flat] + [F.col(f"_r.payload.{c}").alias(c) for c in source.nested]
    return bronze.withColumn("_r", parsed).select(
        *fields,
        (F.col("_r").isNull() | F.col("_r._corrupt").isNotNull()).alias("_unreadable"),
        F.col("timestamp").alias("ingested_at_utc"),
        "raw",
        *LINEAGE,
    )


def _typed(name: str, kind: str, zone: str) -> Column:
    text = F.col(name)
    if kind == "time":
        return utc(text, zone)
    if kind == "day":
        return plain_day(text, zone)
    if kind == "bigint":
        number = text.try_cast("decimal(20,4)")  # also accepts "5.0"
        return F.when(number == F.floor(number), number.try_cast("bigint"))
    if kind == "string":
        return text
    return text.try_cast(kind)


def checked(bronze: DataFrame, source: Source, zone: str = "UTC") -> DataFrame:
    """Typed columns plus ``_reasons``, empty for records that are fine by themselves."""
    text = flatten(bronze, source)
    typed = text.select(
        *[_typed(c, kind, zone).alias(c) for c, kind in source.columns.items()],
        *[F.col(c).isNotNull().alias(f"_given_{c}") for c, kind in source.columns.items() if kind != "string"],
        "_unreadable", "ingested_at_utc", "raw", *LINEAGE,
    )
    for name in source.statuses:
        typed = typed.withColumn(name, canonical(name, STATUS_ALIASES if name == "status" else None))
    rules = [(F.col("_unreadable"), "unreadable_record")]
    rules += [(F.col(f"_given_{c}") & F.col(c).isNull(), f"bad_{c}") for c, kind in source.columns.items() if kind != "string"]
    rules += [
        (F.col(c).isNull() & (~F.col(f"_given_{c}") if source.columns[c] != "string" else F.lit(True)), f"missing_{c}")
        for c in source.required
    ]
    rules += [(F.col(c) < 0, f"negative_{c}") for c in source.not_negative]
    return typed.select(*source.silver_columns, "ingested_at_utc", "raw", *LINEAGE, reasons(*rules).alias("_reasons"))


def mark_unknown(rows: DataFrame, orphans: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``unknown_<column>`` to the reasons of rows whose key is in ``orphans[column]``."""
    columns = rows.columns
    for column, unknown in orphans.items():
        found = unknown.select(F.col(column).alias("_unknown"))
        extra = F.array_compact(F.array(F.when(F.col("_unknown").isNotNull(), F.lit(f"unknown_{column}"))))
        rows = rows.join(found, F.col(column) == F.col("_unknown"), "left").withColumn(
            "_reasons", F.concat("_reasons", extra)
        ).select(*columns)
    return rows


def orphan_keys(facts: DataFrame, reference: Reference, target: DataFrame) -> DataFrame:
    """Keys of ``facts`` that the referenced table does not know, with their row counts.

    Facts are counted per key first, so a key carried by a third of all rows is one
    row in the anti join. The result is usually tiny, and marking the facts with it
    needs no shuffle of the facts when its size lets the planner broadcast it.
    """
    per_key = (
        facts.filter(F.col(reference.column).isNotNull())
        .groupBy(reference.column).agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = target.select(F.col(reference.target_column).alias(reference.column)).distinct()
    return per_key.join(known, reference.column, "left_anti")


def accepted(rows: DataFrame, source: Source) -> DataFrame:
    """Records without reasons, one per identity, with lineage."""
    return one_of_each(rows.filter(F.size("_reasons") == 0).drop("_reasons", "raw"), source)


def pending(rows: DataFrame) -> DataFrame:
    """Records refused only because a key they name is not known yet, as they were before that check."""
    waiting = (F.size("_reasons") > 0) & F.forall("_reasons", lambda r: r.startswith("unknown_"))
    return rows.filter(waiting).withColumn("_reasons", F.array().cast("array<string>"))


def one_of_each(good: DataFrame, source: Source) -> DataFrame:
    """One record per identity; other columns are carried along."""
    if not source.unique_by:
        return good
    tie = ["source_row_id"] if "source_row_id" in source.columns and "source_row_id" not in source.newest else []
    return latest_by(good, list(source.unique_by), list(source.newest), [*source.ties, *tie, "record_sha"])


def rejected(rows: DataFrame, table: str, source: Source) -> DataFrame:
    """One row per record and reason."""
    return rows.filter(F.size("_reasons") > 0).select(
        F.lit(table).alias("table_name"),
        F.col(source.record_id).cast("string").alias("record_id"),
        F.explode("_reasons").alias("reason"),
        "raw", *LINEAGE,
    )


# ---- the same rules over already typed tables ------------------------------
def item_rejects(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """(table, record, reason) for order items that silver refuses."""
    found = reasons((F.col("quantity") < 0, "negative_quantity"))
    marked = mark_unknown(
        items.select("order_item_id", "order_id", "product_id", found.alias("_reasons")),
        {
            "order_id": orphan_keys(items, Reference("order_id", "orders", "order_id"), orders),
            "product_id": orphan_keys(items, Reference("product_id", "products", "product_id"), products),
        },
    )
    return marked.select(
        F.lit("order_items").alias("table_name"), F.col("order_item_id").alias("record_id"), F.explode("_reasons").alias("reason")
    )


def clean_items(items: DataFrame) -> DataFrame:
    """Items silver keeps: no negative quantity, one row per item id."""
    good = items.filter((F.col("quantity") >= 0) & F.col("order_item_id").isNotNull())
    return latest_by(good, ["order_item_id"], [], ["source_row_id"])
