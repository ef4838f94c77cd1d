"""Bronze: every raw record unchanged, with its lineage. No joins, no de-duplication."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import record_sha
from ..schemas import Source
from ..sources.raw import raw_records


def with_lineage(records: DataFrame, source: Source, run_id: str, loaded_at: datetime) -> DataFrame:
    """Add identity, checksum, run and load time to the raw records."""
    return records.select(
        "raw",
        "file_name",
        "row_number",
        F.get_json_object("raw", f"$.{source.record_id}").alias("record_id"),
        record_sha("raw").alias("record_sha"),
        F.lit(run_id).alias("run_id"),
        F.lit(loaded_at).cast("timestamp").alias("timestamp"),
    )


def bronze_table(
    spark: SparkSession, raw_dir: str, source: Source, run_id: str, loaded_at: datetime, layout: str | None = None
) -> DataFrame:
    path = f"{raw_dir.rstrip('/')}/{source.path}"
    return with_lineage(raw_records(spark, path, source, layout), source, run_id, loaded_at)


def raw_payload(df: DataFrame) -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("raw"))
