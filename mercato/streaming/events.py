"""Two streaming jobs over folders of payment-event files.

``deduplicate`` is for feeds whose lateness is bounded: its state is bounded by the
watermark, and an event later than the delay is dropped. ``upsert_status`` accepts any
lateness: each batch adds one small folder, and readers take the newest event per
order, which gives the same answer for any order of arrival or repetition of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "event_id string, event_type string, occurred_at_utc timestamp, order_id string, payment_id string, amount decimal(14,2)"
)
LATEST = "order_id string, occurred_at_utc timestamp, event_id string, event_type string"


def read_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def deduplicate(spark: SparkSession, folder: str, out: str, checkpoint: str, delay: str = "7 days",
                files_per_batch: int | None = None):
    """Append each event once; copies within ``delay`` of one another are dropped."""
    events = read_events(spark, folder, files_per_batch)
    once = events.withWatermark("occurred_at_utc", delay).dropDuplicatesWithinWatermark(["event_id"])
    return (
        once.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _newest_per_order(events: DataFrame) -> DataFrame:
    newest = F.max(F.struct("occurred_at_utc", "event_id", "event_type"))
    return events.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(newest.alias("e")).select("order_id", "e.*")


def upsert_status(spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int | None = None):
    """Write the newest event per order of every batch to its own folder.

    A repeated batch overwrites its own folder only, so the job is idempotent, and a
    batch costs what it holds, not what has been stored before.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        _newest_per_order(batch).write.mode("overwrite").parquet(f"{out}/changes/batch_id={batch_id}")

    return (
        read_events(spark, folder, files_per_batch).writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _stored(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(LATEST).parquet(f"{out}/changes")


def current_status(spark: SparkSession, out: str) -> DataFrame:
    """The status of every order after all batches so far."""
    return _newest_per_order(_stored(spark, out)).select("order_id", F.col("event_type").alias("payment_status"))


def compact(spark: SparkSession, out: str, target: str) -> None:
    """Fold all batches into one new folder that can start the next generation."""
    _newest_per_order(_stored(spark, out)).write.mode("errorifexists").parquet(f"{target}/changes/batch_id=-1")
