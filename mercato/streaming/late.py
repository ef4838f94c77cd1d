"""Event ingest that loses nothing: what comes after the watermark goes to a table of its own.

Each batch is compared with the watermark that held when it began, the newest event time
of all earlier batches less ``delay``, which is also the watermark the query reports. Rows
older than that, and rows without a time, are late. Both kinds are stored once:

    out/ontime/batch_id=N/period=P    events in time
    out/late/batch_id=N/period=P      late ones
    out/watermark/batch_id=N          the newest event time up to batch N

Copies of an event have its id and lie within ``delay`` of it; a row without an id is told
by all its values. A batch looks for stored copies only in the periods its own rows can
have copies in, by id, so it costs what it holds and what those periods hold, however long
the feed has run. Every folder belongs to one batch: a batch that is run again replaces its
own folders and ignores them when it looks for copies, so a lost driver costs nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.versions import latest_by
from .events import EVENT_SCHEMA, read_events

ONTIME, LATE = "ontime", "late"
TIME = "occurred_at_utc"
_STORED = f"{EVENT_SCHEMA}, batch_id bigint, period date"
_COLUMNS = [c.strip().split(" ")[0] for c in EVENT_SCHEMA.replace("decimal(14,2)", "decimal").split(",")]


def _period(at: Column, period: str) -> Column:
    return F.to_date(F.date_trunc(period, at))


def _identity() -> Column:
    """The id, or the values of a row that has none; the two cannot meet."""
    values = F.to_json(F.struct(*_COLUMNS))
    return F.when(F.col("event_id").isNotNull(), F.concat(F.lit("i"), "event_id")).otherwise(F.concat(F.lit("r"), F.sha2(values, 256)))


def stored(spark: SparkSession, out: str, kind: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(f"{out}/{kind}")


def all_events(spark: SparkSession, out: str) -> DataFrame:
    """Every event that ever arrived, once, with ``late``."""
    return stored(spark, out, ONTIME).withColumn("late", F.lit(False)).unionByName(stored(spark, out, LATE).withColumn("late", F.lit(True)))


def _watermark_before(spark: SparkSession, out: str, batch_id: int):
    """Newest event time of all batches before this one, or None."""
    if batch_id == 0:
        return None
    return spark.read.schema("newest timestamp").parquet(f"{out}/watermark/batch_id={batch_id - 1}").head()["newest"]


def _save(batch: DataFrame, batch_id: int, out: str, delay: str, period: str) -> None:
    spark = batch.sparkSession
    before = _watermark_before(spark, out, batch_id)
    # Spark's watermark has milliseconds
    watermark = F.date_trunc("millisecond", F.lit(before).cast("timestamp")) - F.expr(f"interval {delay}")
    batch = batch.persist()
    try:
        rows = latest_by(batch.withColumn("_identity", _identity()), ["_identity"], [], [TIME, *[c for c in _COLUMNS if c != TIME]])
        reach = F.expr(f"sequence(to_date(date_trunc('{period}', {TIME} - interval {delay})), to_date(date_trunc('{period}', {TIME} + interval {delay})), interval 1 {period})")
        periods = [r["p"] for r in batch.select(F.explode(reach).alias("p")).distinct().collect()]  # dates
        near = F.col("period").isNull() | F.col("period").isin(periods) if periods else F.col("period").isNull()
        candidates = stored(spark, out, ONTIME).unionByName(stored(spark, out, LATE)).filter(near & (F.col("batch_id") != batch_id))
        named = candidates.select(_identity().alias("_identity"), F.col(TIME).alias("_at"))
        # The batch is the small side: stored ids are first cut down to those the batch asks for.
        known = named.join(rows.select("_identity"), "_identity", "left_semi").dropDuplicates(["_identity", "_at"])
        close = F.col("_at").eqNullSafe(F.col(TIME)) | (F.col("_at").between(F.col(TIME) - F.expr(f"interval {delay}"), F.col(TIME) + F.expr(f"interval {delay}")))
        new = rows.join(known.withColumnRenamed("_identity", "_known"), (F.col("_identity") == F.col("_known")) & close, "left_anti")
        is_late = F.col(TIME).isNull() | F.coalesce(F.col(TIME) < watermark, F.lit(False))
        new = new.select(*_COLUMNS, _period(F.col(TIME), period).alias("period"), is_late.alias("_late")).persist()
        for kind, wanted in ((ONTIME, ~F.col("_late")), (LATE, F.col("_late"))):
            new.filter(wanted).drop("_late").write.mode("overwrite").partitionBy("period").parquet(f"{out}/{kind}/batch_id={batch_id}")
        newest = batch.agg(F.greatest(F.max(TIME), F.lit(before).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{out}/watermark/batch_id={batch_id}")
        new.unpersist()
    finally:
        batch.unpersist()


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, delay: str = "7 days", period: str = "day",
           files_per_batch: int | None = None):
    """Store every event of ``folder`` once, in time or late; ``period`` (day, week, month, year) lays the tables out."""
    for kind in (ONTIME, LATE):  # so that the first batch finds tables
        spark.createDataFrame([], EVENT_SCHEMA).write.mode("ignore").parquet(f"{out}/{kind}/batch_id=-1/period=__HIVE_DEFAULT_PARTITION__")

    def save(batch: DataFrame, batch_id: int) -> None:
        _save(batch, batch_id, out, delay, period)

    events = read_events(spark, folder, files_per_batch).withWatermark(TIME, delay)
    return events.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
