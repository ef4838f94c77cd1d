"""Written layers: one folder per run, published by appending one record."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import gold_contract


_FOLDER = "_folder"


def folder_of(day: str | Column, period: str) -> Column:
    """First date of the period a day lies in."""
    return F.to_date(F.date_trunc(period, day))


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: list[str | None] = []  # the setting as each write under way found it
_lock = threading.Lock()


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go with the write.

    Else they stay until the driver collects the garbage that names them, so a run's disk would
    grow with the number of its tables. Tables are written side by side; the last puts the setting back.
    """
    with _lock:
        _writing.append(spark.conf.get(_DROP_SHUFFLES, None) if not _writing else _writing[0])
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _lock:
            before = _writing.pop()
            if not _writing:
                spark.conf.unset(_DROP_SHUFFLES) if before is None else spark.conf.set(_DROP_SHUFFLES, before)


class LayerStore:
    """Tables of one attempt of a run under ``root/runs/<run_id>/<attempt>/<layer>/<table>``.

    Every attempt has a folder of its own, so a failed run, or one repeated under the
    same id, cannot damage what readers see; ``publish`` makes the attempt current.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str, attempt: str | None = None, period: str = "day"):
        self.spark, self.root, self.run_id, self.period = spark, root.rstrip("/"), run_id, period
        self.attempt = attempt or uuid.uuid4().hex

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/runs/{self.run_id}/{self.attempt}/{layer}/{table}"

    def write(self, df: DataFrame, layer: str, table: str, by_date: str | None = None, in_two: bool = False) -> DataFrame:
        """Full replacement of one table; returns it read back, with its lineage cut.

        ``by_date`` lays the table out in one folder per date, or per month or year where the
        store's ``period`` says so (long histories of small days); the rebalance keeps files
        large and splits a heavy folder over several writers. ``in_two`` writes the rows as they come
        first, so that what was shuffled for them is gone when they are shuffled by folder.
        """
        target = self.path(layer, table)
        if by_date and in_two:
            unsorted = self.write(df, f"{layer}_unsorted", table)
            laid_out = self.write(unsorted, layer, table, by_date)
            at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(f"{layer}_unsorted", table))
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
            return laid_out
        if by_date and self.period != "day":
            df, by_date = df.withColumn(_FOLDER, folder_of(by_date, self.period)), _FOLDER
        writer = df.hint("rebalance", by_date).write.partitionBy(by_date) if by_date else df.write
        with _shuffles_dropped(self.spark):
            writer.mode("overwrite").parquet(target)
        return self.read(layer, table, df.schema)

    def read_gold(self, name: str) -> DataFrame:
        """A gold table with ``_folder``, the date its rows' folder begins with; a filter on that reads those folders alone."""
        table = gold_contract()[name]
        rows = self.spark.read.schema(table.schema).parquet(self.path("gold", name))
        folder = F.col(_FOLDER) if _FOLDER in rows.columns else F.col(table.date) if self.period == "day" else folder_of(table.date, self.period)
        return rows.select(*table.schema.fieldNames(), folder.alias(_FOLDER))

    def read(self, layer: str, table: str, schema=None) -> DataFrame:
        if schema is None:
            return self.spark.read.parquet(self.path(layer, table))
        return self.spark.read.schema(schema).parquet(self.path(layer, table)).select(*schema.fieldNames())

    def publish(self, at, chain: list[tuple[str, str, list[str] | None]] | None = None) -> None:
        """Make this attempt current. ``chain`` names the attempts an incremental one builds on, itself last."""
        record = self.spark.createDataFrame(
            [(self.run_id, self.attempt, at, self.period, chain)], f"run_id string, attempt string, published_at timestamp, period string, {_CHAIN}")
        record.coalesce(1).write.mode("append").json(f"{self.root}/published")

    def append_ops(self, rows: list[tuple]) -> None:
        columns = "run_id string, stage string, status string, started_at timestamp, finished_at timestamp, row_count bigint, error string"
        self.spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(f"{self.root}/ops/runs")


_CHAIN = "chain array<struct<run_id:string,attempt:string,sources:array<string>>>"


@dataclass(frozen=True)
class Published:
    """What is published: the attempts it consists of and how its folders are cut.

    ``chain`` has (run_id, attempt, sources) of the full attempt and of each incremental one
    on it; ``sources`` names the feeds an incremental attempt brought, None a full attempt.
    """

    chain: list[tuple[str, str, list[str] | None]]
    period: str

    def stores(self, spark: SparkSession, root: str) -> list[LayerStore]:
        return [LayerStore(spark, root, run_id, attempt, self.period) for run_id, attempt, _ in self.chain]


def published_state(spark: SparkSession, root: str, run_id: str | None = None) -> Published | None:
    last = published(spark, root, run_id)
    if last is None:
        return None
    log = spark.read.schema(f"run_id string, attempt string, period string, {_CHAIN}").json(f"{root.rstrip('/')}/published")
    row = log.filter((F.col("run_id") == last[0]) & (F.col("attempt") == last[1])).head()
    return Published([tuple(c) for c in row["chain"]] if row["chain"] else [(*last, None)], row["period"] or "day")


def gold_table(spark: SparkSession, root: str, state: Published, name: str) -> DataFrame:
    """One gold table, with ``_folder``, as the attempts hold it together.

    An incremental attempt writes the folders it changed, and a list of which attempt holds
    which folder. Folders are partition values, so each attempt is read for its own alone.
    """
    last = state.stores(spark, root)[-1]
    if state.chain[-1][2] is None or not gold_contract()[name].by_date:
        return last.read_gold(name)
    held: dict[tuple[str, str], list] = {}
    for part in last.read("gold_parts", name).collect():  # one row per folder
        held.setdefault((part["run_id"], part["attempt"]), []).append(part["folder"])
    parts = [LayerStore(spark, root, *k, state.period).read_gold(name).filter(F.col(_FOLDER).isin(folders)) for k, folders in sorted(held.items())]
    return reduce(DataFrame.unionByName, parts) if parts else last.read_gold(name)


def gold_parts(spark: SparkSession, root: str, state: Published, name: str) -> DataFrame:
    """(folder, run_id, attempt) of every folder of a gold table."""
    last = state.stores(spark, root)[-1]
    if state.chain[-1][2] is not None:
        return last.read("gold_parts", name)
    folders = last.read_gold(name).select(F.col(_FOLDER).alias("folder")).distinct()
    return folders.select("folder", F.lit(last.run_id).alias("run_id"), F.lit(last.attempt).alias("attempt"))


def published(spark: SparkSession, root: str, run_id: str | None = None) -> tuple[str, str] | None:
    """Run id and attempt published last, of all runs or of one."""
    log = spark.read.schema("run_id string, attempt string, published_at timestamp").json(f"{root.rstrip('/')}/published")
    log = log.filter(F.col("run_id") == run_id) if run_id else log
    last = log.agg(F.max(F.struct("published_at", "run_id", "attempt")).alias("last")).head()["last"]
    return (last["run_id"], last["attempt"]) if last else None


def current_run(spark: SparkSession, root: str) -> str | None:
    """The run id published last."""
    last = published(spark, root)
    return last[0] if last else None


def ops_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/ops/runs")


class GoldTables:
    """The five published gold tables as attributes, for ``questions.answer``."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self._state = published_state(spark, root, run_id)
        if self._state is None:
            raise LookupError(f"nothing published under {root}" + (f" as {run_id}" if run_id else ""))
        self._spark, self._root, self._contract = spark, root, gold_contract()

    def __getattr__(self, table: str) -> DataFrame:
        if table not in self._contract:
            raise AttributeError(table)
        return gold_table(self._spark, self._root, self._state, table).drop(_FOLDER)
