"""Shared scratch folder for written intermediates and streaming state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a
    cluster executors cannot see one another's disks, so its absence is an error.
    """
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="mercato-")
    spark.conf.set(_SETTING, made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path no other job uses; nothing is created yet."""
    return f"{shared_dir(spark)}/mercato/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut, readable by every executor; ``options`` go to the writer."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
