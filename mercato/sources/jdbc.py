"""Relational source and sink. Needs the database's JDBC driver on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, split_on: str, lowest, highest, splits: int, **options: str
) -> DataFrame:
    """Parallel read: ``splits`` range queries on a numeric, date or timestamp column."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=split_on, lowerBound=str(lowest), upperBound=str(highest),
        numPartitions=str(splits), fetchsize="10000",
    )
    return reader.options(**options).load()


def write_table(df: DataFrame, url: str, table: str, writers: int = 16, **options: str) -> None:
    """Full replacement that keeps the table definition; at most ``writers`` connections."""
    target = df.coalesce(writers).write.format("jdbc").mode("overwrite")
    target.options(url=url, dbtable=table, truncate="true", batchsize="10000", **options).save()
