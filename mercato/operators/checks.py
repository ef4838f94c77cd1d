"""Generic data checks; each reads its input once and returns a small frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import ratio
from ..sources.scratch import written


def grain(df: DataFrame, keys: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys, duplicates and rows with a NULL in a required column.

    Two levels: rows per key, then totals. The distinct count never gathers keys in
    one place, and NULL key parts count as values.
    """
    broken = F.lit(False)
    for name in required or keys:
        broken = broken | F.col(name).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(broken).alias("_null"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("unique_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_null"), F.lit(0)).alias("null_rows"),
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of NULLs of every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def duplicates(df: DataFrame, keys: Sequence[str], count_as: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)


def rule_counts(df: DataFrame, **broken: Column) -> DataFrame:
    """One row with the number of rows that break each rule."""
    return df.agg(*[F.count_if(rule).alias(name) for name, rule in broken.items()])


def members(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other`` (ids never travel through the driver)."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def non_members(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_anti")


def compare_totals(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put two one-row aggregates side by side."""
    return left.crossJoin(right)


def full_difference(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str, right_value: str, only_different: bool = True
) -> DataFrame:
    """Full outer comparison of two values on their keys; a missing side is zero."""
    a = left.select(*[F.col(k).alias(f"_l_{k}") for k in keys], F.col(left_value).alias("_left"))
    b = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(right_value).alias("_right"))
    on = [F.col(f"_l_{k}") == F.col(f"_r_{k}") for k in keys]
    zero = F.lit(0)
    joined = a.join(b, on, "full").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        F.coalesce("_left", zero).alias(left_value),
        F.coalesce("_right", zero).alias(right_value),
        (F.coalesce("_left", zero) - F.coalesce("_right", zero)).alias("difference"),
    )
    return joined.filter(F.col("difference") != 0) if only_different else joined


def column_class(field: T.StructField) -> str:
    """date, numeric or categorical, by type or by a telling column name."""
    name, kind = field.name.lower(), field.dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) or "date" in name or "time" in name:
        return "date"
    return "numeric" if isinstance(kind, T.NumericType) else "categorical"


def profile_columns(df: DataFrame) -> DataFrame:
    """Rows, non-NULL values and distinct values per column.

    Columns are turned into (name, value) rows and counted per value, so the distinct
    count is exact and each column's values are spread over all tasks.
    """
    pairs = [F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).cast("string").alias("value")) for f in df.schema.fields]
    classes = [x for f in df.schema.fields for x in (F.lit(f.name), F.lit(column_class(f)))]
    per_value = (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    result = per_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("value_count"),
        F.count("value").alias("distinct_count"),
    )
    return result.withColumn(
        "column_class",
        F.when(F.col("value_count") == 0, "categorical").otherwise(F.create_map(*classes)[F.col("column_name")]),
    )


def exact_profile(df: DataFrame, columns: Sequence[str], width: int = 1000) -> DataFrame:
    """count, mean, stddev, min, exact quartiles and max of numeric columns.

    Quartiles interpolate like ``percentile``, but that aggregate would gather every
    distinct value in one buffer. Here values are counted per bucket of ``width``
    units, the buckets holding the wanted ranks are found from running totals, and
    only those buckets are opened, each in its own task group. The counted values are
    written, so ``df`` is computed once.
    """
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("decimal(20,2)").alias("x")) for c in columns]
    values = written(
        df.select(F.inline(F.array(*pairs))).filter(F.col("x").isNotNull())
        .groupBy("metric", "x").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.floor(F.col("x") / width).cast("bigint")), "profile-values")
    x, n = F.col("x"), F.col("n")
    basics = values.groupBy("metric").agg(
        F.sum("n").alias("count"),
        F.sum(x * n).alias("_sum"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    buckets = _before(values.groupBy("metric", "bucket").agg(F.sum("n").alias("n")), ["metric"], "bucket")
    # one row per metric, wanted rank and share of that rank
    quarter = F.explode(F.array(*[F.struct(F.lit(l).alias("label"), F.lit(p).alias("p")) for l, p in
                                  (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]))
    wanted = basics.select("metric", "count", quarter.alias("q")).select(
        F.col("metric").alias("w_metric"), "q.label", (F.col("q.p") * (F.col("count") - 1)).alias("position")
    )
    low = F.floor("position").cast("bigint")
    high = F.ceil("position").cast("bigint")
    ranks = wanted.select(
        "w_metric", "label", (F.col("position") - F.floor("position")).alias("share"),
        F.explode(F.array(F.struct(low.alias("rank"), F.lit("low").alias("side")),
                          F.struct(high.alias("rank"), F.lit("high").alias("side")))).alias("r"),
    ).select("w_metric", "label", "share", "r.rank", "r.side")

    def holds(metric: str) -> Column:
        return (F.col(metric) == F.col("w_metric")) & (F.col("_before") <= F.col("rank")) & (
            F.col("rank") < F.col("_before") + F.col("n"))

    chosen = buckets.join(ranks, holds("metric")).select(
        F.col("metric").alias("w_metric"), F.col("bucket").alias("w_bucket"), "label", "share", "side",
        (F.col("rank") - F.col("_before")).alias("rank"),
    )
    opened = values.join(
        chosen.select(F.col("w_metric").alias("metric"), F.col("w_bucket").alias("bucket")).distinct(), ["metric", "bucket"], "left_semi"
    )
    inside = _before(opened, ["metric", "bucket"], "x")
    picked = inside.join(chosen, holds("metric") & (F.col("bucket") == F.col("w_bucket")))
    quartiles = (
        picked.groupBy("w_metric", "label")
        .agg(
            F.max(F.when(F.col("side") == "low", x)).cast("double").alias("lo"),
            F.max(F.when(F.col("side") == "high", x)).cast("double").alias("hi"),
            F.max("share").alias("share"),
        )
        .withColumn("value", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("share"))
        .groupBy("w_metric").pivot("label", ["q25", "q50", "q75"]).agg(F.max("value"))
    )
    # Squares of distances to the mean: sums of squares of large values would cancel.
    means = basics.select(F.col("metric").alias("s_metric"), (F.col("_sum").cast("double") / F.col("count")).alias("_mean"))
    away = x.cast("double") - F.col("_mean")
    spreads = values.join(F.broadcast(means), F.col("metric") == F.col("s_metric")).groupBy("s_metric").agg(F.sum(away * away * n).alias("_away"))
    spread = F.sqrt(F.col("_away") / (F.col("count") - 1))
    return basics.join(quartiles, basics["metric"] == quartiles["w_metric"]).join(spreads, basics["metric"] == spreads["s_metric"]).select(
        "metric", F.col("count").cast("bigint").alias("count"),
        ratio("_sum", "count").alias("mean"), F.when(F.col("count") > 1, spread).alias("stddev"),
        F.col("min").cast("double").alias("min"), "q25", "q50", "q75", F.col("max").cast("double").alias("max"),
    )


def _before(counts: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("n").over(w), F.lit(0)))
