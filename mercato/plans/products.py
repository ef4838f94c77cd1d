"""product_daily: one row per product and business date.

Items are reduced to (order, product) once. After that an order counts once per
product, so "distinct orders" is a plain count, and four of the measures come from a
single aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.versions import in_force, in_turns, latest_by, segments, turn_of, version_on_day, version_on_dealt_day

GRAIN = ["product_id", "metric_date"]


def order_products(items: DataFrame) -> DataFrame:
    return (
        items.filter(F.col("product_id").isNotNull())
        .repartition("order_id")  # serves the reduction and the joins by order
        .groupBy("order_id", "product_id")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum(m.line_amount()).alias("gross"),
            F.sum("item_discount_amount").alias("discount"),
        )
    )


def sold(items: DataFrame, orders360: DataFrame) -> DataFrame:
    """(order, product) rows with the order's date and whether it was refunded."""
    facts = orders360.select("order_id", F.col("order_date").alias("metric_date"), m.has_refund().alias("refunded"))
    # Both sides are in partitions by order already, small enough to hash instead of sorting them.
    return order_products(items).join(facts.hint("shuffle_hash"), "order_id")


def product_sales_daily(items: DataFrame, orders360: DataFrame) -> DataFrame:
    return sold(items, orders360).groupBy(*GRAIN).agg(
        F.sum("units").alias("units_sold"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("gross").alias("gross_revenue"),
    )


def product_refund_units_daily(items: DataFrame, orders360: DataFrame) -> DataFrame:
    return sold(items, orders360).filter("refunded").groupBy(*GRAIN).agg(F.sum("units").alias("refunded_units"))


def product_discount_daily(items: DataFrame, orders360: DataFrame) -> DataFrame:
    return sold(items, orders360).groupBy(*GRAIN).agg(F.sum("discount").alias("discount_amount"))


def product_refund_daily(items: DataFrame, orders360: DataFrame) -> DataFrame:
    """The full item value of every refunded order, zero on other product days."""
    value = F.when(F.col("refunded"), F.col("gross")).otherwise(F.lit(0))
    return sold(items, orders360).groupBy(*GRAIN).agg(F.sum(value).alias("refund_amount"))


def _order_promotions_once(promotions: DataFrame) -> DataFrame:
    """Per order, its distinct promotions."""
    once = promotions.filter(F.col("promotion_id").isNotNull()).select("order_id", "promotion_id").repartition("order_id")
    return once.groupBy("order_id").agg(F.array_sort(F.collect_set("promotion_id")).alias("promotions"))


def product_promo_daily(items: DataFrame, orders360: DataFrame, promotions: DataFrame) -> DataFrame:
    pairs = items.filter(F.col("product_id").isNotNull()).select("order_id", "product_id").distinct()
    facts = orders360.select("order_id", F.col("order_date").alias("metric_date"))
    once = promotions.select("order_id", "promotion_id").distinct()
    return (
        pairs.join(facts, "order_id").join(once, "order_id", "left")
        .groupBy(*GRAIN).agg(F.count_distinct("promotion_id").alias("promotion_count"))
    )


def product_measures_daily(items: DataFrame, orders360: DataFrame, promotions: DataFrame) -> DataFrame:
    """All sales measures in one pass over the items.

    An order's promotions stay one array, so its lines are not multiplied by them. A product
    day keeps each different array once, before the shuffle too, and counts what they hold.
    """
    rows = sold(items, orders360).join(_order_promotions_once(promotions), "order_id", "left")
    refunded = F.col("refunded")
    sums = rows.groupBy(*GRAIN).agg(
        F.sum("units").alias("units_sold"),
        F.count(F.lit(1)).alias("order_count"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("discount").alias("discount_amount"),
        m.sum_if(refunded, "units").alias("refunded_units"),
        m.sum_if(refunded, "gross").alias("refund_amount"),
        F.collect_set("promotions").alias("_sets"),
    )
    return sums.withColumn("promotion_count", F.size(F.array_distinct(F.flatten("_sets"))).cast("bigint")).drop("_sets")


def product_inventory_daily(snapshots: DataFrame) -> DataFrame:
    """Stock of the product days, which hold a few counts each.

    So sums before the shuffle would shorten nothing, and would hold all product days a scan task reads.
    """
    return (
        snapshots.filter(F.col("product_id").isNotNull())
        .withColumn("metric_date", F.to_date("snapshot_date"))
        .repartition(*GRAIN)
        .groupBy(*GRAIN)
        .agg(
            F.sum("available_quantity").alias("available_inventory"),
            F.sum("reserved_quantity").alias("reserved_inventory"),
        )
    )


def product_stock_days(snapshots: DataFrame) -> DataFrame:
    """The stock part of product_daily: product days with a snapshot and their flag."""
    return product_inventory_daily(snapshots).withColumn("stockout_flag", m.stockout())


def category_versions(categories: DataFrame) -> DataFrame:
    return latest_by(categories, ["product_id", "valid_from_utc"], newest=["source_row_id"])


def _dated_versions(categories: DataFrame) -> DataFrame:
    return category_versions(categories).select(
        F.col("product_id").alias("_key"), F.to_date("valid_from_utc").alias("_start"),
        F.to_date("valid_to_utc").alias("_end"), "category_name",
    )


def product_grid(items: DataFrame, orders360: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Product days with a snapshot or a sale."""
    sales = (
        items.filter(F.col("product_id").isNotNull()).select("order_id", "product_id").distinct()
        .join(orders360.select("order_id", F.col("order_date").alias("metric_date")), "order_id")
    )
    days = snapshots.filter(F.col("product_id").isNotNull()).select(
        "product_id", F.to_date("snapshot_date").alias("metric_date")
    )
    return days.union(sales.select(*GRAIN)).distinct()


def category_on_days(days: DataFrame, categories: DataFrame) -> DataFrame:
    """``active_category`` of unique (product, day) rows; extra columns pass through."""
    return version_on_day(days, categories, "product_id", "metric_date", ["category_name"]).withColumnRenamed(
        "category_name", "active_category"
    )


def last_line_under_way(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Per return flag and range of days, the line ordered last among those ordered and not yet shipped.

    Each flag has a version per line, and most of them overlap.
    """
    versions = lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").withColumn(
        "line_no", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    under_way = segments(versions, "l_returnflag", ["l_orderkey", "l_linenumber"], start="o_orderdate", end="l_shipdate", tie="line_no")
    return under_way.select(
        F.col("_key").alias("return_flag"), F.col("_first").alias("first_day"), F.col("_until").alias("until_day"), "l_orderkey", "l_linenumber")


def category_on_snapshot_days(snapshots: DataFrame, categories: DataFrame) -> DataFrame:
    """As first written: snapshot days only, and overlapping versions give several rows."""
    days = product_inventory_daily(snapshots).select(*GRAIN)
    versions = _dated_versions(categories)
    matches = (F.col("product_id") == F.col("_key")) & in_force(F.col("metric_date"), F.col("_start"), F.col("_end"))
    # Shuffled: the planner would broadcast by the size of the file, which says little of the versions made from it.
    return days.join(versions.hint("shuffle_hash"), matches, "left").select(*GRAIN, "category_name")


def _day_measures() -> list:
    return [
        m.or_zero("units_sold").alias("units_sold"),
        m.or_zero("order_count").alias("order_count"),
        m.or_zero("gross_revenue").alias("gross_revenue"),
        (m.or_zero("gross_revenue") - m.or_zero("discount_amount") - m.or_zero("refund_amount")).alias("net_revenue"),
        m.or_zero("refunded_units").alias("refunded_units"),
        F.col("available_inventory"),
        F.col("reserved_inventory"),
        m.stockout().alias("stockout_flag"),
        m.or_zero("promotion_count").alias("promotion_count"),
    ]


def product_day_facts(items: DataFrame, orders360: DataFrame, promotions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """product_daily without the category: measures full-joined with stock.

    The full join of two aggregates on the same key *is* the grid; no union of keys,
    no extra distinct. The keys come from the stock wherever a day was counted, so that a
    question about counted days alone drops the join and all sales behind it.
    """
    measures = product_measures_daily(items, orders360, promotions).withColumnsRenamed({c: f"_{c}" for c in GRAIN})
    stock = product_inventory_daily(snapshots).withColumn("_counted", F.lit(True))
    same_day = [F.col(c) == F.col(f"_{c}") for c in GRAIN]
    return stock.join(measures.hint("shuffle_hash"), same_day, "full").select(
        *[F.when(F.col("_counted").isNotNull(), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in GRAIN], *_day_measures()
    )


def product_days_dealt(items: DataFrame, orders360: DataFrame, promotions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The rows of ``product_day_facts``, in partitions by product and ``_turn`` of the day, with ``_counted``.

    Sales and stock counts are one feed that is dealt before anything is summed, so a product
    day's sums, which are wider than what they sum, never move. As partitions do not depend on
    the day itself, categories come to the days. An order's promotions travel as one string.
    """
    apart = F.transform("promotions", lambda x: F.replace(F.replace(x, F.lit("~"), F.lit("~0")), F.lit(","), F.lit("~1")))
    joined = _order_promotions_once(promotions).withColumn("promotions", F.array_join(apart, ","))
    sales = sold(items, orders360).join(joined, "order_id", "left").drop("order_id").withColumn("_counted", F.lit(False))
    counts = snapshots.filter(F.col("product_id").isNotNull()).select(
        "product_id", F.to_date("snapshot_date").alias("metric_date"), "available_quantity", "reserved_quantity", F.lit(True).alias("_counted"))
    rows = sales.unionByName(counts, allowMissingColumns=True).withColumn("_turn", turn_of("metric_date")).repartition("product_id", "_turn")
    # Without a date, sales and counts stay apart, as NULL is no day they share.
    undated = F.when(F.col("metric_date").isNull(), F.col("_counted")).alias("_undated")
    refunded = F.col("refunded")
    days = rows.groupBy(*GRAIN, "_turn", undated).agg(
        F.sum("units").alias("units_sold"),
        F.count_if(~F.col("_counted")).alias("order_count"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("discount").alias("discount_amount"),
        m.sum_if(refunded, "units").alias("refunded_units"),
        m.sum_if(refunded, "gross").alias("refund_amount"),
        F.collect_set("promotions").alias("_sets"),
        F.sum("available_quantity").alias("available_inventory"),
        F.sum("reserved_quantity").alias("reserved_inventory"),
        F.bool_or("_counted").alias("_counted"),
    )
    ids = F.array_distinct(F.flatten(F.transform("_sets", lambda x: F.split(x, ","))))
    return days.withColumn("promotion_count", F.size(ids).cast("bigint")).select(*GRAIN, *_day_measures(), "_turn", "_counted")


def _with_category(days: DataFrame) -> DataFrame:
    own = (*GRAIN, "active_category", "_turn", "_counted")
    return days.select(*GRAIN, "active_category", *[c for c in days.columns if c not in own])


def product_daily(
    items: DataFrame, orders360: DataFrame, promotions: DataFrame, snapshots: DataFrame, categories: DataFrame
) -> DataFrame:
    days = product_days_dealt(items, orders360, promotions, snapshots)
    known = version_on_dealt_day(days, categories, "product_id", "metric_date", "_turn", ["category_name"])
    return _with_category(known.withColumnRenamed("category_name", "active_category"))


def product_daily_as_first_written(
    items: DataFrame, orders360: DataFrame, promotions: DataFrame, snapshots: DataFrame, categories: DataFrame
) -> DataFrame:
    """Same measures, but the category is known on snapshot days only, and overlapping versions give several rows."""
    days = product_days_dealt(items, orders360, promotions, snapshots)
    versions = in_turns(_dated_versions(categories), "_start", "_end", "_turn_of_range")
    matches = (F.col("product_id") == F.col("_key")) & (F.col("_turn") == F.col("_turn_of_range")) & F.col("_counted") & in_force(
        F.col("metric_date"), F.col("_start"), F.col("_end"))
    known = days.join(versions.hint("shuffle_hash"), matches, "left").select(*days.columns, F.col("category_name").alias("active_category"))
    return _with_category(known)
