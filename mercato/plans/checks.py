"""Reconciliation and business-rule checks over silver events and gold facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators import checks as c
from ..operators.versions import in_force_closed, latest_by
from . import orders as o


# ---- order_360 -----------------------------------------------------------
def net_revenue_mismatch(orders360: DataFrame) -> DataFrame:
    return c.rule_counts(orders360, mismatch_count=~F.col("net_revenue").eqNullSafe(m.net_revenue()))


def payment_anomaly() -> Column:
    status, amount = F.col("payment_status"), F.col("captured_payment_amount")
    return (amount < 0) | ((status == m.CAPTURED) & (amount <= 0)) | ((status == m.AUTHORIZED) & (amount > 0))


def payment_anomalies(orders360: DataFrame) -> DataFrame:
    return orders360.filter(payment_anomaly()).select("order_id", "payment_status", "captured_payment_amount", "net_revenue")


def payments_of_anomalies(payments: DataFrame, orders360: DataFrame) -> DataFrame:
    events = payments.select("order_id", "event_id", "event_type", F.col("amount").alias("payment_amount"), "occurred_at_utc")
    return c.members(events, payment_anomalies(orders360), "order_id")


def payment_status_split(orders360: DataFrame) -> DataFrame:
    amount = F.col("captured_payment_amount")
    return orders360.groupBy("payment_status").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(amount > 0).alias("orders_with_payment"),
        F.count_if(amount == 0).alias("orders_without_payment"),
    )


def payment_amount_by_status(orders360: DataFrame) -> DataFrame:
    amount = "captured_payment_amount"
    return orders360.groupBy("payment_status").agg(
        F.count(amount).alias("n"), F.min(amount).alias("smallest"), F.max(amount).alias("largest"),
        m.mean(amount).alias("average"),
    )


def negative_refunds(orders360: DataFrame) -> DataFrame:
    return c.rule_counts(orders360, negative_refund_orders=F.col("refunded_amount") < 0)


def negative_net_orders(orders360: DataFrame) -> DataFrame:
    before = m.revenue_before_refund()
    return orders360.filter(F.col("net_revenue") < 0).select(
        "order_id", "gross_merchandise_value", "discount_amount", "shipping_revenue",
        before.alias("revenue_before_refund"), "refunded_amount", "net_revenue",
        "order_status", "payment_status", "return_status",
        (F.col("refunded_amount") > before).alias("refund_exceeds_revenue"),
    )


def negative_net_by_return(orders360: DataFrame) -> DataFrame:
    return negative_net_orders(orders360).groupBy("return_status", "refund_exceeds_revenue").agg(
        F.count(F.lit(1)).alias("orders")
    )


def neg_orders_with_refund(orders360: DataFrame, refunds: DataFrame) -> DataFrame:
    return c.members(negative_net_orders(orders360), refunds, "order_id").select("order_id", "net_revenue")


def neg_orders_without_refund(orders360: DataFrame, refunds: DataFrame) -> DataFrame:
    return c.non_members(negative_net_orders(orders360), refunds, "order_id").select("order_id", "net_revenue")


def cancelled_but_captured(orders360: DataFrame) -> DataFrame:
    return orders360.filter((F.col("order_status") == "CANCELLED") & (F.col("captured_payment_amount") > 0)).select(
        "order_id", "customer_id", "captured_payment_amount", "payment_status"
    )


def return_status_mismatch(orders360: DataFrame, returns: DataFrame) -> DataFrame:
    """Latest return event by window against the aggregated status in the fact."""
    latest = latest_by(returns, ["order_id"], newest=["occurred_at_utc", "event_id", "event_type"])
    both = latest.select("order_id", F.col("event_type").alias("silver_status")).join(
        orders360.select("order_id", "return_status"), "order_id", "left"
    )
    known = F.coalesce("return_status", F.lit(m.NO_RETURN))
    return both.agg(
        F.count(F.lit(1)).alias("orders_with_return"), F.count_if(F.col("silver_status") != known).alias("mismatch_count")
    )


def first_order_check(orders360: DataFrame, orders: DataFrame) -> DataFrame:
    """First orders equal customers, and the flag agrees with the full ranking."""
    ranks = o.customer_order_rank(orders).select("order_id", "customer_order_rank")
    joined = orders360.select("order_id", "customer_id", "first_order_flag").join(ranks, "order_id")
    per_customer = joined.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("customer_order_rank") == 1).alias("first"),
        F.count_if(F.col("first_order_flag") != (F.col("customer_order_rank") == 1)).alias("wrong"),
    )
    return per_customer.agg(
        F.sum("n").alias("total_orders"), F.count("customer_id").alias("unique_customers"),
        F.sum("first").alias("first_orders"), F.sum("wrong").alias("first_order_mismatch"),
    )


# ---- refunds and payments against silver ---------------------------------
def refund_total_recon(orders360: DataFrame, refunds: DataFrame) -> DataFrame:
    silver = o.refund_dedup_max(refunds).agg(F.sum("amount").alias("silver_refund_total"))
    gold = orders360.agg(F.sum("refunded_amount").alias("gold_refund_total"))
    return c.compare_totals(silver, gold).withColumn(
        "difference", F.col("silver_refund_total") - F.col("gold_refund_total")
    )


def refund_recon_by_id(by_refund_id: DataFrame, enriched: DataFrame) -> DataFrame:
    silver = by_refund_id.agg(F.sum("amount").alias("deduplicated_refund_total"))
    gold = enriched.agg(F.sum("refund_amount").alias("enriched_refund_total"))
    return c.compare_totals(silver, gold).withColumn(
        "difference", F.col("deduplicated_refund_total") - F.col("enriched_refund_total")
    )


def refund_raw_vs_dedup(refunds: DataFrame) -> DataFrame:
    """Orders whose plain refund sum differs from the de-duplicated one; one pass."""
    done = refunds.filter(F.col("event_type") == m.REFUND_DONE)
    per_refund = done.groupBy("order_id", "refund_id").agg(F.sum("amount").alias("raw"), F.max("amount").alias("kept"))
    totals = per_refund.groupBy("order_id").agg(
        F.sum("raw").alias("raw_refunded_amount"), F.sum("kept").alias("deduplicated_refunded_amount")
    )
    return totals.withColumn(
        "difference", F.col("raw_refunded_amount") - F.col("deduplicated_refunded_amount")
    ).filter(F.col("difference") != 0)


def refund_duplicates(refunds: DataFrame) -> DataFrame:
    done = refunds.filter(F.col("event_type") == m.REFUND_DONE)
    return c.duplicates(done, ["refund_id", "order_id", "event_type", "amount", "occurred_at_utc"], "duplicate_count")


def refund_duplicate_impact(refunds: DataFrame) -> DataFrame:
    extra = F.col("amount") * (F.col("duplicate_count") - 1)
    return refund_duplicates(refunds).agg(F.sum(extra).alias("duplicate_amount"))


def payment_recon_silver(orders360: DataFrame, payments: DataFrame, deduplicate: bool = True) -> DataFrame:
    """Orders whose captured amount differs from the silver captures."""
    captured = payments.filter(F.col("event_type") == m.CAPTURED).select("event_id", "order_id", "amount")
    if deduplicate:
        captured = captured.distinct()
    silver = captured.groupBy("order_id").agg(F.sum("amount").alias("silver_captured_payment"))
    both = orders360.select("order_id", "captured_payment_amount").join(silver, "order_id", "left").select(
        "order_id", "captured_payment_amount", m.or_zero("silver_captured_payment").alias("silver_captured_payment")
    )
    gap = F.col("captured_payment_amount") - F.col("silver_captured_payment")
    return both.withColumn("difference", gap).filter(F.col("difference") != 0)


def multi_capture_orders(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("event_type") == m.CAPTURED).groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("captured_event_count"), F.sum("amount").alias("captured_amount"))
        .filter(F.col("captured_event_count") > 1)
    )


def multi_refund_orders(refunds: DataFrame) -> DataFrame:
    return (
        refunds.filter(F.col("event_type") == m.REFUND_DONE).groupBy("order_id")
        .agg(F.count_distinct("refund_id").alias("refund_count"), F.sum("amount").alias("refunded_amount"))
        .filter(F.col("refund_count") > 1)
    )


def _path_by_day(events: DataFrame, *extra: Column) -> DataFrame:
    """Per order and day: the event types in time order, and any further aggregates."""
    ordered = F.array_sort(F.collect_list(F.struct("occurred_at_utc", "event_id", "event_type")))
    return events.groupBy("order_id", F.to_date("occurred_at_utc").alias("_day")).agg(
        F.array_join(ordered["event_type"], ", ").alias("_path"), F.count(F.lit(1)).alias("_n"), *extra
    )


def _whole_path() -> Column:
    days = F.array_sort(F.collect_list(F.struct("_day", "_path")))
    return F.array_join(days["_path"], ", ")


def return_event_path(returns: DataFrame) -> DataFrame:
    """Event types per order in time order; days are joined up first, then the order."""
    return _path_by_day(returns).groupBy("order_id").agg(
        F.sum("_n").alias("return_event_count"), _whole_path().alias("return_events")
    )


def negative_order_refund_events(orders360: DataFrame, refunds: DataFrame) -> DataFrame:
    """What refund evidence stands behind every order with negative net revenue."""
    evidence = c.members(refunds, negative_net_orders(orders360), "order_id")
    return _path_by_day(evidence, F.sum("amount").alias("_amount")).groupBy("order_id").agg(
        F.sum("_n").alias("refund_event_count"), F.sum("_amount").alias("silver_refunded_amount"),
        _whole_path().alias("refund_events"),
    )


def payment_event_set(payments: DataFrame) -> DataFrame:
    """Distinct event types per order, alphabetical; the set is as small as the vocabulary."""
    return payments.groupBy("order_id").agg(
        F.array_join(F.array_sort(F.collect_set("event_type")), ", ").alias("payment_events")
    )


def event_type_counts(**streams: DataFrame) -> DataFrame:
    counted = [
        df.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).select(F.lit(name).alias("source"), "event_type", "event_count")
        for name, df in streams.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def event_trace(wanted: DataFrame, **streams: DataFrame) -> DataFrame:
    """All events of the wanted orders from several streams, for reading in time order.

    Joined with distinct ids, not by a semi join: Spark would push that below the union and
    compute the wanted orders once for every stream, all in the same task.
    """
    parts = []
    for name, df in streams.items():
        amount = F.col("amount") if "amount" in df.columns else F.lit(None).cast(m.MONEY)
        parts.append(df.select("order_id", F.lit(name).alias("source"), "event_id", "event_type", "occurred_at_utc", amount.alias("amount")))
    events = parts[0]
    for other in parts[1:]:
        events = events.unionByName(other)
    return events.join(wanted.select("order_id").distinct(), "order_id").select(*events.columns)


# ---- daily tables --------------------------------------------------------
def _totals(df: DataFrame, rows_as: str, columns: dict[str, str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(rows_as), *[F.sum(source).alias(out) for out, source in columns.items()])


def order_vs_customer_totals(orders360: DataFrame, customer_days: DataFrame) -> DataFrame:
    orders = _totals(orders360, "total_orders", {
        "total_gross_revenue": "gross_merchandise_value", "total_discount": "discount_amount",
        "total_shipping_revenue": "shipping_revenue", "total_refund": "refunded_amount",
        "total_net_revenue": "net_revenue", "total_captured_payment": "captured_payment_amount"})
    days = _totals(customer_days, "total_customer_daily_rows", {
        "total_gross_revenue_daily": "gross_revenue", "total_discount_daily": "discount_amount",
        "total_shipping_revenue_daily": "shipping_revenue", "total_refund_daily": "refund_amount",
        "total_net_revenue_daily": "net_revenue", "total_captured_payment_daily": "captured_payment_amount"})
    return c.compare_totals(orders, days)


def top_payment_diffs(orders360: DataFrame, customer_days: DataFrame) -> DataFrame:
    """All orders whose payment differs from their customer-day total, largest difference first."""
    days = customer_days.select("customer_id", F.col("metric_date").alias("order_date"),
                                F.col("captured_payment_amount").alias("customer_daily_payment"))
    joined = orders360.select("order_id", "customer_id", "order_date", F.col("captured_payment_amount").alias("order_360_payment")).join(
        days, ["customer_id", "order_date"], "left"
    )
    gap = F.col("order_360_payment") - m.or_zero("customer_daily_payment")
    return (
        joined.select("order_id", "order_360_payment", "customer_daily_payment", gap.alias("difference"))
        .filter(F.col("difference") != 0)
        .orderBy(F.abs("difference").desc(), "order_id")
    )


def payment_recon_customer_day(orders360: DataFrame, customer_days: DataFrame) -> DataFrame:
    daily = orders360.groupBy("customer_id", F.col("order_date").alias("metric_date")).agg(
        F.sum("captured_payment_amount").alias("order_360_payment"))
    other = customer_days.withColumnRenamed("captured_payment_amount", "customer_daily_payment")
    return c.full_difference(daily, other, ["customer_id", "metric_date"], "order_360_payment", "customer_daily_payment")


def payment_recon_day(orders360: DataFrame, customer_days: DataFrame) -> DataFrame:
    daily = orders360.groupBy(F.col("order_date").alias("metric_date")).agg(F.sum("captured_payment_amount").alias("order_360_payment"))
    other = customer_days.groupBy("metric_date").agg(F.sum("captured_payment_amount").alias("customer_daily_payment"))
    return c.full_difference(daily, other, ["metric_date"], "order_360_payment", "customer_daily_payment", only_different=False)


def payment_recon_order(enriched: DataFrame, orders360: DataFrame) -> DataFrame:
    left = enriched.select("order_id", F.col("captured_payment_amount").alias("captured_payment_enriched"))
    right = orders360.select("order_id", F.col("captured_payment_amount").alias("captured_payment_gold"))
    return c.full_difference(left, right, ["order_id"], "captured_payment_enriched", "captured_payment_gold")


def customer_daily_rules(customer_days: DataFrame) -> DataFrame:
    required = ["customer_id", "metric_date", "order_count", "gross_revenue", "net_revenue"]
    null_row = F.lit(False)
    for name in required:
        null_row = null_row | F.col(name).isNull()
    flags = F.col("new_customer_order_count") + F.col("repeat_customer_order_count")
    return c.rule_counts(
        customer_days,
        order_count_not_positive=F.col("order_count") <= 0,
        negative_gross_revenue=F.col("gross_revenue") < 0,
        negative_net_revenue=F.col("net_revenue") < 0,
        negative_refund=F.col("refund_amount") < 0,
        negative_return_count=F.col("return_count") < 0,
        flag_sum_mismatch=flags != F.col("order_count"),
        null_rows=null_row,
    )


def customer_flag_mismatch(enriched: DataFrame) -> DataFrame:
    return c.rule_counts(enriched, customer_flag_mismatch=F.col("new_customer_flag") == F.col("repeat_customer_flag"))


def return_count_mismatch(enriched: DataFrame) -> DataFrame:
    counted = F.col("return_count") > 0
    return c.rule_counts(enriched, return_inconsistency=counted != m.has_return())


def multi_order_days(customer_days: DataFrame) -> DataFrame:
    return customer_days.filter(F.col("order_count") > 1).select(
        "customer_id", "metric_date", "order_count", "gross_revenue", "net_revenue"
    )


def business_summary(enriched: DataFrame) -> DataFrame:
    """Totals over enriched orders; customers are counted after a per-customer sum."""
    measures = ["gross_revenue", "discount_amount", "shipping_revenue", "refund_amount", "net_revenue", "captured_payment_amount"]
    per_customer = enriched.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("new_customer_flag").alias("new_customer_orders"),
        F.count_if("repeat_customer_flag").alias("repeat_customer_orders"),
        F.count_if(F.col("refund_amount") > 0).alias("orders_with_refund"),
        F.count_if(F.col("return_count") > 0).alias("orders_with_return"),
        *[F.sum(x).alias(x) for x in measures],
    )
    counts = ["orders", "new_customer_orders", "repeat_customer_orders", "orders_with_refund", "orders_with_return"]
    return per_customer.agg(
        F.count("customer_id").alias("unique_customers"), *[F.sum(x).alias(x) for x in counts],
        *[F.sum(x).alias(f"total_{x}") for x in measures],
    )


# ---- silver source checks ------------------------------------------------
def orders_store_coverage(orders: DataFrame) -> DataFrame:
    return orders.groupBy("sales_channel").agg(
        F.count(F.lit(1)).alias("total_orders"), F.count("store_id").alias("orders_with_store"),
        (F.count(F.lit(1)) - F.count("store_id")).alias("orders_without_store"),
    )


def order_row_counts_top(orders: DataFrame, rows: int = 10) -> DataFrame:
    counts = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.col("row_count").desc(), "order_id").limit(rows)


def orders_in_list(orders: DataFrame, statuses=m.RESOLVED_STATUSES) -> DataFrame:
    return o.orders_dedup(orders).filter(F.col("status").isin(*statuses)).select("order_id", "status")


def orders_with_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return o.orders_dedup(orders).select("order_id", "customer_id").join(customers, "customer_id", "left").select(
        "order_id", "customer_id", "city_id", "customer_segment"
    )


def _versions_closed(categories: DataFrame, *columns: str) -> DataFrame:
    return categories.select(
        F.col("product_id").alias("_key"), F.col("valid_from_utc").alias("_from"), F.col("valid_to_utc").alias("_to"), *columns
    )


def category_asof_order(items: DataFrame, orders: DataFrame, categories: DataFrame) -> DataFrame:
    """Category by the closed-interval rule for every (order, product, order time).

    Items and order versions are counted before joining, so copies do not multiply.
    """
    pairs = items.repartition("order_id").groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("item_rows"))
    times = orders.repartition("order_id").groupBy("order_id", "ordered_at_utc").agg(F.count(F.lit(1)).alias("order_rows"))
    at = F.col("ordered_at_utc")
    joined = pairs.join(times, "order_id").join(
        _versions_closed(categories, "category_name"),
        (F.col("product_id") == F.col("_key")) & in_force_closed(at, F.col("_from"), F.col("_to")), "left",
    )
    return joined.select(
        "order_id", "product_id", at.alias("order_date"), "category_name",
        (F.col("item_rows") * F.col("order_rows")).alias("joined_rows"),
    )


def category_match_counts(items: DataFrame, orders: DataFrame, categories: DataFrame) -> DataFrame:
    """(order, product) pairs that the plain join would repeat, and how often.

    Dealt out by both keys first: the aggregate would otherwise accept the join's
    partitioning by product and keep a hot product in one task.
    """
    return (
        category_asof_order(items, orders, categories).repartition("order_id", "product_id").groupBy("order_id", "product_id")
        .agg(F.sum("joined_rows").alias("category_matches")).filter(F.col("category_matches") > 1)
    )


def missing_snapshots(snapshots: DataFrame) -> DataFrame:
    """Gaps between a product's snapshot days: first and last missing day and their number."""
    days = snapshots.select("product_id", F.to_date("snapshot_date").alias("day")).distinct()
    following = F.lead("day").over(Window.partitionBy("product_id").orderBy("day"))
    gap = F.date_diff("next_day", "day") - 1
    return (
        days.withColumn("next_day", following).filter(gap > 0)
        .select("product_id", F.date_add("day", 1).alias("gap_start"), F.date_sub("next_day", 1).alias("gap_end"),
                gap.alias("missing_days"))
    )
