"""order_360 (one row per order) and the facts it is joined from.

Every source is reduced to one row per ``order_id`` before any join, so facts never
multiply. All inputs end hash-partitioned by ``order_id``; the joins that follow add
no further shuffle. The reductions are plain aggregates, which tells the optimizer
that their key is unique: a question that ignores, say, refunds drops that join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.versions import first_of_each, latest_by, latest_value, rank_within


def _by_order(feed: DataFrame) -> DataFrame:
    """One exchange by order; finer keys that contain it, and the joins, need no other."""
    return feed.repartition("order_id")


def orders_dedup(orders: DataFrame) -> DataFrame:
    """The latest version of every order; equal times prefer the smallest source row."""
    return latest_by(orders, ["order_id"], newest=["updated_at_utc", "ingested_at_utc"], tie_break=["source_row_id"])


def order_items_summary(items: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Totals per order. With ``unique_ids`` (silver items) a plain count replaces the
    distinct count, which saves a whole shuffle of the largest table."""
    counted = F.count("order_item_id") if unique_ids else F.count_distinct("order_item_id")
    return _by_order(items).groupBy("order_id").agg(
        counted.alias("item_count"),
        F.sum("quantity").alias("unit_quantity"),
        F.sum(m.line_amount()).alias("gross_merchandise_value"),
        F.sum("item_discount_amount").alias("discount_amount"),
    )


def payment_events_dedup(payments: DataFrame) -> DataFrame:
    return _by_order(payments.select("event_id", "order_id", "amount", "event_type", "occurred_at_utc")).distinct()


def captured_payments(payments: DataFrame) -> DataFrame:
    """Captured amount of every order that has any payment event (NULL if none captured)."""
    return payment_events_dedup(payments).groupBy("order_id").agg(
        m.sum_if(F.col("event_type") == m.CAPTURED, "amount").alias("captured_payment_amount")
    )


def payment_status(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        latest_value("event_type", "occurred_at_utc", "event_id").alias("payment_status")
    )


def payment_summary(payments: DataFrame, no_copies: bool = False) -> DataFrame:
    """Captured amount and latest status from one pass over the events."""
    events = payments if no_copies else payment_events_dedup(payments)
    return events.groupBy("order_id").agg(
        m.sum_if(F.col("event_type") == m.CAPTURED, "amount").alias("captured_payment_amount"),
        latest_value("event_type", "occurred_at_utc", "event_id").alias("payment_status"),
    )


def payment_status_precedence(payments: DataFrame) -> DataFrame:
    """Captured over failed over authorised, whatever came last."""
    return payments.groupBy("order_id").agg(
        m.status_by_precedence(m.CAPTURED, m.FAILED, m.AUTHORIZED).alias("payment_status")
    )


def payment_status_precedence_alt(payments: DataFrame) -> DataFrame:
    """Captured over authorised over failed, with the largest single capture."""
    captured = F.when(F.col("event_type") == m.CAPTURED, F.col("amount")).otherwise(F.lit(0))
    return payments.groupBy("order_id").agg(
        F.max(captured).alias("captured_payment_amount"),
        m.status_by_precedence(m.CAPTURED, m.AUTHORIZED, m.FAILED, otherwise="UNKNOWN").alias("payment_status"),
    )


def refund_dedup_max(refunds: DataFrame) -> DataFrame:
    """Completed refunds, one amount per (order, refund): the largest seen."""
    return (
        _by_order(refunds.filter(F.col("event_type") == m.REFUND_DONE))
        .groupBy("order_id", "refund_id").agg(F.max("amount").alias("amount"))
    )


def refunds_by_order(refunds: DataFrame) -> DataFrame:
    return refund_dedup_max(refunds).groupBy("order_id").agg(F.sum("amount").alias("refunded_amount"))


def return_status(returns: DataFrame) -> DataFrame:
    return returns.groupBy("order_id").agg(
        latest_value("event_type", "occurred_at_utc", "event_id").alias("return_status")
    )


def order_promo_count(promotions: DataFrame) -> DataFrame:
    return _by_order(promotions).groupBy("order_id").agg(F.count_distinct("promotion_id").alias("promotion_count"))


def customer_order_rank(orders: DataFrame) -> DataFrame:
    """Position of each order in its customer's history; large customers are split by minute."""
    latest = orders_dedup(orders).select("order_id", "customer_id", "ordered_at_utc")
    return rank_within(
        latest, ["customer_id"], F.date_trunc("minute", "ordered_at_utc"), ["ordered_at_utc", "order_id"], "customer_order_rank"
    )


def first_orders(latest_orders: DataFrame) -> DataFrame:
    return first_of_each(latest_orders, "customer_id", ["ordered_at_utc", "order_id"], "order_id", "first_order_id")


def order_360(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    refunds: DataFrame,
    returns: DataFrame,
    promotions: DataFrame,
    clean: bool = False,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """The order fact.

    ``clean`` says that silver already left one row per order, item id and payment
    event; the three de-duplications and their shuffles are then skipped. ``firsts``
    names each customer's first order where ``orders`` are only some of theirs.
    """
    latest = orders if clean else orders_dedup(orders)
    first = first_orders(latest) if firsts is None else firsts
    joined = (
        latest.join(order_items_summary(items, unique_ids=clean), "order_id", "left")
        .join(payment_summary(payments, no_copies=clean), "order_id", "left")
        .join(refunds_by_order(refunds), "order_id", "left")
        .join(return_status(returns), "order_id", "left")
        .join(order_promo_count(promotions), "order_id", "left")
        .join(first, F.col("order_id") == F.col("first_order_id"), "left")
    )
    facts = joined.select(
        "order_id",
        "customer_id",
        F.to_date("ordered_at_utc").alias("order_date"),
        "sales_channel",
        "store_id",
        *[
            m.or_zero(c).alias(c)
            for c in ("gross_merchandise_value", "discount_amount", "shipping_revenue",
                      "captured_payment_amount", "refunded_amount", "item_count", "unit_quantity")
        ],
        F.col("status").alias("order_status"),
        F.coalesce("payment_status", F.lit(m.NO_PAYMENT)).alias("payment_status"),
        F.coalesce("return_status", F.lit(m.NO_RETURN)).alias("return_status"),
        m.or_zero("promotion_count").alias("promotion_count"),
        F.col("first_order_id").isNotNull().alias("first_order_flag"),
    )
    return facts.withColumn("net_revenue", m.net_revenue())
