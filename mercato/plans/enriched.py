"""The wider customer day: orders enriched by event identity, plus its corrections.

This is the alternative reading kept beside ``order_360``: refunds are resolved by
event id, returns counted by return id, and the captured amount is the largest single
capture. Reconciliation compares the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..operators.versions import latest_by
from . import orders as o


def refund_events_by_id(refunds: DataFrame) -> DataFrame:
    """Completed refunds, the latest ingested row of every event id."""
    done = refunds.filter(F.col("event_type") == m.REFUND_DONE)
    return latest_by(done, ["event_id"], newest=["ingested_at_utc", "occurred_at_utc", "amount"], tie_break=["refund_id"])


def refund_by_event_id(refunds: DataFrame) -> DataFrame:
    return refund_events_by_id(refunds).groupBy("order_id").agg(F.sum("amount").alias("refund_amount"))


def refund_latest_by_refund_id(refunds: DataFrame) -> DataFrame:
    """Completed refunds, the latest event of every refund id."""
    done = refunds.filter(F.col("event_type") == m.REFUND_DONE)
    return latest_by(done, ["refund_id"], newest=["occurred_at_utc", "event_id", "amount"], tie_break=["order_id"])


def return_count_by_order(returns: DataFrame) -> DataFrame:
    events = latest_by(returns, ["event_id"], newest=["ingested_at_utc", "occurred_at_utc"], tie_break=["return_id"])
    return events.groupBy("order_id").agg(F.count_distinct("return_id").alias("return_count"))


def corrected_captures(payments: DataFrame) -> DataFrame:
    """Every captured event once, summed per order."""
    return (
        payments.filter(F.col("event_type") == m.CAPTURED)
        .select("event_id", "order_id", "amount").distinct()
        .groupBy("order_id").agg(F.sum("amount").alias("captured_payment_amount"))
    )


def order_enriched(orders, items, payments, refunds, returns) -> DataFrame:
    latest = o.orders_dedup(orders)
    joined = (
        latest.join(o.order_items_summary(items), "order_id", "left")
        .join(refund_by_event_id(refunds), "order_id", "left")
        .join(return_count_by_order(returns), "order_id", "left")
        .join(o.payment_status_precedence_alt(payments), "order_id", "left")
        .join(o.return_status(returns), "order_id", "left")
        .join(o.first_orders(latest), F.col("order_id") == F.col("first_order_id"), "left")
    )
    is_first = F.col("first_order_id").isNotNull()
    facts = joined.select(
        "order_id", "customer_id", F.to_date("ordered_at_utc").alias("metric_date"), "sales_channel",
        m.or_zero("unit_quantity").alias("unit_quantity"),
        m.or_zero("gross_merchandise_value").alias("gross_revenue"),
        m.or_zero("discount_amount").alias("discount_amount"),
        m.or_zero("shipping_revenue").alias("shipping_revenue"),
        m.or_zero("refund_amount").alias("refund_amount"),
        m.or_zero("return_count").alias("return_count"),
        is_first.alias("new_customer_flag"),
        (~is_first).alias("repeat_customer_flag"),
        "captured_payment_amount", "payment_status",
        F.coalesce("return_status", F.lit(m.NO_RETURN)).alias("return_status"),
    )
    return facts.withColumn("net_revenue", m.net_revenue(refund="refund_amount", gross="gross_revenue"))


def payment_correction(enriched: DataFrame, payments: DataFrame) -> DataFrame:
    """Replace the payment fields by the de-duplicated captures."""
    kept = enriched.drop("captured_payment_amount", "payment_status")
    fixed = kept.join(corrected_captures(payments), "order_id", "left")
    amount = m.or_zero("captured_payment_amount")
    return fixed.withColumn("captured_payment_amount", amount).withColumn(
        "payment_status", F.when(F.col("captured_payment_amount") > 0, m.CAPTURED).otherwise(m.AUTHORIZED)
    )


def refund_correction(uncorrected: DataFrame, refunds: DataFrame) -> DataFrame:
    """Replace plainly summed refunds by de-duplicated ones and restate net revenue."""
    fixed = uncorrected.drop("refunded_amount", "net_revenue").join(o.refunds_by_order(refunds), "order_id", "left")
    return fixed.withColumn("refunded_amount", m.or_zero("refunded_amount")).withColumn("net_revenue", m.net_revenue())


def order_360_first_draft(orders, items, refunds) -> DataFrame:
    """Revenue columns with plainly summed refunds, the input of ``refund_correction``."""
    raw = (
        refunds.filter(F.col("event_type") == m.REFUND_DONE)
        .groupBy("order_id").agg(F.sum("amount").alias("refunded_amount"))
    )
    joined = (
        o.orders_dedup(orders).join(o.order_items_summary(items), "order_id", "left").join(raw, "order_id", "left")
    )
    measures = ["gross_merchandise_value", "discount_amount", "shipping_revenue", "refunded_amount"]
    return joined.select("order_id", *[m.or_zero(c).alias(c) for c in measures]).withColumn("net_revenue", m.net_revenue())


def customer_daily_extended(enriched: DataFrame) -> DataFrame:
    """Enriched orders are unique per order id, so orders are counted directly."""
    sums = ["unit_quantity", "gross_revenue", "discount_amount", "shipping_revenue", "refund_amount",
            "return_count", "net_revenue"]
    return enriched.groupBy("customer_id", "metric_date").agg(
        F.count("order_id").alias("order_count"),
        *[F.sum(c).alias(c) for c in sums],
        F.coalesce(F.sum("captured_payment_amount"), F.lit(0)).alias("captured_payment_amount"),
        F.count_if("new_customer_flag").alias("new_customer_order_count"),
        F.count_if("repeat_customer_flag").alias("repeat_customer_order_count"),
    )
