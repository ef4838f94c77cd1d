"""All operators composed over one folder of star-schema tables.

Frames are lazy and shared per workbench; the optimizer sees one plan from the Parquet
scan to the result and prunes whatever a query does not use.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as c
from ..sources.star_views import StarViews
from . import campaigns, checks, customers, enriched, kpis, landing, orders, products, questions

AS_OF = datetime(2002, 1, 1)


class Workbench:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.v = StarViews(spark, folder)

    @cached_property
    def order_360(self) -> DataFrame:
        v = self.v
        return orders.order_360(
            v.orders, v.order_items, v.payment_events, v.refund_events, v.return_events, v.order_promotions
        )

    @cached_property
    def customer_daily(self) -> DataFrame:
        return customers.customer_daily(self.order_360, self.v.support_events)

    @cached_property
    def product_day_facts(self) -> DataFrame:
        v = self.v
        return products.product_day_facts(v.order_items, self.order_360, v.order_promotions, v.inventory_snapshots)

    @cached_property
    def product_daily(self) -> DataFrame:
        v = self.v
        return products.product_daily(
            v.order_items, self.order_360, v.order_promotions, v.inventory_snapshots, v.product_categories
        )

    @cached_property
    def channel_campaign_daily(self) -> DataFrame:
        return campaigns.channel_campaign_daily(self.v.web_events, self.v.campaign_spend, self.order_360)

    @cached_property
    def executive_kpis_daily(self) -> DataFrame:
        stock = products.product_stock_days(self.v.inventory_snapshots)
        return kpis.executive_kpis_daily(self.order_360, self.customer_daily, stock)

    @cached_property
    def faulty_order_360(self) -> DataFrame:
        """The fact and, for every returned order, a second row with a negative refund and a wrong net revenue."""
        amount = self.order_360.schema["net_revenue"].dataType
        wrong = F.col("gross_merchandise_value") - F.col("discount_amount") + F.col("shipping_revenue") + 5
        planted = self.order_360.filter("return_status <> 'NO_RETURN'").withColumns(
            {"refunded_amount": F.lit(-1).cast(self.order_360.schema["refunded_amount"].dataType), "net_revenue": wrong.cast(amount)})
        return self.order_360.unionByName(planted)

    @cached_property
    def faulty_enriched(self) -> DataFrame:
        """The enriched orders and, for every returned one, a second row with equal flags and no counted return."""
        count = self.enriched.schema["return_count"].dataType
        planted = self.enriched.filter("return_status <> 'NO_RETURN'").withColumns(
            {"repeat_customer_flag": F.col("new_customer_flag"), "return_count": F.lit(0).cast(count)})
        return self.enriched.unionByName(planted)

    @cached_property
    def enriched(self) -> DataFrame:
        v = self.v
        return enriched.order_enriched(v.orders, v.order_items, v.payment_events, v.refund_events, v.return_events)

    @cached_property
    def customer_daily_extended(self) -> DataFrame:
        return enriched.customer_daily_extended(self.enriched)


class _QuestionGold:
    """Gold frames for a question; the category is joined only where it is asked for."""

    def __init__(self, w: Workbench, with_category: bool, dated: bool = False):
        self._w, self._with_category, self._dated = w, with_category, dated

    def __getattr__(self, table: str) -> DataFrame:
        if table == "product_daily" and not self._with_category:
            return self._w.product_day_facts
        frame = getattr(self._w, table)
        if table == "executive_kpis_daily" and self._dated:
            frame = frame.withColumn("data_freshness_utc", F.lit(AS_OF).cast("timestamp_ntz"))
        return frame


_BY_CATEGORY = {"q06_revenue_by_category", "q18_category_refund"}


def _question(key: str) -> Callable[[Workbench], DataFrame]:
    def run(w: Workbench) -> DataFrame:
        return questions.answer(key, _QuestionGold(w, key in _BY_CATEGORY, dated=key == "q25_last_refresh"))

    return run


ORDER_MEASURES = [
    "gross_merchandise_value", "discount_amount", "shipping_revenue", "captured_payment_amount",
    "refunded_amount", "net_revenue", "item_count", "unit_quantity", "promotion_count",
]


def _row_counts(w: Workbench) -> DataFrame:
    result = None
    for name in ("orders", "order_items", "order_promotions", "customers", "products", "product_categories",
                 "payment_events", "refund_events", "return_events", "support_events", "web_events",
                 "inventory_snapshots", "campaign_spend"):
        one = getattr(w.v, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        result = one if result is None else result.unionByName(one)
    return result


def _schema_inventory(w: Workbench) -> DataFrame:
    """Column names, positions and types of the order tables, with NULL counts from the data."""
    result = None
    for name in ("orders", "order_items", "payment_events", "refund_events", "return_events"):
        df = getattr(w.v, name)
        facts = [
            F.struct(F.lit(name).alias("table_name"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                     F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"n_{f.name}").alias("null_count"))
            for i, f in enumerate(df.schema.fields, 1)
        ]
        counts = df.agg(*[F.count_if(F.col(x).isNull()).alias(f"n_{x}") for x in df.columns])
        one = counts.select(F.inline(F.array(*facts)))
        result = one if result is None else result.unionByName(one)
    return result


PLANS: dict[str, Callable[[Workbench], DataFrame]] = {
    # order facts
    "order_360": lambda w: w.order_360,
    "orders_dedup": lambda w: orders.orders_dedup(w.v.orders),
    "order_items_summary": lambda w: orders.order_items_summary(w.v.order_items),
    "payment_events_dedup": lambda w: orders.payment_events_dedup(w.v.payment_events),
    "captured_payments": lambda w: orders.captured_payments(w.v.payment_events),
    "payment_status": lambda w: orders.payment_status(w.v.payment_events),
    "payment_status_precedence": lambda w: orders.payment_status_precedence(w.v.payment_events),
    "payment_status_precedence_alt": lambda w: orders.payment_status_precedence_alt(w.v.payment_events),
    "refund_dedup_max": lambda w: orders.refund_dedup_max(w.v.refund_events),
    "refunds_by_order": lambda w: orders.refunds_by_order(w.v.refund_events),
    "return_status": lambda w: orders.return_status(w.v.return_events),
    "order_promo_count": lambda w: orders.order_promo_count(w.v.order_promotions),
    "customer_order_rank": lambda w: orders.customer_order_rank(w.v.orders),
    # customer days
    "customer_daily": lambda w: w.customer_daily,
    "active_channel": lambda w: customers.active_channel(w.order_360),
    "support_contacts_daily": lambda w: customers.support_contacts_daily(w.v.support_events),
    "support_tickets_daily": lambda w: customers.support_tickets_daily(w.v.support_events),
    # product days
    "product_daily": lambda w: w.product_daily,
    "product_daily_as_first_written": lambda w: products.product_daily_as_first_written(
        w.v.order_items, w.order_360, w.v.order_promotions, w.v.inventory_snapshots, w.v.product_categories),
    "product_sales_daily": lambda w: products.product_sales_daily(w.v.order_items, w.order_360),
    "product_inventory_daily": lambda w: products.product_inventory_daily(w.v.inventory_snapshots),
    "product_promo_daily": lambda w: products.product_promo_daily(w.v.order_items, w.order_360, w.v.order_promotions),
    "product_refund_units_daily": lambda w: products.product_refund_units_daily(w.v.order_items, w.order_360),
    "product_discount_daily": lambda w: products.product_discount_daily(w.v.order_items, w.order_360),
    "product_refund_daily": lambda w: products.product_refund_daily(w.v.order_items, w.order_360),
    "product_grid": lambda w: products.product_grid(w.v.order_items, w.order_360, w.v.inventory_snapshots),
    "category_versions": lambda w: products.category_versions(w.v.product_categories),
    "category_asof_day": lambda w: products.category_on_days(
        products.product_grid(w.v.order_items, w.order_360, w.v.inventory_snapshots), w.v.product_categories),
    "category_asof_day_as_first_written": lambda w: products.category_on_snapshot_days(
        w.v.inventory_snapshots, w.v.product_categories),
    "last_line_under_way": lambda w: products.last_line_under_way(w.v.table("lineitem"), w.v.table("orders")),
    "category_asof_order": lambda w: checks.category_asof_order(w.v.order_items, w.v.orders, w.v.product_categories),
    "category_match_counts": lambda w: checks.category_match_counts(w.v.order_items, w.v.orders, w.v.product_categories),
    # campaign days
    "channel_campaign_daily": lambda w: w.channel_campaign_daily,
    "campaign_touches": lambda w: campaigns.campaign_touches(w.v.web_events),
    "last_touch_attribution": lambda w: campaigns.last_touch_attribution(w.v.web_events),
    "attributed_daily": lambda w: campaigns.attributed_daily(w.v.web_events, w.order_360),
    "campaign_spend_daily": lambda w: campaigns.campaign_spend_daily(w.v.campaign_spend),
    "campaign_sessions_daily": lambda w: campaigns.campaign_sessions_daily(w.v.web_events),
    "campaign_grid": lambda w: campaigns.campaign_grid(w.v.web_events, w.v.campaign_spend, w.order_360),
    # KPIs
    "executive_kpis_daily": lambda w: w.executive_kpis_daily,
    "order_kpis_daily": lambda w: kpis.order_kpis_daily(w.order_360),
    "customer_kpis_daily": lambda w: kpis.customer_kpis_daily(w.customer_daily),
    "stockout_rate_daily": lambda w: kpis.stockout_rate_daily(products.product_stock_days(w.v.inventory_snapshots)),
    # the wider customer day and corrections
    "order_enriched": lambda w: w.enriched,
    "customer_daily_extended": lambda w: w.customer_daily_extended,
    "refund_events_by_id": lambda w: enriched.refund_events_by_id(w.v.refund_events),
    "refund_correction": lambda w: enriched.refund_correction(
        enriched.order_360_first_draft(w.v.orders, w.v.order_items, w.v.refund_events), w.v.refund_events),
    "payment_correction": lambda w: enriched.payment_correction(w.enriched, w.v.payment_events),
    "corrected_captures": lambda w: enriched.corrected_captures(w.v.payment_events),
    "return_count_by_order": lambda w: enriched.return_count_by_order(w.v.return_events),
    # questions over gold
    **{key: _question(key) for key in questions.QUESTIONS},
    **{key: _question(key) for key in questions.DASHBOARD},
    "capped_result": lambda w: questions.answer(
        "q16_customer_net_revenue", _QuestionGold(w, False), rows=questions.DEFAULT_ROWS),
    "json_friendly_rows": lambda w: questions.json_friendly_rows(w.executive_kpis_daily),
    # checks
    "grain_order_360": lambda w: c.grain(w.faulty_order_360, ["order_id"]),
    "grain_customer_daily": lambda w: c.grain(
        w.customer_daily, ["customer_id", "metric_date"],
        ["customer_id", "metric_date", "order_count", "gross_revenue", "net_revenue"]),
    "grain_product_daily": lambda w: c.grain(w.product_daily, ["product_id", "metric_date"]),
    "grain_channel_campaign_daily": lambda w: c.grain(w.channel_campaign_daily, campaigns.GRAIN),
    "grain_executive_daily": lambda w: c.grain(w.executive_kpis_daily, ["metric_date"]),
    "null_counts_order_360": lambda w: c.null_counts(w.order_360),
    "layer_row_counts": _row_counts,
    "schema_inventory": _schema_inventory,
    "column_profile": lambda w: c.profile_columns(w.customer_daily.select(
        "customer_id", "metric_date", "order_count", "support_contacts", "active_channel", "new_customer_flag")),
    "order_numeric_profile": lambda w: c.exact_profile(w.order_360, ORDER_MEASURES).withColumn("stddev", F.round("stddev", 6)),
    "net_revenue_mismatch": lambda w: checks.net_revenue_mismatch(w.faulty_order_360),
    "payment_anomalies": lambda w: checks.payment_anomalies(w.order_360),
    "payments_of_anomalies": lambda w: checks.payments_of_anomalies(w.v.payment_events, w.order_360),
    "payment_status_split": lambda w: checks.payment_status_split(w.order_360),
    "payment_amount_by_status": lambda w: checks.payment_amount_by_status(w.order_360),
    "negative_refunds": lambda w: checks.negative_refunds(w.faulty_order_360),
    "negative_net_orders": lambda w: checks.negative_net_orders(w.order_360),
    "negative_net_by_return": lambda w: checks.negative_net_by_return(w.order_360),
    "neg_orders_with_refund": lambda w: checks.neg_orders_with_refund(w.order_360, w.v.refund_events),
    "neg_orders_without_refund": lambda w: checks.neg_orders_without_refund(w.order_360, w.v.refund_events),
    "negative_order_refund_events": lambda w: checks.negative_order_refund_events(w.order_360, w.v.refund_events),
    "cancelled_but_captured": lambda w: checks.cancelled_but_captured(w.order_360),
    "return_status_mismatch": lambda w: checks.return_status_mismatch(w.order_360, w.v.return_events),
    "first_order_check": lambda w: checks.first_order_check(w.order_360, w.v.orders),
    "refund_total_recon": lambda w: checks.refund_total_recon(w.order_360, w.v.refund_events),
    "refund_recon_by_id": lambda w: checks.refund_recon_by_id(
        enriched.refund_latest_by_refund_id(w.v.refund_events), w.enriched),
    "refund_raw_vs_dedup": lambda w: checks.refund_raw_vs_dedup(w.v.refund_events),
    "refund_duplicates": lambda w: checks.refund_duplicates(w.v.refund_events),
    "refund_duplicate_impact": lambda w: checks.refund_duplicate_impact(w.v.refund_events),
    "payment_recon_silver": lambda w: checks.payment_recon_silver(w.order_360, w.v.payment_events),
    "payment_recon_silver_raw": lambda w: checks.payment_recon_silver(w.order_360, w.v.payment_events, deduplicate=False),
    "multi_capture_orders": lambda w: checks.multi_capture_orders(w.v.payment_events),
    "multi_refund_orders": lambda w: checks.multi_refund_orders(w.v.refund_events),
    "return_event_path": lambda w: checks.return_event_path(w.v.return_events),
    "payment_event_set": lambda w: checks.payment_event_set(w.v.payment_events),
    "event_type_counts": lambda w: checks.event_type_counts(
        payment=w.v.payment_events, refund=w.v.refund_events, **{"return": w.v.return_events}),
    "event_trace": lambda w: checks.event_trace(
        checks.negative_net_orders(w.order_360),
        payment=w.v.payment_events, refund=w.v.refund_events, **{"return": w.v.return_events}),
    "order_vs_customer_totals": lambda w: checks.order_vs_customer_totals(w.order_360, w.customer_daily_extended),
    "top_payment_diffs": lambda w: checks.top_payment_diffs(w.order_360, w.customer_daily_extended),
    "payment_recon_customer_day": lambda w: checks.payment_recon_customer_day(w.order_360, w.customer_daily_extended),
    "payment_recon_day": lambda w: checks.payment_recon_day(w.order_360, w.customer_daily_extended),
    "payment_recon_order": lambda w: checks.payment_recon_order(w.enriched, w.order_360),
    "customer_daily_rules": lambda w: checks.customer_daily_rules(w.customer_daily_extended),
    "customer_flag_mismatch": lambda w: checks.customer_flag_mismatch(w.faulty_enriched),
    "return_count_mismatch": lambda w: checks.return_count_mismatch(w.faulty_enriched),
    "multi_order_days": lambda w: checks.multi_order_days(w.customer_daily),
    "business_summary": lambda w: checks.business_summary(w.enriched),
    "orders_store_coverage": lambda w: checks.orders_store_coverage(w.v.orders),
    "order_row_counts_top": lambda w: checks.order_row_counts_top(w.v.orders),
    "orders_in_list": lambda w: checks.orders_in_list(w.v.orders),
    "orders_with_customer": lambda w: checks.orders_with_customer(w.v.orders, w.v.customers),
    "duplicate_orders": lambda w: c.duplicates(w.v.orders, ["order_id"]),
    "duplicate_customers": lambda w: c.duplicates(w.v.customer_profiles, ["customer_id"]),
    "duplicate_categories": lambda w: c.duplicates(w.v.product_categories, ["product_id"]),
    "missing_snapshots": lambda w: checks.missing_snapshots(w.v.inventory_snapshots),
    # bronze, silver and streaming over landed files
    **landing.LANDING,
}
