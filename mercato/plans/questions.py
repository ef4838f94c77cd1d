"""The business questions, answered from the five gold tables.

Every function takes an object with the gold frames as attributes: the written tables
in production (``sources.tables.GoldTables``), frames composed on the fly in checks.
Sorting is the answer's order for a reader and is left out before any write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..functions.clean import json_friendly

MIN_ROWS, DEFAULT_ROWS, MAX_ROWS = 1, 100, 1000


def capped(df: DataFrame, rows: int = DEFAULT_ROWS) -> DataFrame:
    """The row cap of an interactive answer; a cap outside the allowed range is refused."""
    if not MIN_ROWS <= rows <= MAX_ROWS:
        raise ValueError(f"rows must be between {MIN_ROWS} and {MAX_ROWS}, not {rows}")
    return df.limit(rows)


def json_friendly_rows(df: DataFrame) -> DataFrame:
    return df.select(*json_friendly(df.schema))


def _total(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out or value))


def _largest_first(df: DataFrame, value: str, *then: str) -> DataFrame:
    return df.orderBy(F.col(value).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in then])


def net_revenue_by_channel(g) -> DataFrame:
    return _largest_first(_total(g.order_360, "sales_channel", "net_revenue"), "net_revenue", "sales_channel")


def refund_rate_by_channel(g) -> DataFrame:
    """Refunded share of *all* orders (the KPI table divides by captured ones)."""
    rates = g.order_360.groupBy("sales_channel").agg(m.share(m.has_refund()).alias("refund_rate"))
    return _largest_first(rates, "refund_rate", "sales_channel")


def orders_per_day(g) -> DataFrame:
    return g.order_360.groupBy("order_date").agg(F.count(F.lit(1)).alias("total_orders")).orderBy("order_date")


def aov_by_channel(g) -> DataFrame:
    """Average *net* value (the KPI table averages gross)."""
    values = g.order_360.groupBy("sales_channel").agg(m.mean("net_revenue").alias("average_order_value"))
    return _largest_first(values, "average_order_value", "sales_channel")


def stockouts(g) -> DataFrame:
    return g.product_daily.filter("stockout_flag").select("product_id", "metric_date").orderBy("metric_date", "product_id")


def revenue_by_category(g) -> DataFrame:
    return _largest_first(_total(g.product_daily, "active_category", "net_revenue"), "net_revenue", "active_category")


def active_customers(g) -> DataFrame:
    """customer_daily holds a customer once per date, so no distinct count is needed."""
    return (
        g.customer_daily.filter(F.col("order_count") > 0)
        .groupBy("metric_date").agg(F.count("customer_id").alias("active_customers")).orderBy("metric_date")
    )


def repeat_rate(g) -> DataFrame:
    return (
        g.customer_daily.groupBy("metric_date")
        .agg(m.share(F.col("repeat_customer_flag")).alias("repeat_customer_rate")).orderBy("metric_date")
    )


def _campaign_totals(g) -> DataFrame:
    return g.channel_campaign_daily.groupBy("campaign_id").agg(
        F.sum("campaign_spend").alias("spend"), F.sum("net_revenue").alias("net_revenue")
    ).withColumn("roas", m.ratio("net_revenue", "spend"))


def roas(g) -> DataFrame:
    return _largest_first(_campaign_totals(g).filter(F.col("spend") > 0).select("campaign_id", "roas"), "roas", "campaign_id")


def channel_campaign_orders(g) -> DataFrame:
    totals = g.channel_campaign_daily.groupBy("sales_channel", "campaign_id").agg(F.sum("attributed_orders").alias("orders"))
    return _largest_first(totals, "orders", "sales_channel", "campaign_id")


def _daily_kpi(name: str):
    def question(g) -> DataFrame:
        return g.executive_kpis_daily.select("metric_date", name).orderBy("metric_date")

    question.__name__ = f"daily_{name}"
    return question


def fully_refunded(g) -> DataFrame:
    return (
        g.order_360.filter(m.has_refund() & (F.col("net_revenue") <= 0))
        .select("order_id", "refunded_amount", "net_revenue").orderBy("order_id")
    )


def customer_net_revenue(g) -> DataFrame:
    return _largest_first(_total(g.customer_daily, "customer_id", "net_revenue"), "net_revenue", "customer_id")


def support_customers(g) -> DataFrame:
    contacted = g.customer_daily.filter(F.col("support_contacts") > 0)
    return _largest_first(_total(contacted, "customer_id", "support_contacts"), "support_contacts", "customer_id")


def category_refund(g) -> DataFrame:
    """Gross minus net of a product day; this holds discounts as well as refunds."""
    gap = g.product_daily.withColumn("gap", F.col("gross_revenue") - F.col("net_revenue"))
    return _largest_first(_total(gap, "active_category", "gap", "refund_amount"), "refund_amount", "active_category")


def campaign_spend(g) -> DataFrame:
    return _total(g.channel_campaign_daily, "campaign_id", "campaign_spend").orderBy("campaign_id")


def busiest_days(g) -> DataFrame:
    return _largest_first(g.executive_kpis_daily.select("metric_date", "total_orders"), "total_orders", "metric_date")


def units_sold(g) -> DataFrame:
    return _largest_first(_total(g.product_daily, "product_id", "units_sold"), "units_sold", "product_id")


def captured_per_day(g) -> DataFrame:
    return _total(g.order_360, "order_date", "captured_payment_amount").orderBy("order_date")


def refund_per_day(g) -> DataFrame:
    return _total(g.order_360, "order_date", "refunded_amount").orderBy("order_date")


def repeat_by_channel(g) -> DataFrame:
    counts = (
        g.customer_daily.filter("repeat_customer_flag")
        .groupBy("active_channel").agg(F.count_distinct("customer_id").alias("repeat_customers"))
    )
    return _largest_first(counts, "repeat_customers", "active_channel")


def last_refresh(g) -> DataFrame:
    return g.executive_kpis_daily.agg(F.max("data_freshness_utc").alias("last_refresh_utc"))


def dash_executive(g) -> DataFrame:
    return g.executive_kpis_daily.orderBy("metric_date")


def dash_channel(g) -> DataFrame:
    rows = g.order_360.groupBy("sales_channel").agg(
        F.sum("net_revenue").alias("net_revenue"), m.share(m.has_refund()).alias("refund_rate")
    )
    return _largest_first(rows, "net_revenue", "sales_channel")


def dash_campaign_roas(g) -> DataFrame:
    return _largest_first(_campaign_totals(g), "roas", "campaign_id")


def dash_stockout(g) -> DataFrame:
    return (
        g.product_daily.filter(F.col("stockout_flag").isNotNull())
        .groupBy("metric_date").agg(m.share(F.col("stockout_flag")).alias("stockout_rate")).orderBy("metric_date")
    )


# question key -> answer
QUESTIONS = {
    "q01_net_revenue_by_channel": net_revenue_by_channel,
    "q02_refund_rate_by_channel": refund_rate_by_channel,
    "q03_orders_per_day": orders_per_day,
    "q04_aov_by_channel": aov_by_channel,
    "q05_stockouts": stockouts,
    "q06_revenue_by_category": revenue_by_category,
    "q07_active_customers": active_customers,
    "q08_repeat_rate": repeat_rate,
    "q09_roas": roas,
    "q10_channel_campaign_orders": channel_campaign_orders,
    "q11_daily_net_revenue": _daily_kpi("net_revenue"),
    "q12_daily_refund_rate": _daily_kpi("refund_rate"),
    "q13_daily_return_rate": _daily_kpi("return_rate"),
    "q14_daily_stockout_rate": _daily_kpi("stockout_rate"),
    "q15_fully_refunded": fully_refunded,
    "q16_customer_net_revenue": customer_net_revenue,
    "q17_support_customers": support_customers,
    "q18_category_refund": category_refund,
    "q19_campaign_spend": campaign_spend,
    "q20_busiest_days": busiest_days,
    "q21_units_sold": units_sold,
    "q22_captured_per_day": captured_per_day,
    "q23_refund_per_day": refund_per_day,
    "q24_repeat_by_channel": repeat_by_channel,
    "q25_last_refresh": last_refresh,
}
DASHBOARD = {
    "dash_executive": dash_executive,
    "dash_channel": dash_channel,
    "dash_campaign_roas": dash_campaign_roas,
    "dash_stockout": dash_stockout,
}


def answer(key: str, gold, rows: int | None = None) -> DataFrame:
    """Run a question or dashboard query; ``rows`` applies the interactive cap."""
    build = QUESTIONS.get(key) or DASHBOARD[key]
    result = build(gold)
    return result if rows is None else capped(result, rows)
