"""Product, campaign and KPI days."""

from datetime import date, datetime

import pytest

from mercato.plans import campaigns, kpis, products, questions
from makers import dec, item, make, order, payment, refund
from test_orders import build
from mercato.plans import customers


def day(n):
    return date(2026, 7, n)


def version(name, start, end=None, row="a", product="p1"):
    return dict(product_id=product, category_name=name, valid_from_utc=start, valid_to_utc=end, source_row_id=row)


def category_on(spark, versions, *days, product="p1"):
    frame = spark.createDataFrame([(product, d) for d in days], "product_id string, metric_date date")
    found = products.category_on_days(frame, make(spark, "categories", *versions)).collect()
    return {r["metric_date"]: r["active_category"] for r in found}


def test_category_changes_on_its_start_day(spark):
    versions = [version("old", "2026-07-01", "2026-07-03"), version("new", "2026-07-03")]
    assert category_on(spark, versions, day(2), day(3), date(2026, 6, 1)) == {day(2): "old", day(3): "new", date(2026, 6, 1): None}


def test_same_start_prefers_larger_source_row(spark):
    assert category_on(spark, [version("a", "2026-07-01", row="a"), version("b", "2026-07-01", row="b")], day(2)) == {day(2): "b"}


def test_overlapping_versions_give_one_row_and_fall_back_when_the_newer_ends(spark):
    versions = [version("long", "2026-07-01"), version("short", "2026-07-02", "2026-07-04", "b")]
    assert category_on(spark, versions, day(1), day(3), day(5)) == {day(1): "long", day(3): "short", day(5): "long"}


def test_overlap_fans_out_as_first_written(spark):
    versions = [version("long", "2026-07-01"), version("short", "2026-07-02", "2026-07-04", "b")]
    stock = make(spark, "snapshots", dict(product_id="p1", snapshot_date="2026-07-03", available_quantity=1, reserved_quantity=0))
    assert products.category_on_snapshot_days(stock, make(spark, "categories", *versions)).count() == 2


def product_days(spark, gold, items, promotions=(), stock=(), versions=()):
    rows = products.product_daily(
        make(spark, "order_items", *items), gold, make(spark, "promotions", *promotions),
        make(spark, "snapshots", *stock), make(spark, "categories", *versions)).collect()
    return {(r["product_id"], r["metric_date"]): r for r in rows}


def test_product_day_measures(spark):
    items = [item("o1", "p1", 2, 10, item_discount_amount=1), item("o1", "p1", 1, 10, order_item_id="again"),
             item("o2", "p1", 1, 10), item("o2", "p2", 1, 3)]
    gold = build(spark, [order("o1"), order("o2", "c2")], items, refunds=[refund("a", 1, order_id="o1")])
    promotions = [dict(order_id="o1", promotion_id=x) for x in "aab"] + [dict(order_id="o2", promotion_id=x) for x in "bc"]
    row = product_days(spark, gold, items, promotions)[("p1", day(1))]
    assert (row["units_sold"], row["order_count"], row["gross_revenue"]) == (4, 2, dec(40))
    assert row["net_revenue"] == dec(40 - 1 - 30) and row["refunded_units"] == 3
    assert row["promotion_count"] == 3
    assert row["available_inventory"] is None and row["stockout_flag"] is None


@pytest.mark.parametrize("quantity,flag", [(0, True), (-3, True), (1, False)])
def test_stockout_and_snapshot_only_days(spark, quantity, flag):
    stock = [dict(product_id="p9", location_id=x, snapshot_date="2026-07-08", available_quantity=q, reserved_quantity=1)
             for x, q in (("a", quantity), ("b", 0))]
    row = product_days(spark, build(spark, [order()]), [], stock=stock)[("p9", day(8))]
    assert row["stockout_flag"] is flag and row["available_inventory"] == quantity and row["reserved_inventory"] == 2
    assert row["units_sold"] == 0 and row["net_revenue"] == 0


def touch(event_id, campaign, at, order_id="o1", channel="WEB", session="s1"):
    return dict(event_id=event_id, event_type="click", occurred_at_utc=at, order_id=order_id, customer_id="x",
                campaign_id=campaign, channel=channel, session_id=session)


def campaign_days(spark, web, spend, gold):
    rows = campaigns.channel_campaign_daily(make(spark, "web", *web), make(spark, "spend", *spend), gold).collect()
    return {(r["metric_date"], r["sales_channel"], r["campaign_id"]): r for r in rows}


def test_last_touch_gets_the_order_and_sessions_alone_make_no_row(spark):
    gold = build(spark, [order()], [item(price=30)])
    web = [touch("1", "c1", "2026-06-30"), touch("2", "c2", "2026-07-01"), touch("2", "c2", "2026-07-01"),
           touch("3", None, "2026-07-02"), touch("4", "c3", "2026-07-01", None)]
    spend = [dict(spend_date="2026-07-01", campaign_id="c2", channel="WEB", spend_amount=10)]
    rows = campaign_days(spark, web, spend, gold)
    assert set(rows) == {(day(1), "WEB", "c2")}
    row = rows[(day(1), "WEB", "c2")]
    assert (row["attributed_orders"], row["attributed_customers"], row["roas"], row["conversion_rate"]) == (1, 1, 3.0, 1.0)


def test_zero_spend_and_no_sessions_give_null_ratios(spark):
    gold = build(spark, [order(day="2026-07-03")], [item()])
    spend = [dict(spend_date="2026-07-02", campaign_id="c9", channel="WEB", spend_amount=0)]
    rows = campaign_days(spark, [touch("1", "c1", "2026-07-01")], spend, gold)
    assert rows[(day(2), "WEB", "c9")]["roas"] is None and rows[(day(2), "WEB", "c9")]["attributed_orders"] == 0
    assert rows[(day(3), "WEB", "c1")]["roas"] is None and rows[(day(3), "WEB", "c1")]["conversion_rate"] is None


def kpi_rows(spark, orders, **facts):
    gold = build(spark, orders, **facts)
    people = customers.customer_daily(gold, make(spark, "support"))
    stock = products.product_stock_days(make(spark, "snapshots", dict(product_id="p", snapshot_date="2026-07-01", available_quantity=0, reserved_quantity=0)))
    return {r["metric_date"]: r for r in kpis.executive_kpis_daily(gold, people, stock, datetime(2026, 7, 9)).collect()}


def test_kpis_without_capture_have_refund_rate_zero(spark):
    row = kpi_rows(spark, [order()], refunds=[refund("a", 1)])[day(1)]
    assert (row["refund_rate"], row["stockout_rate"], row["active_customers"], row["repeat_customer_rate"]) == (0.0, 1.0, 1, 0.0)


def test_refund_rate_can_exceed_one(spark):
    pays = [payment("PAYMENT_CAPTURED", "2026-07-01 01:00", amount=1)]
    row = kpi_rows(spark, [order(), order("o2", "c2", status="PENDING")], payments=pays,
                   refunds=[refund("a", 1), refund("b", 1, order_id="o2")])[day(1)]
    assert row["refund_rate"] == 2.0 and row["return_rate"] == 0.0 and row["total_orders"] == 2
