"""Plans of product days: what a question leaves out, and what a task holds."""

from datetime import date

import pytest

from mercato.plans import products, questions
from makers import item, make, order, refund
from test_orders import build

DAY = date(2026, 7, 1)


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def snapshot(product_id, day, available, reserved=0):
    return dict(product_id=product_id, location_id="1", snapshot_date=day, available_quantity=available, reserved_quantity=reserved)


class Gold:
    def __init__(self, facts):
        self.product_daily = facts


@pytest.fixture
def facts(spark):
    orders = [order("o1"), order("o2", day="2026-07-02"), order("o3", ordered_at_utc=None)]
    items = [item("o1", "p1", 2), item("o1", "p2"), item("o2", "p1"), item("o3", "p1"), item("o9", "p1"), item("o1", None)]
    fact = build(spark, orders, items, refunds=[refund("r1", 5)])
    days = [("p1", "2026-07-01", 3), ("p1", "2026-07-01", -3), ("p3", "2026-07-01", 4), ("p1", None, 7), ("p1", None, 1), (None, "2026-07-01", 1)]
    stock = make(spark, "snapshots", *[snapshot(*d) for d in days])
    return products.product_day_facts(make(spark, "order_items", *items), fact, make(spark, "promotions"), stock)


def test_keys_come_from_either_side(facts):
    """A day without a date is the stock's or the sales' own and never matches the other's."""
    got = {(r["product_id"], r["metric_date"], r["available_inventory"], r["units_sold"]) for r in facts.collect()}
    assert got == {("p1", DAY, 0, 2), ("p2", DAY, None, 1), ("p1", date(2026, 7, 2), None, 1), ("p3", DAY, 4, 0), ("p1", None, 8, 0), ("p1", None, None, 1)}
    assert facts.count() == 6


def test_questions_on_counted_days_drop_the_sales(facts):
    """the sales and orders behind a stockout rate or list are not computed."""
    for ask in (questions.dash_stockout, questions.stockouts):
        answer = ask(Gold(facts))
        assert "Join " not in plan(answer) and "order_id" not in plan(answer)
    rates = {r["metric_date"]: r["stockout_rate"] for r in questions.dash_stockout(Gold(facts)).collect()}
    assert rates == {DAY: 0.5, None: 0.0}


def test_counts_are_dealt_before_they_are_summed(spark):
    """a scan task holds no table of the product days it reads."""
    stock = make(spark, "snapshots", snapshot("p1", "2026-07-01", 3), snapshot("p1", "2026-07-01", 1))
    lines = [x for x in plan(products.product_inventory_daily(stock), "executedPlan").splitlines() if "Aggregate" in x or "Exchange" in x]
    assert lines and "Exchange" in lines[-1]


def test_versions_are_not_broadcast_by_the_size_of_their_file(spark, tmp_path):
    """memory of a task does not follow the dimension."""
    stock = make(spark, "snapshots", snapshot("p1", "2026-07-01", 3), snapshot("p2", "2026-07-01", 3))
    versions = [("p1", "a", "2026-01-01", None), ("p1", "b", "2026-06-01", "2026-08-01"), ("p2", "c", "2026-08-01", None)]
    columns = ("product_id", "category_name", "valid_from_utc", "valid_to_utc")
    categories = make(spark, "categories", *[dict(zip(columns, v)) | {"source_row_id": "s"} for v in versions])
    categories.write.parquet(f"{tmp_path}/categories")
    found = products.category_on_snapshot_days(stock, spark.read.parquet(f"{tmp_path}/categories"))
    assert "Broadcast" not in plan(found, "executedPlan")
    assert {tuple(r) for r in found.collect()} == {("p1", DAY, "a"), ("p1", DAY, "b"), ("p2", DAY, None)}


def test_joins_of_sales_hash_instead_of_sorting(facts):
    """sales meet orders, and stock meets sales, without sorts of both sides."""
    text = plan(facts, "executedPlan")
    assert text.count("ShuffledHashJoin") == 2
