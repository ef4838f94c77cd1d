"""Product days that are dealt once: what moves, and that the rows are those of the joined form."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from mercato.operators.versions import in_turns, turn_of, version_on_day, version_on_dealt_day
from mercato.plans import products
from makers import item, make, order, refund
from test_orders import build


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def snapshot(product_id, day, available, reserved=0):
    return dict(product_id=product_id, location_id="1", snapshot_date=day, available_quantity=available, reserved_quantity=reserved)


def version(product_id, name, start, end=None, row="a"):
    return dict(product_id=product_id, category_name=name, valid_from_utc=start, valid_to_utc=end, source_row_id=row)


@pytest.fixture
def feeds(spark):
    """Days without a date on either side, no product, ids that hold separators, versions that overlap, end early or never began."""
    orders = [order("o1"), order("o2", "c2"), order("o3", day="2026-07-02"), order("o4", ordered_at_utc=None), order("o5", day="2031-07-02")]
    items = [item("o1", "p1", 2, 10, item_discount_amount=1), item("o1", "p1", 1, 10, order_item_id="again"), item("o2", "p1", -1, 4), item("o1", "p2"),
             item("o3", "p1"), item("o4", "p1"), item("o9", "p1"), item("o1", None), item("o5", "p1", 3), item("o3", "p4")]
    fact = build(spark, orders, items, refunds=[refund("r1", 5)])
    ids = {"o1": ["a,b", "a", "", None, "a"], "o2": ["a", "b", "~1", ","], "o3": ["", ""], "o4": [None]}
    promotions = [dict(order_id=o, promotion_id=x) for o, found in ids.items() for x in found]
    days = [("p1", "2026-07-01", 3), ("p1", "2026-07-01", -3), ("p1", "2031-07-02", 1), ("p3", "2026-07-01", 4), ("p1", None, 7), ("p1", None, 1),
            (None, "2026-07-01", 1), ("p2", "2026-07-01", None)]
    versions = [version("p1", "old", "2020-01-01", "2026-07-02"), version("p1", "long", "2026-06-30", None, "b"), version("p1", "none", "2026-07-01", "2026-07-01", "c"),
                version("p1", "back", "2026-07-03", "2026-07-01", "d"), version("p1", "early", None, "2027-01-01", "e"), version("p2", "two", "2026-07-01"),
                version(None, "no one", "2026-07-01"), version("p3", "three", "2026-07-02"), version("p4", "four", "2026-07-02", "2026-07-03")]
    return (make(spark, "order_items", *items), fact, make(spark, "promotions", *promotions),
            make(spark, "snapshots", *[snapshot(*d) for d in days]), make(spark, "categories", *versions))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_dealt_days_are_the_joined_ones(feeds):
    """the rows and types of the full join of sales and stock."""
    joined, dealt = products.product_day_facts(*feeds[:4]), products.product_days_dealt(*feeds[:4])
    assert [(f.name, f.dataType) for f in dealt.drop("_turn", "_counted").schema] == [(f.name, f.dataType) for f in joined.schema]
    assert rows(dealt.drop("_turn", "_counted")) == rows(joined)
    counts = {(r["product_id"], r["metric_date"]): r["promotion_count"] for r in dealt.filter("metric_date IS NOT NULL").collect()}
    assert counts[("p1", date(2026, 7, 1))] == 6 and counts[("p1", date(2026, 7, 2))] == 1 and counts[("p1", date(2031, 7, 2))] == 0


def test_categories_are_those_of_the_joined_days(feeds):
    """both readings of the category give the rows they gave when days were dealt a second time."""
    joined, columns = products.product_day_facts(*feeds[:4]), products.product_daily(*feeds).columns
    assert rows(products.product_daily(*feeds)) == rows(products.category_on_days(joined, feeds[4]).select(columns))
    known = products.category_on_snapshot_days(*feeds[3:]).withColumnRenamed("category_name", "active_category")
    first = products.product_daily_as_first_written(*feeds)
    assert rows(first) == rows(joined.join(known, products.GRAIN, "left").select(columns))
    assert first.filter("product_id = 'p1' AND metric_date = '2026-07-01'").count() == 2


def test_product_days_move_once(feeds):
    """nothing that was summed by product and day is dealt again, and no partial sums travel."""
    for build_days in (products.product_daily, products.product_daily_as_first_written):
        text = plan(build_days(*feeds))
        assert not re.search(r"hashpartitioning\(product_id#\d+, metric_date#\d+", text)
        assert len(re.findall(r"hashpartitioning\(product_id#\d+, _turn#\d+", text)) == 1
        above = text[:re.search(r"hashpartitioning\(product_id#\d+, _turn#\d+", text).start()]
        assert "collect_set" in above and "SortMergeJoin" not in above


def test_versions_come_to_dealt_days(spark):
    days = spark.sql("SELECT 'k' AS id, explode(sequence(DATE '1965-01-01', DATE '1985-01-01', INTERVAL 5 DAY)) AS day")
    spans = [("1966-03-01", "1966-03-02"), ("1967-12-31", "1968-01-01"), ("1967-06-01", "1970-02-01"), ("1971-01-01", "1979-01-01"), ("1983-01-01", None), ("1984-05-01", "1984-04-01")]
    versions = spark.createDataFrame([("k", *s, f"v{i}", "r") for i, s in enumerate(spans)], "id string, valid_from_utc string, valid_to_utc string, name string, source_row_id string")
    dealt = version_on_dealt_day(days.withColumn("turn", turn_of("day")), versions, "id", "day", "turn", ["name"]).drop("turn")
    assert rows(dealt) == rows(version_on_day(days, versions, "id", "day", ["name"]))


@pytest.mark.parametrize("first,until,turns", [("2026-07-01", "2026-07-02", 1), ("2026-12-31", "2027-01-01", 1), ("2026-12-31", "2027-01-02", 2),
                                              ("1969-01-01", "1972-01-01", 3), ("1900-01-01", "9999-01-01", 4), ("2026-01-01", None, 4),
                                              ("2026-07-01", "2026-07-01", 0), ("2026-07-01", "2020-07-01", 0), (None, "2026-07-01", 0)])
def test_a_version_has_a_copy_for_each_turn_of_its_days(spark, first, until, turns):
    frame = spark.createDataFrame([(first, until)], "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    found = [r["turn"] for r in in_turns(frame, "a", "b", "turn").collect()]
    assert len(found) == len(set(found)) == turns
