"""The whole build over a small raw folder written as JSON arrays and CSV."""

import csv
import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mercato.plans import medallion, questions
from mercato.schemas import SOURCES, gold_contract
from mercato.sources import raw
from mercato.sources.tables import GoldTables, LayerStore, current_run, ops_runs, published
from makers import dec

DAY = "2026-07-0{}T01:00:00Z"


def sample():
    versions = dict(valid_from_utc="2026-01-01T00:00:00Z", valid_to_utc=None, source_row_id="1")
    order = dict(customer_id="c1", sales_channel="WEB", store_id=None, status="complete", ordered_at_utc=DAY.format(1),
                 updated_at_utc=DAY.format(1), shipping_revenue=2.5, source_row_id="1")
    line = dict(product_id="p1", quantity=2, unit_price=10.0, item_discount_amount=1.0, source_row_id="1")

    def event(number, kind, at, **payload):
        return dict(event_id=f"{kind}{number}", event_type=kind, occurred_at_utc=at, payload=payload)

    return {
        "city_reference": [dict(city_id="1", city_name="A", country="ID")],
        "customers": [dict(customer_id=c, city_id="1", customer_segment="S", created_at_utc=DAY.format(1), source_row_id=c) for c in ("c1", "c2")],
        "customer_profiles": [dict(customer_id="c1", city_id="1", customer_segment="S", **versions)],
        "customer_addresses": [dict(address_id="a1", customer_id="c1", city_id="1", **versions)],
        "products": [dict(product_id="p1", sku="s", product_name="n", unit_price=10.0, source_row_id="1")],
        "product_categories": [dict(product_id="p1", category_id="k", category_name="K", **versions)],
        "stores": [dict(store_id="1", store_name="S", location_type="MALL", city_id="1", source_row_id="1")],
        "sales_channels": [dict(channel_id="WEB", channel_name="Web", source_row_id="1")],
        "promotions": [dict(promotion_id="pr", promotion_code="X", promotion_type="PCT", discount_rate=0.1,
                            start_date="2026-01-01", end_date="2026-12-31", source_row_id="1")],
        "orders": [dict(order, order_id="o1"), dict(order, order_id="o1", status="RETURN", updated_at_utc=DAY.format(3), source_row_id="2"),
                   dict(order, order_id="o2", customer_id="c2", ordered_at_utc="2026-07-03T02:00:00+07:00"),
                   dict(order, order_id="o3", customer_id="ghost")],
        "order_items": [dict(line, order_item_id="i1", order_id="o1"), dict(line, order_item_id="i1", order_id="o1"),
                        dict(line, order_item_id="i2", order_id="o2", quantity=-1), dict(line, order_item_id="i3", order_id="o2", quantity=1)],
        "order_promotions": [dict(order_id="o1", promotion_id="pr", discount_amount=1, source_row_id="1")],
        "payment_events": [event(1, "PAYMENT_CAPTURED", DAY.format(1), order_id="o1", payment_id="x", amount=21.5)] * 2,
        "refund_events": [event(1, "REFUND_COMPLETED", DAY.format(4), order_id="o1", refund_id="r", amount=5.0)],
        "return_events": [event(1, "RETURN_REQUESTED", DAY.format(4), order_id="o1", return_id="r")],
        "support_events": [event(1, "SUPPORT_TICKET_CREATED", DAY.format(1), reason="x", order_id="o1", ticket_id="t", customer_id="c1")],
        "web_events": [event(1, "click", DAY.format(1), channel="WEB", order_id="o1", session_id="s", campaign_id="k", customer_id="c1")],
        "inventory_snapshots": [dict(product_id="p1", location_id="1", snapshot_date="2026-07-01", available_quantity=0, reserved_quantity=1, unit_cost=3.5)],
        "campaign_spend": [dict(spend_date="2026-07-01", campaign_id="k", channel="WEB", spend_amount=10)],
    }


def write_raw(root, data):
    files = {}
    for name, rows in data.items():
        path = root / SOURCES[name].path
        path.parent.mkdir(parents=True, exist_ok=True)
        if path.suffix == ".json":
            path.write_text(json.dumps(rows))
        else:
            with path.open("w", newline="") as f:
                out = csv.DictWriter(f, list(rows[0]))
                out.writeheader()
                out.writerows(rows)
        files[SOURCES[name].path] = hashlib.sha256(path.read_bytes()).hexdigest()
    (root / "manifest.json").write_text(json.dumps({"files": files, "start_date": "2026-07-01"}))
    return root


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = write_raw(tmp_path_factory.mktemp("raw"), sample())
    out = str(tmp_path_factory.mktemp("lake"))
    run = lambda: medallion.run_medallion(
        spark, str(root), out, run_id="r1", as_of=datetime(2026, 7, 10), with_manifest=True)
    return root, out, run(), run()


def test_second_run_gives_the_same_counts(built):
    _, _, first, second = built
    assert first == second and first["bronze.orders"] == 4 and first["silver.orders"] == 2


def test_gold_values(spark, built):
    gold = GoldTables(spark, built[1])
    orders = {r["order_id"]: r for r in gold.order_360.collect()}
    assert set(orders) == {"o1", "o2"}
    one = orders["o1"]
    assert one["order_status"] == "RETURNED" and one["net_revenue"] == dec("16.50") and one["captured_payment_amount"] == dec("21.50")
    assert str(orders["o2"]["order_date"]) == "2026-07-02" and orders["o2"]["unit_quantity"] == 1
    day = {(r["product_id"], str(r["metric_date"])): r for r in gold.product_daily.collect()}[("p1", "2026-07-01")]
    assert day["stockout_flag"] is True and day["active_category"] == "K" and day["promotion_count"] == 1
    campaign = gold.channel_campaign_daily.collect()[0]
    assert campaign["roas"] == dec("1.6500") and campaign["pipeline_run_id"] == "r1"
    assert questions.answer("q25_last_refresh", gold).head()["last_refresh_utc"] == datetime(2026, 7, 10)


def test_contract_types(spark, built):
    store = LayerStore(spark, built[1], *published(spark, built[1]))
    for name, table in gold_contract().items():
        written = store.read("gold", name)
        assert {(f.name, f.dataType) for f in written.schema} == {(f.name, f.dataType) for f in table.schema}
        assert medallion.contract_gaps(written, table) == ([], [])


def test_every_question_runs_on_the_written_tables(spark, built):
    gold = GoldTables(spark, built[1])
    for key in [*questions.QUESTIONS, *questions.DASHBOARD]:
        assert questions.answer(key, gold, rows=5).count() <= 5


def test_rejects_have_reasons(spark, built):
    run, attempt = published(spark, built[1])
    rows = spark.read.parquet(f"{built[1]}/runs/{run}/{attempt}/rejected_records").collect()
    assert {(r["table_name"], r["record_id"], r["reason"]) for r in rows} == {
        ("orders", "o3", "unknown_customer_id"), ("order_items", "i2", "negative_quantity")}


def test_runs_are_recorded_and_published(spark, built):
    assert current_run(spark, built[1]) == "r1"
    log = ops_runs(spark, built[1])
    assert log.filter("status = 'ok'").count() == 14 and log.filter("status <> 'ok'").count() == 0


def test_gate_stops_before_gold_and_is_recorded(spark, tmp_path):
    data = sample()
    data["orders"] = [dict(data["orders"][0], customer_id="ghost")]
    root = write_raw(tmp_path / "raw", data)
    with pytest.raises(medallion.GateError, match="silver"):
        medallion.run_medallion(spark, str(root), str(tmp_path / "lake"), run_id="bad")
    last = ops_runs(spark, str(tmp_path / "lake")).filter("status = 'failed'").collect()
    assert [(r["stage"], "GateError" in r["error"]) for r in last] == [("quality_gate", True)]
    assert not list((tmp_path / "lake" / "runs" / "bad").glob("*/gold")) and not (tmp_path / "lake" / "published").exists()


def test_missing_and_changed_files(spark, tmp_path):
    root = write_raw(tmp_path, sample())
    assert raw.raw_files_missing(spark, str(root)).count() == 0
    (root / SOURCES["stores"].path).unlink()
    (root / SOURCES["orders"].path).write_text("[]")
    assert [r["source"] for r in raw.raw_files_missing(spark, str(root)).collect()] == ["stores"]
    (root / "reference" / "extra.json").write_text("[]")
    status = raw.manifest_check(spark, str(root), raw.read_manifest(spark, str(root / "manifest.json")), skip=("manifest.json",))
    bad = {r["path"]: r["status"] for r in status.filter(F.col("status") != "ok").collect()}
    assert bad == {SOURCES["stores"].path: "missing", SOURCES["orders"].path: "changed", "reference/extra.json": "unlisted"}


@pytest.mark.parametrize("text", ['{"files": {}}', '{"files": {"a": ', "{}"])
def test_a_manifest_that_lists_nothing_fails(spark, tmp_path, text):
    root = write_raw(tmp_path / "raw", sample())
    (root / "manifest.json").write_text(text)
    with pytest.raises(medallion.GateError, match="lists no file"):
        medallion.run_medallion(spark, str(root), str(tmp_path / "lake"), run_id="m", with_manifest=True)


def test_a_repeated_run_leaves_what_was_published(spark, built):
    folders = list((__import__("pathlib").Path(built[1]) / "runs" / "r1").iterdir())
    assert len(folders) == 2 and published(spark, built[1], "r1")[1] in {f.name for f in folders}


def test_unknown_references_of_every_kind_are_rejected(spark, tmp_path):
    data = sample()
    order = dict(data["orders"][0])
    data["orders"] += [dict(order, order_id="o8", store_id="99"), dict(order, order_id="o9", sales_channel="FAX")]
    data["customers"] += [dict(data["customers"][0], customer_id="c9", city_id="404")]
    data["stores"] += [dict(data["stores"][0], store_id="9", city_id="404")]
    data["support_events"] += [dict(data["support_events"][0], event_id="s9", payload=dict(data["support_events"][0]["payload"], order_id="none"))]
    data["web_events"] += [dict(data["web_events"][0], event_id="w9", payload=dict(data["web_events"][0]["payload"], customer_id="none"))]
    root = write_raw(tmp_path / "raw", data)
    out = str(tmp_path / "lake")
    medallion.run_medallion(spark, str(root), out, run_id="r")
    run, attempt = published(spark, out)
    rows = spark.read.parquet(f"{out}/runs/{run}/{attempt}/rejected_records").collect()
    assert {(r["record_id"], r["reason"]) for r in rows} >= {("o8", "unknown_store_id"), ("o9", "unknown_sales_channel"), ("c9", "unknown_city_id"),
                                                             ("9", "unknown_city_id"), ("s9", "unknown_order_id"), ("w9", "unknown_customer_id")}


def test_one_event_under_two_payment_ids_counts_once(spark, tmp_path):
    data = sample()
    twice = dict(data["payment_events"][0])
    data["payment_events"] = [twice, dict(twice, payload=dict(twice["payload"], payment_id="y"))]
    root = write_raw(tmp_path / "raw", data)
    medallion.run_medallion(spark, str(root), str(tmp_path / "lake"), run_id="p")
    amounts = {r["order_id"]: r["captured_payment_amount"] for r in GoldTables(spark, str(tmp_path / "lake")).order_360.collect()}
    assert amounts["o1"] == dec("21.50")


def test_gold_gate_finds_repeated_keys(spark):
    table = gold_contract()["executive_kpis_daily"]
    row = {f.name: None for f in table.schema}
    df = spark.createDataFrame([tuple(row.values())] * 2, "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in table.schema) + ">")
    with pytest.raises(medallion.GateError, match="1 repeated keys, 2 rows"):
        medallion.check_gold(df, "executive_kpis_daily", table)
