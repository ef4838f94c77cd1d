"""Bronze and silver rules on small raw records."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from mercato.functions.clean import canonical, utc
from mercato.plans import bronze, silver
from mercato.schemas import SOURCES, STATUS_ALIASES
from mercato.sources import raw
from makers import dec, only

LOADED = datetime(2026, 7, 10)


def records(spark, table, *rows):
    texts = [(r if isinstance(r, str) else json.dumps(r), "f.json", i) for i, r in enumerate(rows)]
    df = spark.createDataFrame(texts, "raw string, file_name string, row_number int")
    return bronze.with_lineage(df, SOURCES[table], "run", LOADED)


def checked(spark, table, *rows):
    return silver.checked(records(spark, table, *rows), SOURCES[table])


ITEM = dict(order_item_id="i1", order_id="o1", product_id="p1", quantity=2, unit_price=10.5, item_discount_amount=1, source_row_id="r1")


@pytest.mark.parametrize("text,want", [
    ("2026-06-22T01:00:00+07:00", "2026-06-21 18:00:00"),
    ("2026-06-22T01:00:00Z", "2026-06-22 01:00:00"),
    ("2026-06-22 01:00:00", "2026-06-22 01:00:00"),
    ("2026-06-22T01:00:00.250-05:00", "2026-06-22 06:00:00"),
    ("2026/06/22 01:00:00", "2026-06-22 01:00:00"),
    ("2026-06-22", "2026-06-22 00:00:00"),
    ("yesterday", None), (None, None), ("", None),
])
def test_utc(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert only(df.select(F.date_format(utc("t"), "yyyy-MM-dd HH:mm:ss").alias("u")))["u"] == want


def test_zoneless_text_uses_the_source_zone(spark):
    df = spark.createDataFrame([("2026-06-22 01:00:00",), ("2026-06-22T01:00:00Z",)], "t string")
    got = [r[0] for r in df.select(F.date_format(utc("t", "Asia/Jakarta"), "dd HH")).collect()]
    assert got == ["21 18", "22 01"]


def test_canonical_status(spark):
    df = spark.createDataFrame([(" complete ",), ("Canceled",), ("payment captured",), (None,)], "s string")
    assert [r[0] for r in df.select(canonical("s", STATUS_ALIASES)).collect()] == ["COMPLETED", "CANCELLED", "PAYMENT_CAPTURED", None]


@pytest.mark.parametrize("change,reason", [
    (dict(quantity=-2), "negative_quantity"), (dict(quantity="two"), "bad_quantity"), (dict(quantity=1.5), "bad_quantity"),
    (dict(order_id=None), "missing_order_id"), (dict(quantity=None), "missing_quantity"), (dict(unit_price="x"), "bad_unit_price"),
])
def test_rejected_with_reason(spark, change, reason):
    row = only(silver.rejected(checked(spark, "order_items", {**ITEM, **change}), "order_items", SOURCES["order_items"]))
    assert (row["table_name"], row["record_id"], row["reason"]) == ("order_items", "i1", reason)
    assert json.loads(row["raw"])["order_item_id"] == "i1"


def test_good_record_is_typed_and_traceable(spark):
    row = only(silver.accepted(checked(spark, "order_items", {**ITEM, "quantity": "5.0", "unit_price": 12345678.9}), SOURCES["order_items"]))
    assert (row["quantity"], row["unit_price"], row["run_id"], row["file_name"]) == (5, dec("12345678.90"), "run", "f.json")
    assert len(row["record_sha"]) == 64


def test_unreadable_record(spark):
    row = only(silver.rejected(checked(spark, "order_items", "{broken"), "order_items", SOURCES["order_items"]).filter("reason LIKE 'unread%'"))
    assert row["raw"] == "{broken"


def test_events_open_their_payload_and_exact_copies_collapse(spark):
    event = dict(event_id="e", event_type="refund-completed", occurred_at_utc="2026-07-01T00:00:00Z", payload=dict(order_id="o", refund_id="r", amount=5))
    changed = {**event, "payload": {**event["payload"], "amount": 7}}
    rows = silver.accepted(checked(spark, "refund_events", event, event, changed), SOURCES["refund_events"]).collect()
    assert {(r["event_type"], r["amount"]) for r in rows} == {("REFUND_COMPLETED", dec(5)), ("REFUND_COMPLETED", dec(7))}
    assert len(rows) == 2


def test_items_keep_one_row_per_id(spark):
    rows = checked(spark, "order_items", {**ITEM, "source_row_id": "b"}, {**ITEM, "source_row_id": "a", "quantity": 9})
    assert only(silver.accepted(rows, SOURCES["order_items"]))["quantity"] == 9


def test_orphans_are_marked_not_lost(spark):
    rows = checked(spark, "order_items", ITEM, {**ITEM, "order_item_id": "i2", "order_id": "nope"}, {**ITEM, "order_item_id": "i3", "order_id": "nope"})
    known = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    orphans = silver.orphan_keys(rows, SOURCES["order_items"].references[0], known)
    assert tuple(only(orphans)) == ("nope", 2)
    marked = silver.mark_unknown(rows, {"order_id": orphans})
    assert only(silver.accepted(marked, SOURCES["order_items"]))["order_item_id"] == "i1"
    assert {r["record_id"]: r["reason"] for r in silver.rejected(marked, "order_items", SOURCES["order_items"]).collect()} == {
        "i2": "unknown_order_id", "i3": "unknown_order_id"}


def test_json_layouts_and_numbering(spark, tmp_path):
    rows = [dict(city_id="1", city_name="A", surprise={"x": [1, 2]}), dict(city_id="2", city_name="B")]
    array, lines = tmp_path / "array.json", tmp_path / "lines.json"
    array.write_text(json.dumps(rows, indent=1))
    lines.write_text("\n".join(map(json.dumps, rows)) + "\n\n")
    source = SOURCES["city_reference"]
    found = raw.files_by_layout(spark, str(tmp_path))
    assert {k: [f.rsplit("/", 1)[1] for f in v] for k, v in found.items()} == {raw.ARRAY: ["array.json"], raw.LINES: ["lines.json"]}
    for path in (array, lines):
        got = raw.raw_records(spark, str(path), source).collect()
        assert sorted((json.loads(r["raw"]) for r in got), key=lambda r: r["city_id"]) == rows
        assert {r["file_name"] for r in got} == {path.name}
    numbered = raw.raw_records(spark, str(array), source).orderBy("row_number").collect()
    assert [(r["row_number"], json.loads(r["raw"])["city_id"]) for r in numbered] == [(0, "1"), (1, "2")]
    typed = raw.scan_json(spark, str(array), "city_id string, country string")
    assert {tuple(r) for r in typed.collect()} == {("1", None), ("2", None)}


def test_broken_array_is_reported_and_empty_array_is_not(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"city_id": "1"},')
    (tmp_path / "b.json").write_text("[]")
    source = SOURCES["city_reference"]
    found = raw.raw_records(spark, str(tmp_path), source, raw.ARRAY)
    assert only(found)["file_name"] == "a.json"
    rows = silver.checked(bronze.with_lineage(found, source, "run", LOADED), source)
    assert "unreadable_record" in only(rows)["_reasons"]


def test_csv_records_become_json_text(spark, tmp_path):
    path = tmp_path / "spend.csv"
    path.write_text("spend_date,campaign_id,channel,spend_amount\n2026-07-01,c1,WEB,12.50\n2026-07-02,c1,WEB,abc\n")
    source = SOURCES["campaign_spend"]
    rows = silver.checked(bronze.with_lineage(raw.raw_records(spark, str(path), source), source, "run", LOADED), source)
    assert only(silver.accepted(rows, source))["spend_amount"] == dec("12.50")
    assert only(silver.rejected(rows, "campaign_spend", source))["reason"] == "bad_spend_amount"


def test_all_sources_parse_an_empty_object(spark):
    for table, source in SOURCES.items():
        row = only(checked(spark, table, "{}"))
        assert set(row["_reasons"]) == {f"missing_{c}" for c in source.required}, table
