"""Flattening of any depth and the drift of undeclared keys."""

import json

from mercato.plans import flatten
from mercato.schemas import SOURCES

RECORDS = [
    {"event_id": "1", "event_type": "x", "payload": {"order_id": "o", "amount": 1.5, "card": {"kind": "visa", "bin": 1234}}},
    {"event_id": "2", "payload": {"order_id": None, "amount": 2, "card": {"kind": "mc", "checks": [{"a": 1}, 2]}}, "we ird.key": True, "it's": {"x": 1}},
    {"event_id": "3", "payload": {"amount": "text"}, "empty": {}, "none": None},
]


def frame(spark, records):
    return spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r), i) for i, r in enumerate(records)], "raw string, n int")


def test_every_path_is_a_column(spark):
    flat = flatten.flatten_any(frame(spark, RECORDS), keep=("n",))
    assert set(flat.columns) == {"event_id", "event_type", "payload.order_id", "payload.amount", "payload.card.kind", "payload.card.bin",
                                 "payload.card.checks", "we ird.key", "it's.x", "empty", "none", "n"}
    rows = {r["n"]: r.asDict() for r in flat.collect()}
    assert rows[0]["payload.card.bin"] == 1234 and rows[1]["payload.card.checks"] == '[{"a":1},2]' and rows[1]["we ird.key"] is True and rows[1]["it's.x"] == 1
    assert [json.loads(rows[i]["payload.amount"]) for i in range(3)] == [1.5, 2, "text"]  # types differ, so JSON text
    assert rows[2]["empty"] == "{}" and rows[2]["none"] is None and rows[2]["payload.card.kind"] is None and rows[1]["payload.order_id"] is None


def test_unreadable_records_stay_as_rows(spark):
    flat = flatten.flatten_any(frame(spark, [*RECORDS, "{broken", None, "7"]), keep=("n",))
    assert flat.count() == 6
    assert flatten.found_leaves(frame(spark, ["{broken", None])) == []


def test_a_map_with_many_keys_stays_text(spark, monkeypatch):
    monkeypatch.setattr(flatten, "MOST_KEYS", 5)
    record = {"id": 1, "counts": {f"k{i}": i for i in range(9)}}
    flat = flatten.flatten_any(frame(spark, [record]))
    assert flat.columns == ["counts", "id"] and json.loads(flat.head()["counts"]) == record["counts"]


def test_drift_names_undeclared_and_absent_paths(spark):
    got = {(r["path"], r["kind"], r["record_count"], r["declared"]) for r in flatten.drift(frame(spark, RECORDS), SOURCES["payment_events"]).collect()}
    assert got == {("payload.card.kind", "string", 2, False), ("payload.card.bin", "bigint", 1, False), ("payload.card.checks", "json", 1, False),
                   ("we ird.key", "boolean", 1, False), ("it's.x", "bigint", 1, False), ("empty", "json", 1, False), ("none", "json", 0, False),
                   ("occurred_at_utc", None, 0, True), ("payload.payment_id", None, 0, True)}
