"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in entry._TEXT_ORACLES}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    own = set(entry.queries()) - set(entry._TEXT_QUERIES)
    assert set(ORACLES) == own


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, key):
    ok, note = compare(spark, duck, key, FOLDER, ORACLES[key])
    assert ok, note


def test_file_queries(spark):
    missing = entry.queries()["raw_files_missing"](spark, FOLDER)
    assert missing.count() == 15
    status = {tuple(r) for r in entry.queries()["manifest_check"](spark, FOLDER).select("feed", "status").collect()}
    assert ("products", "changed") in status and ("customers", "ok") in status and ("events", "missing") not in status


def test_orphans_of_every_feed(spark):
    found = entry.queries()["silver_orphans_all"](spark, FOLDER)
    pairs = {(r.feed, r.column_name) for r in found.select("feed", "column_name").distinct().collect()}
    assert {("orders", "customer_id"), ("customer_profiles", "customer_id"), ("payment_events", "order_id")} <= pairs


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
