"""Plans that keep a task's share of the work small as the tables grow."""

import pytest
from pyspark.sql import functions as F

from mercato import session
from mercato.operators import checks as c
from mercato.operators.versions import segments
from mercato.plans import checks, products
from mercato.sources import arrays, raw
from mercato.sources.star_views import StarViews

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def kept_settings(spark):
    before = {k: spark.conf.get(k, None) for k in (_INITIAL, _LEAST, "spark.sql.autoBroadcastJoinThreshold")}
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_shuffles_begin_with_a_partition_for_every_few_bytes_of_input(spark, tmp_path, monkeypatch, kept_settings):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(20_000).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    StarViews(spark, str(tmp_path))
    assert int(spark.conf.get(_INITIAL)) == least
    monkeypatch.setattr(session, "_INPUT_BYTES", 500)
    size = sum(p.stat().st_size for p in (tmp_path / "orders.parquet").iterdir() if not p.name.startswith("."))
    StarViews(spark, str(tmp_path))  # the other tables are absent
    assert int(spark.conf.get(_INITIAL)) >= max(least + 1, size // 500)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_partitions_are_not_joined_up_and_scans_are_cut(spark, tmp_path, monkeypatch, kept_settings):
    """A task's share of a large shuffle, or of a large table, is that of a small one."""
    spark.range(20_000).select(F.col("id").alias("o_orderkey")).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(session, "_INPUT_BYTES", 2000)
    StarViews(spark, str(tmp_path))
    assert spark.conf.get(_LEAST) == spark.conf.get(_INITIAL)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_a_trace_finds_the_wanted_orders_once(spark):
    wanted = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "order_id string")
    columns = "order_id string, event_id string, event_type string, occurred_at_utc string"
    paid = spark.createDataFrame([("a", "1", "x", "t"), ("a", "1", "x", "t"), ("b", "2", "x", "t"), (None, "3", "x", "t")], columns)
    back = spark.createDataFrame([("z", "4", "y", "t"), ("c", "5", "y", "t")], columns)
    found = checks.event_trace(wanted, payment=paid, refund=paid.limit(0), **{"return": back})
    assert plan(found).count("Join ") == 1
    assert found.columns == ["order_id", "source", "event_id", "event_type", "occurred_at_utc", "amount"]
    got = sorted((r["order_id"], r["source"], r["event_id"]) for r in found.collect())
    assert got == [("a", "payment", "1"), ("a", "payment", "1"), ("z", "return", "4")]


def test_only_distinct_borders_of_versions_are_numbered(spark):
    rows = [("k", f"2000-01-{1 + i % 5:02d}", f"2000-02-{1 + i % 7:02d}", f"{i:04d}") for i in range(300)]
    versions = spark.createDataFrame(rows, "id string, valid_from_utc string, valid_to_utc string, source_row_id string")
    found = segments(versions, "id", ["source_row_id"])
    lines = plan(found).splitlines()
    numbering = [i for i, line in enumerate(lines) if "Window" in line and "_first" in line and ("row_number()" in line or "dense_rank(" in line)]
    assert numbering and all("Aggregate [_key" in lines[i + 1] for i in numbering)
    got = [(str(r["_first"]), str(r["_until"]), r["source_row_id"]) for r in found.orderBy("_first").collect()]
    assert got[0] == ("2000-01-01", "2000-01-02", "0295") and got[-1][1] == "2000-02-07" and len(got) == 11


def test_lines_are_not_multiplied_by_their_orders_promotions(spark):
    items = spark.createDataFrame([("o", "p", 2, "10.00", "1.00"), ("o", "q", 1, "5.00", "0.00"), ("n", "p", 1, "10.00", "0.50")],
                                  "order_id string, product_id string, quantity long, unit_price string, item_discount_amount string").withColumns(
        {x: F.col(x).cast("decimal(14,2)") for x in ("unit_price", "item_discount_amount")})
    facts = spark.createDataFrame([("o", "2000-01-01", 3), ("n", "2000-01-01", 0)], "order_id string, order_date string, refunded_amount int")
    promotions = spark.createDataFrame([("o", "A"), ("o", "B"), ("o", "B"), ("o", None), ("n", "B"), ("n", "C")], "order_id string, promotion_id string")
    found = products.product_measures_daily(items, facts, promotions)
    assert "count(distinct" not in plan(found)
    got = {r["product_id"]: (r["units_sold"], r["order_count"], float(r["gross_revenue"]), float(r["discount_amount"]), r["refunded_units"],
                             float(r["refund_amount"]), r["promotion_count"]) for r in found.collect()}
    assert got == {"p": (3, 2, 30.0, 1.5, 2, 20.0, 3), "q": (1, 1, 5.0, 0.0, 1, 5.0, 2)}


def test_lines_are_numbered_where_they_are(spark, tmp_path, kept_settings):
    (tmp_path / "a.json").write_text('{"a": 1}\n\n{"a": 2}\n')
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = raw.line_records(spark, str(tmp_path))
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["raw"], r["row_number"]) for r in found.orderBy("row_number").collect()] == [('{"a": 1}', 0), ('{"a": 2}', 2)]


def test_long_arrays_are_cut_and_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[null, {"a": "x]}"},\n {"b": [1, {"c": 2}]}]')
    found = arrays.split_array_records(spark, str(tmp_path))
    assert "FileScan text" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["raw"], r["row_number"]) for r in found.orderBy("row_number").collect()] == [("null", 0), ('{"a":"x]}"}', 1), ('{"b":[1,{"c":2}]}', 2)]


def test_a_profile_computes_its_input_once(spark):
    found = c.exact_profile(spark.range(101).select(F.col("id").alias("x")), ["x"])
    assert "Range (" not in plan(found)
    row = found.head()
    assert (row["count"], row["q25"], row["q50"], row["q75"]) == (101, 25.0, 50.0, 75.0)
