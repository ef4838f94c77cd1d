"""Retail sources derived from a star schema (orders, lineitem, part, ...).

Each view reads every row of its tables once. The defects the silver and gold
layers must cope with (repeated orders, split captures, repeated events, negative
quantities, stale category rows) are planted as *extra* rows or changed values.
Copies are produced by exploding a small array of copy numbers, so the base table
is scanned once and unused columns are still pruned from the scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_settings, deal_by_size

# Declared, so that no job is started to infer a schema.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


class StarViews:
    """Silver-shaped retail tables over one folder of star-schema Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder
        deal_by_size(spark, [f"{folder}/{name}.parquet" for name in TABLES])

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    # ---- operational ----------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        """One row per order plus a later RETURNED version of every twentieth."""
        src = self.table("orders").selectExpr(
            "*", "explode(array_compact(array(1, if(o_orderkey % 20 = 0, 9, NULL)))) AS age"
        )
        return src.selectExpr(
            "string(o_orderkey) AS order_id",
            "string(o_custkey) AS customer_id",
            "o_orderpriority AS sales_channel",
            "if(o_orderkey % 4 = 0, NULL, string(o_orderkey % 12)) AS store_id",
            """CASE WHEN age = 9 THEN 'RETURNED' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
                    WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'CANCELLED' END AS status""",
            "o_orderdate AS ordered_at_utc",
            "o_orderdate + make_dt_interval(age) AS updated_at_utc",
            "o_orderdate + make_dt_interval(age + 1) AS ingested_at_utc",
            "(o_orderkey % 25)::decimal(14,2) AS shipping_revenue",
            "concat(if(age = 9, 'dup-', ''), string(o_orderkey)) AS source_row_id",
        )

    @cached_property
    def order_items(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS order_item_id",
            "string(l_orderkey) AS order_id",
            "string(l_partkey) AS product_id",
            "if((l_orderkey + l_linenumber) % 97 = 0, -1, 1) * bigint(l_quantity) AS quantity",
            "l_extendedprice::decimal(14,2) AS unit_price",
            "(l_extendedprice::decimal(14,2) * l_discount::decimal(4,2))::decimal(14,2) AS item_discount_amount",
            "concat(l_partkey, '-', l_suppkey, '-', int(l_quantity)) AS source_row_id",
        )

    @cached_property
    def order_promotions(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "string(l_orderkey) AS order_id",
            "concat('PR-', int(round(l_discount * 100, 0))) AS promotion_id",
            "(l_extendedprice::decimal(14,2) * l_discount::decimal(4,2))::decimal(14,2) AS discount_amount",
        )

    @cached_property
    def customers(self) -> DataFrame:
        """Customers in debt stand under an archived id, so their orders are orphans."""
        return self.table("customer").selectExpr(
            "concat(if(c_acctbal < 0, 'archived-', ''), c_custkey) AS customer_id", "string(c_nationkey) AS city_id",
            "c_mktsegment AS customer_segment", "concat('c-', c_custkey) AS source_row_id",
        )

    @cached_property
    def customer_profiles(self) -> DataFrame:
        """Two versions per customer, and an overlapping third for rich customers."""
        src = self.table("customer").selectExpr(
            "*", "explode(array_compact(array(1, 2, if(c_acctbal > 5000, 3, NULL)))) AS version"
        )
        return src.selectExpr(
            "string(c_custkey) AS customer_id",
            "string(c_nationkey) AS city_id",
            "CASE version WHEN 1 THEN c_mktsegment WHEN 2 THEN 'LOYAL' ELSE 'TRIAL' END AS customer_segment",
            """CASE version WHEN 1 THEN TIMESTAMP_NTZ '1994-01-01' WHEN 2 THEN TIMESTAMP_NTZ '1997-06-15'
                    ELSE TIMESTAMP_NTZ '1997-01-01' END AS valid_from_utc""",
            """CASE version WHEN 1 THEN TIMESTAMP_NTZ '1997-06-15'
                    WHEN 3 THEN TIMESTAMP_NTZ '1999-01-01' END AS valid_to_utc""",
            "concat('v-', version, '-', c_custkey) AS source_row_id",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "string(p_partkey) AS product_id", "concat('SKU-', p_partkey) AS sku", "p_name AS product_name",
            "p_retailprice::decimal(14,2) AS unit_price", "string(p_partkey) AS source_row_id",
        )

    @cached_property
    def product_categories(self) -> DataFrame:
        """Two versions per product; every tenth has a stale copy of the second."""
        src = self.table("part").selectExpr(
            "*", "explode(array_compact(array('first', 'second', if(p_partkey % 10 = 0, 'stale', NULL)))) AS kind"
        )
        return src.selectExpr(
            "string(p_partkey) AS product_id",
            "CASE kind WHEN 'first' THEN p_type WHEN 'stale' THEN 'STALE' ELSE p_brand END AS category_name",
            "if(kind = 'first', DATE '1995-01-01', DATE '1998-01-01') AS valid_from_utc",
            "if(kind = 'first', DATE '1998-01-01', NULL) AS valid_to_utc",
            "concat(CASE kind WHEN 'first' THEN '' WHEN 'stale' THEN 'a' ELSE 'b' END, p_partkey) AS source_row_id",
        )

    @cached_property
    def cities(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "string(n_nationkey) AS city_id", "n_name AS city_name", "string(n_regionkey) AS country"
        )

    # ---- events ---------------------------------------------------------
    @cached_property
    def payment_events(self) -> DataFrame:
        """Authorisation, captures (some split, repeated or zero) and failures; some name an unknown order."""
        src = (
            self.table("orders")
            .selectExpr(
                "*",
                "concat(if(o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED', 'lost-', ''), o_orderkey) AS paid_order",
                "(o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT') AS captured",
                "(o_orderstatus = 'P' AND o_orderpriority = '2-HIGH') AS failed",
                "o_totalprice::decimal(14,2) AS total",
            )
            .selectExpr(
                "*",
                """explode(array_compact(array('auth', if(captured, 'cap1', NULL),
                     if(captured AND o_orderkey % 11 = 0, 'cap1', NULL),
                     if(captured AND o_orderkey % 5 = 0, 'cap2', NULL), if(failed, 'fail', NULL)))) AS kind""",
            )
        )
        return src.selectExpr(
            "concat(kind, '-', o_orderkey) AS event_id",
            """CASE kind WHEN 'auth' THEN 'PAYMENT_AUTHORIZED' WHEN 'fail' THEN 'PAYMENT_FAILED'
                    ELSE 'PAYMENT_CAPTURED' END AS event_type""",
            """o_orderdate + make_dt_interval(0, CASE kind WHEN 'auth' THEN 0 WHEN 'cap1' THEN 1
                    WHEN 'cap2' THEN 2 ELSE 3 END) AS occurred_at_utc""",
            "paid_order AS order_id",
            "concat('PAY-', o_orderkey) AS payment_id",
            """CASE WHEN kind = 'auth' THEN total WHEN kind = 'fail' OR o_orderkey % 101 = 0 THEN 0::decimal(14,2)
                    WHEN o_orderkey % 5 = 0 THEN (total * 0.5)::decimal(14,2) ELSE total END AS amount""",
        )

    @cached_property
    def refund_events(self) -> DataFrame:
        """Refunds of returned lines; third lines arrive twice."""
        src = self.table("lineitem").filter("l_returnflag = 'R'").selectExpr(
            "*", "explode(if(l_linenumber = 3, array(0, 1), array(0))) AS copy"
        )
        return src.selectExpr(
            "concat('rf-', l_orderkey, '-', l_linenumber, '-', l_partkey % 2) AS event_id",
            "if(l_linestatus = 'F', 'REFUND_COMPLETED', 'REFUND_REQUESTED') AS event_type",
            "l_shipdate + INTERVAL 5 DAY AS occurred_at_utc",
            "l_shipdate + make_dt_interval(5 + int(l_suppkey % 3)) AS ingested_at_utc",
            "string(l_orderkey) AS order_id",
            "concat('RF-', l_orderkey, '-', l_linenumber) AS refund_id",
            "(l_extendedprice::decimal(14,2) * 0.5)::decimal(14,2) AS amount",
        )

    @cached_property
    def return_events(self) -> DataFrame:
        """Returned lines; third lines arrive twice, first under another return id and a later time."""
        src = self.table("lineitem").filter("l_returnflag = 'R'").selectExpr(
            "*", "explode(if(l_linenumber = 3, array(0, 1), array(0))) AS early"
        )
        return src.selectExpr(
            "concat('rt-', l_orderkey, '-', l_linenumber, '-', l_linestatus) AS event_id",
            "if(l_linestatus = 'F', 'RETURN_COMPLETED', 'RETURN_REQUESTED') AS event_type",
            "l_shipdate + make_dt_interval(3 + early) AS occurred_at_utc",
            "l_shipdate + make_dt_interval(6 - early) AS ingested_at_utc",
            "string(l_orderkey) AS order_id",
            "concat('RET-', l_orderkey, if(early = 1, '-first', '')) AS return_id",
        )

    @cached_property
    def support_events(self) -> DataFrame:
        """A ticket per order; every seventh arrives twice, first with a later time and another ticket."""
        src = self.table("orders").selectExpr("*", "explode(if(o_orderkey % 7 = 0, array(0, 1), array(0))) AS early")
        return src.selectExpr(
            "concat('su-', o_orderkey) AS event_id",
            "if(o_orderstatus = 'P', 'SUPPORT_TICKET_CLOSED', 'SUPPORT_TICKET_CREATED') AS event_type",
            "o_orderdate + make_dt_interval(early, 6) AS occurred_at_utc",
            "o_orderdate + make_dt_interval(3 - early) AS ingested_at_utc",
            "string(o_custkey) AS customer_id",
            "string(o_orderkey) AS order_id",
            "if(o_orderkey % 3 = 0, NULL, concat('T', o_orderkey, if(early = 1, '-first', ''))) AS ticket_id",
        )

    @cached_property
    def web_events(self) -> DataFrame:
        """Four consecutive events per order; purchases and clicks name it."""
        hits = self.table("events").selectExpr(
            "event_id", "event_type", "user_id", "int(regexp_extract(props, '[0-9]+', 0)) AS hit",
            "event_id DIV 4 AS web_order",
        )
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        return hits.join(orders, hits["web_order"] == orders["o_orderkey"]).selectExpr(
            "string(event_id) AS event_id",
            "event_type",
            "o_orderdate + make_dt_interval(-1, int(event_id % 3)) AS occurred_at_utc",
            "if(event_type IN ('purchase', 'click'), string(o_orderkey), NULL) AS order_id",
            "string(user_id) AS customer_id",
            "if(hit % 5 = 0, NULL, concat('CMP-', hit % 8)) AS campaign_id",
            "if(event_id % 2 = 0, 'WEB', 'MOBILE') AS channel",
            "concat(user_id, '-', event_id % 6) AS session_id",
        )

    # ---- inventory and campaign reference -------------------------------
    @cached_property
    def inventory_snapshots(self) -> DataFrame:
        """A count on every ship date, and for open lines also on the order date."""
        lines = self.table("lineitem")
        shipped = lines.selectExpr(
            "string(l_partkey) AS product_id",
            "string(l_suppkey % 3) AS location_id",
            "l_shipdate AS snapshot_date",
            "(l_partkey * 7 + l_suppkey) % 40 - 8 AS available_quantity",
            "bigint(l_linenumber) AS reserved_quantity",
        )
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        opened = lines.filter("l_linestatus = 'O'").join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
            "string(l_partkey) AS product_id",
            "'0' AS location_id",
            "o_orderdate AS snapshot_date",
            "(l_partkey + o_orderkey) % 30 - 5 AS available_quantity",
            "1L AS reserved_quantity",
        )
        return shipped.unionByName(opened)

    @cached_property
    def campaign_spend(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "date(o_orderdate) AS spend_date",
            "concat('CMP-', o_orderkey % 9) AS campaign_id",
            "if(o_orderkey % 2 = 0, 'WEB', 'MOBILE') AS channel",
            "if(o_orderkey % 17 = 0, 0, 50 + o_orderkey % 400)::decimal(14,2) AS spend_amount",
        ).distinct()
