"""Small hand-written inputs; unnamed columns are NULL."""

from decimal import Decimal

SCHEMAS = {
    "orders": "order_id string, customer_id string, sales_channel string, store_id string, status string, "
              "ordered_at_utc string, updated_at_utc string, ingested_at_utc string, shipping_revenue string, source_row_id string",
    "order_items": "order_item_id string, order_id string, product_id string, quantity bigint, unit_price string, "
                   "item_discount_amount string, source_row_id string",
    "payments": "event_id string, event_type string, occurred_at_utc string, order_id string, amount string",
    "refunds": "event_id string, event_type string, occurred_at_utc string, ingested_at_utc string, order_id string, refund_id string, amount string",
    "returns": "event_id string, event_type string, occurred_at_utc string, ingested_at_utc string, order_id string, return_id string",
    "promotions": "order_id string, promotion_id string",
    "support": "event_id string, event_type string, occurred_at_utc string, ingested_at_utc string, customer_id string, ticket_id string",
    "web": "event_id string, event_type string, occurred_at_utc string, order_id string, customer_id string, "
           "campaign_id string, channel string, session_id string",
    "spend": "spend_date string, campaign_id string, channel string, spend_amount string",
    "snapshots": "product_id string, location_id string, snapshot_date string, available_quantity bigint, reserved_quantity bigint",
    "categories": "product_id string, category_name string, valid_from_utc string, valid_to_utc string, source_row_id string",
}
TIMES = {"ordered_at_utc", "updated_at_utc", "ingested_at_utc", "occurred_at_utc", "valid_from_utc", "valid_to_utc"}
MONEY = {"shipping_revenue", "unit_price", "item_discount_amount", "amount", "spend_amount"}


def make(spark, kind, *rows):
    """Rows are dicts; times and money are given as text."""
    schema = SCHEMAS[kind]
    names = [part.split()[0] for part in schema.split(", ")]
    data = [tuple(str(r[n]) if n in MONEY and r.get(n) is not None else r.get(n) for n in names) for r in rows]
    df = spark.createDataFrame(data, schema)
    for n in names:
        if n in TIMES:
            df = df.withColumn(n, df[n].cast("timestamp_ntz"))
        elif n in MONEY:
            df = df.withColumn(n, df[n].cast("decimal(14,2)"))
        elif n in ("snapshot_date", "spend_date"):
            df = df.withColumn(n, df[n].cast("date"))
    return df


def order(order_id="o1", customer_id="c1", day="2026-07-01", **more):
    row = dict(order_id=order_id, customer_id=customer_id, sales_channel="WEB", status="COMPLETED", ordered_at_utc=day,
               updated_at_utc=day, ingested_at_utc=day, shipping_revenue=0, source_row_id=order_id)
    return {**row, **more}


def item(order_id="o1", product_id="p1", quantity=1, price=10, **more):
    row = dict(order_item_id=f"{order_id}-{product_id}", order_id=order_id, product_id=product_id, quantity=quantity,
               unit_price=price, item_discount_amount=0, source_row_id="s")
    return {**row, **more}


def payment(event_type, at, order_id="o1", amount=0, event_id=None):
    return dict(event_id=event_id or f"{event_type}-{at}", event_type=event_type, occurred_at_utc=at, order_id=order_id, amount=amount)


def refund(refund_id, amount, event_id=None, order_id="o1", event_type="REFUND_COMPLETED", at="2026-07-02"):
    return dict(event_id=event_id or f"e-{refund_id}-{amount}", event_type=event_type, occurred_at_utc=at, ingested_at_utc=at,
                order_id=order_id, refund_id=refund_id, amount=amount)


def only(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def dec(x):
    return Decimal(str(x))
