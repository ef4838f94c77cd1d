"""Declared schemas: 19 raw sources, the silver rules for each, and the gold contract."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = "decimal(14,2)"
RATIO = "decimal(14,4)"


@dataclass(frozen=True)
class Reference:
    """``column`` must occur as ``target_column`` in ``target`` (NULL is not an orphan)."""

    column: str
    target: str
    target_column: str


@dataclass(frozen=True)
class Source:
    """One raw feed and what silver demands of it.

    ``columns`` maps silver name -> type; ``time`` is an instant given as text.
    ``nested`` names the columns that sit under ``payload`` in the raw record.
    """

    path: str
    columns: dict[str, str]
    record_id: str
    required: tuple[str, ...]
    nested: tuple[str, ...] = ()
    unique_by: tuple[str, ...] = ()
    newest: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    not_negative: tuple[str, ...] = ()
    statuses: tuple[str, ...] = ()
    ties: tuple[str, ...] = ()

    @property
    def format(self) -> str:
        return "csv" if self.path.endswith(".csv") else "json"

    @property
    def silver_columns(self) -> list[str]:
        return list(self.columns)


def _versioned(path: str, extra: dict[str, str], record_id: str, keys: tuple[str, ...], refs=()) -> Source:
    return Source(
        path, {**extra, "valid_from_utc": "time", "valid_to_utc": "time", "source_row_id": "string"},
        record_id=record_id, required=(*keys, "valid_from_utc"),
        unique_by=(*keys, "valid_from_utc"), newest=("source_row_id",), references=refs,
    )


def _events(path: str, payload: dict[str, str], refs=(), required=(), apart: tuple[str, ...] = ()) -> Source:
    """``apart``: payload that does not tell events apart; the smallest value stays."""
    return Source(
        path, {"event_id": "string", "event_type": "string", "occurred_at_utc": "time", **payload},
        record_id="event_id", required=("event_id", "event_type", "occurred_at_utc", *required),
        nested=tuple(payload), references=refs, statuses=("event_type",),
        unique_by=("event_id", "event_type", "occurred_at_utc", *[c for c in payload if c not in apart]), ties=apart,
    )


_ORDER = Reference("order_id", "orders", "order_id")
_PRODUCT = Reference("product_id", "products", "product_id")
_CUSTOMER = Reference("customer_id", "customers", "customer_id")
_CITY = Reference("city_id", "city_reference", "city_id")
_STORE = Reference("store_id", "stores", "store_id")
_CHANNEL = Reference("sales_channel", "sales_channels", "channel_id")

# File paths, column names and types of the raw feeds.
SOURCES: dict[str, Source] = {
    "city_reference": Source(
        "reference/city_reference.json", {"city_id": "string", "country": "string", "city_name": "string"},
        record_id="city_id", required=("city_id",), unique_by=("city_id",)),
    "customers": Source(
        "operational/customers.json",
        {"customer_id": "string", "city_id": "string", "customer_segment": "string", "created_at_utc": "time", "source_row_id": "string"},
        record_id="customer_id", required=("customer_id",), unique_by=("customer_id",), newest=("created_at_utc",), references=(_CITY,)),
    "customer_profiles": _versioned(
        "operational/customer_profiles.json", {"customer_id": "string", "city_id": "string", "customer_segment": "string"},
        "customer_id", ("customer_id",), (_CUSTOMER, _CITY)),
    "customer_addresses": _versioned(
        "operational/customer_addresses.json", {"address_id": "string", "customer_id": "string", "city_id": "string"},
        "address_id", ("address_id",), (_CUSTOMER, _CITY)),
    "products": Source(
        "operational/products.json",
        {"product_id": "string", "sku": "string", "product_name": "string", "unit_price": MONEY, "source_row_id": "string"},
        record_id="product_id", required=("product_id",), unique_by=("product_id",), newest=("source_row_id",)),
    "product_categories": _versioned(
        "operational/product_categories.json", {"product_id": "string", "category_id": "string", "category_name": "string"},
        "product_id", ("product_id",), (_PRODUCT,)),
    "stores": Source(
        "operational/stores.json",
        {"store_id": "string", "store_name": "string", "location_type": "string", "city_id": "string", "source_row_id": "string"},
        record_id="store_id", required=("store_id",), unique_by=("store_id",), newest=("source_row_id",), references=(_CITY,)),
    "sales_channels": Source(
        "operational/sales_channels.json", {"channel_id": "string", "channel_name": "string", "source_row_id": "string"},
        record_id="channel_id", required=("channel_id",), unique_by=("channel_id",), newest=("source_row_id",)),
    "promotions": Source(
        "operational/promotions.json",
        {"promotion_id": "string", "promotion_code": "string", "promotion_type": "string", "discount_rate": "double",
         "start_date": "day", "end_date": "day", "source_row_id": "string"},
        record_id="promotion_id", required=("promotion_id",), unique_by=("promotion_id",), newest=("source_row_id",)),
    "orders": Source(
        "operational/orders.json",
        {"order_id": "string", "customer_id": "string", "sales_channel": "string", "store_id": "string", "status": "string",
         "ordered_at_utc": "time", "updated_at_utc": "time", "shipping_revenue": MONEY, "source_row_id": "string"},
        record_id="order_id", required=("order_id", "customer_id", "sales_channel", "ordered_at_utc", "updated_at_utc"),
        unique_by=("order_id",), newest=("updated_at_utc", "ingested_at_utc"),
        references=(_CUSTOMER, _STORE, _CHANNEL), statuses=("status",)),
    "order_items": Source(
        "operational/order_items.json",
        {"order_item_id": "string", "order_id": "string", "product_id": "string", "quantity": "bigint", "unit_price": MONEY,
         "item_discount_amount": MONEY, "source_row_id": "string"},
        record_id="order_item_id", required=("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
        unique_by=("order_item_id",), newest=("ingested_at_utc",), references=(_ORDER, _PRODUCT), not_negative=("quantity",)),
    "order_promotions": Source(
        "operational/order_promotions.json",
        {"order_id": "string", "promotion_id": "string", "discount_amount": MONEY, "source_row_id": "string"},
        record_id="source_row_id", required=("order_id", "promotion_id"), unique_by=("order_id", "promotion_id", "source_row_id"),
        references=(_ORDER, Reference("promotion_id", "promotions", "promotion_id"))),
    "payment_events": _events(
        "events/payment_events.json", {"order_id": "string", "payment_id": "string", "amount": MONEY}, (_ORDER,), ("order_id",), ("payment_id",)),
    "refund_events": _events(
        "events/refund_events.json", {"order_id": "string", "refund_id": "string", "amount": MONEY}, (_ORDER,), ("order_id",)),
    "return_events": _events(
        "events/return_events.json", {"order_id": "string", "return_id": "string"}, (_ORDER,), ("order_id",)),
    "support_events": _events(
        "events/support_events.json", {"reason": "string", "order_id": "string", "ticket_id": "string", "customer_id": "string"},
        (_CUSTOMER, _ORDER), ("customer_id",)),
    "web_events": _events(
        "events/web_events.json",
        {"channel": "string", "order_id": "string", "session_id": "string", "campaign_id": "string", "customer_id": "string"}, (_ORDER, _CUSTOMER)),
    "inventory_snapshots": Source(
        "inventory/inventory_snapshots.csv",
        {"product_id": "string", "location_id": "string", "snapshot_date": "day", "available_quantity": "bigint",
         "reserved_quantity": "bigint", "unit_cost": MONEY},
        record_id="product_id", required=("product_id", "location_id", "snapshot_date"),
        unique_by=("product_id", "location_id", "snapshot_date", "available_quantity", "reserved_quantity", "unit_cost"),
        references=(_PRODUCT,)),
    "campaign_spend": Source(
        "reference/campaign_spend.csv",
        {"spend_date": "day", "campaign_id": "string", "channel": "string", "spend_amount": MONEY},
        record_id="campaign_id", required=("spend_date", "campaign_id", "channel")),
}

# Spellings a source may use for a canonical status.
STATUS_ALIASES = {"COMPLETE": "COMPLETED", "CANCELED": "CANCELLED", "CANCEL": "CANCELLED", "RETURN": "RETURNED"}


def _contract(keys: tuple[str, ...], nullable: tuple[str, ...], by_date: bool = False, **columns: str) -> "GoldTable":
    kinds = {"pipeline_run_id": "string", **columns}
    order = [*columns, "pipeline_run_id"]
    fields = [T.StructField(c, T.DataType.fromDDL(kinds[c]), c in nullable) for c in order]
    return GoldTable(T.StructType(fields), keys, by_date=by_date)


@dataclass(frozen=True)
class GoldTable:
    schema: T.StructType
    keys: tuple[str, ...]
    date: str = field(default="metric_date")
    by_date: bool = False  # laid out in one folder per date

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


# Names, order, types and nullability of the gold columns.
def gold_contract() -> dict[str, GoldTable]:
    order_360 = _contract(
        ("order_id",), ("store_id",),
        order_id="string", customer_id="string", order_date="date", sales_channel="string", store_id="string",
        gross_merchandise_value=MONEY, discount_amount=MONEY, shipping_revenue=MONEY, captured_payment_amount=MONEY,
        refunded_amount=MONEY, net_revenue=MONEY, item_count="int", unit_quantity="int", order_status="string",
        payment_status="string", return_status="string", promotion_count="int", first_order_flag="boolean")
    return {
        "order_360": GoldTable(order_360.schema, order_360.keys, "order_date", by_date=True),
        "customer_daily": _contract(
            ("customer_id", "metric_date"), ("active_channel",), True,
            customer_id="string", metric_date="date", order_count="int", unit_quantity="int", gross_revenue=MONEY,
            net_revenue=MONEY, refund_amount=MONEY, return_count="int", support_contacts="int", active_channel="string",
            new_customer_flag="boolean", repeat_customer_flag="boolean"),
        "product_daily": _contract(
            ("product_id", "metric_date"), ("active_category", "available_inventory", "reserved_inventory", "stockout_flag"), True,
            product_id="string", metric_date="date", active_category="string", units_sold="int", order_count="int",
            gross_revenue=MONEY, net_revenue=MONEY, refunded_units="int", available_inventory="int", reserved_inventory="int",
            stockout_flag="boolean", promotion_count="int"),
        "channel_campaign_daily": _contract(
            ("metric_date", "sales_channel", "campaign_id"), ("roas", "conversion_rate"),
            metric_date="date", sales_channel="string", campaign_id="string", campaign_spend=MONEY, attributed_orders="int",
            attributed_customers="int", gross_revenue=MONEY, net_revenue=MONEY, refunds=MONEY, roas=RATIO, conversion_rate=RATIO),
        "executive_kpis_daily": _contract(
            ("metric_date",), (),
            metric_date="date", total_orders="int", gross_revenue=MONEY, net_revenue=MONEY, average_order_value=MONEY,
            refund_rate=RATIO, return_rate=RATIO, repeat_customer_rate=RATIO, stockout_rate=RATIO, active_customers="int",
            support_contact_rate=RATIO, data_freshness_utc="timestamp"),
    }
