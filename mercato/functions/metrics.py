"""Business metrics as Column expressions (money is decimal, ratios are double)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
NO_PAYMENT = "NO_PAYMENT"
NO_RETURN = "NO_RETURN"
CAPTURED = "PAYMENT_CAPTURED"
AUTHORIZED = "PAYMENT_AUTHORIZED"
FAILED = "PAYMENT_FAILED"
REFUND_DONE = "REFUND_COMPLETED"
TICKET_OPENED = "SUPPORT_TICKET_CREATED"
RESOLVED_STATUSES = ("COMPLETED", "RETURNED", "CANCELLED")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def line_amount() -> Column:
    return F.col("quantity") * F.col("unit_price")


def revenue_before_refund(gross="gross_merchandise_value", discount="discount_amount", shipping="shipping_revenue") -> Column:
    return col(gross) - col(discount) + col(shipping)


def net_revenue(refund="refunded_amount", **parts) -> Column:
    return revenue_before_refund(**parts) - col(refund)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Unrounded double ratio, NULL when the denominator is zero or NULL."""
    base = col(bottom)
    return col(top).cast("double") / F.when(base != 0, base).cast("double")


def ratio_or_zero(top: Column | str, bottom: Column | str) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def share(condition: Column) -> Column:
    """Aggregate: the share of rows that meet the condition (NULL counts as no)."""
    return F.count_if(condition).cast("double") / F.count(F.lit(1)).cast("double")


def mean(value: Column | str) -> Column:
    """Aggregate: exact sum over count, divided once as double."""
    return F.sum(value).cast("double") / F.count(value).cast("double")


def stockout(available="available_inventory") -> Column:
    return col(available) <= 0


def has_refund(refund="refunded_amount") -> Column:
    return col(refund) > 0


def has_return(status="return_status") -> Column:
    return col(status) != NO_RETURN


def is_resolved(order_status="order_status", return_status="return_status") -> Column:
    return has_return(return_status) | col(order_status).isin(*RESOLVED_STATUSES)


def sum_if(condition: Column, value: Column | str) -> Column:
    return F.sum(F.when(condition, col(value)))


def status_by_precedence(*ranked: str, event_type="event_type", otherwise: str | None = None) -> Column:
    """Aggregate: the first status of ``ranked`` that any event of the group has."""
    picked = [F.when(F.bool_or(col(event_type) == status), status) for status in ranked]
    return F.coalesce(*picked, F.lit(otherwise))
