"""Column expressions derived from one order line, part or customer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COST_SHARE = 0.8  # cost and wholesale price are assumed to be 80 % of list price
CLOSED = "F"


def net_amount(price: str, discount: str, tax: str) -> Column:
    return F.round(F.col(price) * (1 - F.col(discount)) * (1 + F.col(tax)), 2)


def discount_amount(price: str, discount: str) -> Column:
    return F.round(F.col(price) * F.col(discount), 2)


def tax_amount(price: str, discount: str, tax: str) -> Column:
    return F.round(F.col(price) * (1 - F.col(discount)) * F.col(tax), 2)


def shipping_delay_days(ship: str, order: str) -> Column:
    """Days from order to shipment; negative when the line shipped first."""
    return F.datediff(F.col(ship), F.col(order))


def delivery_delay_days(receipt: str, ship: str) -> Column:
    return F.datediff(F.col(receipt), F.col(ship))


def is_late_delivery(receipt: str, commit: str) -> Column:
    """Received after the committed date; an unknown date is not late."""
    return F.coalesce(F.col(receipt) > F.col(commit), F.lit(False))


def is_open(status: str) -> Column:
    """Not closed; NULL for an unknown status, so conditional measures skip it."""
    return F.col(status) != CLOSED


def wholesale_price(retail: str) -> Column:
    return F.round(F.col(retail) * COST_SHARE, 2)


def full_address(*parts: str) -> Column:
    """Comma-joined address; unknown parts are left out."""
    return F.concat_ws(", ", *parts)
