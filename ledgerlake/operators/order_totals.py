"""Order lines summed per order, before they meet the orders.

The sum runs before the shuffle too, so a hot order shrinks to one partial row per task and the
shuffle carries orders instead of lines. Measures by order attributes then need no line-level join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import line_metrics as m
from ledgerlake.operators.joins import join_dimension

_PRICE = ("l_extendedprice", "l_discount", "l_tax")


#: Cents are summed in two whole numbers, one for this many cents and one for the rest.
LIMB = 1_000_000_000


def _limbs(amount: Column, name: str) -> list[Column]:
    """Sums of an amount of two decimals as whole numbers, several times faster than decimals.

    One number would overflow at 92 quadrillion; with two, the upper one holds ten digits less.
    """
    cents = (amount * 100).cast("bigint")
    lower = cents % LIMB
    upper = F.call_function("div", cents - lower, F.lit(LIMB).cast("bigint"))
    return [F.sum(upper).alias(f"{name}_upper"), F.sum(lower).alias(f"{name}_lower")]


def _amount(name: str) -> Column:
    """The amount that two sums of cents stand for."""
    whole = F.lit(Decimal(LIMB)).cast("decimal(10,0)")
    upper, lower = (F.col(f"{name}_{part}").cast("decimal(19,0)") for part in ("upper", "lower"))
    cents = (upper * whole + lower).cast("decimal(31,0)")
    return (cents * F.lit(Decimal("0.01"))).cast("decimal(38,2)").alias(name)


def order_totals(lineitem: DataFrame) -> DataFrame:
    """Additive parts of the lines of each order; readers' unused sums are pruned away.

    Amounts are summed exactly in whole cents, whatever ANSI mode says, and handed out as
    decimals.
    """
    net, ship_day = m.net_amount(*_PRICE), F.unix_date("l_shipdate")
    delay = m.delivery_delay_days("l_receiptdate", "l_shipdate")
    amounts = {
        "net_sum": net,
        "tax_sum": m.tax_amount(*_PRICE),
        "discount_sum": m.discount_amount(*_PRICE[:2]),
        "list_sum": F.col(_PRICE[0]),
    }
    rows = F.count(F.lit(1))
    counts = {
        "net_count": F.count(net),
        "line_count": rows,
        "row_count": rows,
        "ship_day_sum": F.sum(ship_day),
        "ship_day_count": F.count(ship_day),
        "delivery_sum": F.sum(delay),
        "delivery_count": F.count(delay),
        "late_count": F.count_if(m.is_late_delivery("l_receiptdate", "l_commitdate")),
    }
    summed = lineitem.groupBy(F.col("l_orderkey").alias("totals_key")).agg(
        *[limb for name, amount in amounts.items() for limb in _limbs(amount, name)],
        *[count.alias(name) for name, count in counts.items()],
    )
    return summed.select("totals_key", *[_amount(name) for name in amounts], *counts)


def weighted_order_totals(lineitem: DataFrame, partsupp: DataFrame) -> DataFrame:
    """The finance parts when every line counts once per supplier of its part.

    This equals joining parts without their supplier, where a line is repeated per supplier,
    but the repeated rows are never built. A part nobody supplies counts once.
    """
    offers = partsupp.groupBy(F.col("ps_partkey").alias("offered_key")).agg(
        F.count(F.lit(1)).alias("offers")
    )
    counted = join_dimension(
        lineitem.drop("etl_inserted"), offers, {"l_partkey": "offered_key"}, skew_source=lineitem
    )
    weight, net = F.coalesce("offers", F.lit(1)), m.net_amount(*_PRICE)
    return (
        counted.withColumn("weight", weight)
        .withColumn("net", net)
        .groupBy(F.col("l_orderkey").alias("totals_key"))
        .agg(
            F.sum(F.col("net") * F.col("weight")).alias("net_sum"),
            F.sum(F.when(F.col("net").isNotNull(), F.col("weight")).otherwise(0)).alias(
                "net_count"
            ),
            F.sum(m.tax_amount(*_PRICE) * F.col("weight")).alias("tax_sum"),
            F.sum(m.discount_amount(*_PRICE[:2]) * F.col("weight")).alias("discount_sum"),
            F.sum(F.col(_PRICE[0]) * F.col("weight")).alias("list_sum"),
            F.sum("weight").alias("line_count"),
            F.sum("weight").alias("row_count"),
        )
    )


def orders_with_totals(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders under their business names with the totals of their lines; both sides must match."""
    business = {
        "o_orderkey": "order_key",
        "o_custkey": "customer_key",
        "o_orderstatus": "order_status",
        "o_orderdate": "order_date",
    }
    joined = orders.join(totals, F.col("o_orderkey") == F.col("totals_key"))
    kept = [c for c in joined.columns if c not in ("totals_key", "etl_inserted")]
    return joined.select(*[F.col(c).alias(business.get(c, c)) for c in kept])
