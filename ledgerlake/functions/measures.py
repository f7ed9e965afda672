"""Aggregate measures, built from sums so that partial results can be added up again.

``single_line_parts`` gives the additive parts of one line (``order_totals`` sums them over many),
``open_order_parts`` those that need the order, and ``finance_columns`` the published measures.
Parts may be summed early (per order) without changing any measure, which keeps a hot order from
becoming a hot shuffle partition.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.line_metrics import COST_SHARE, is_open

PERCENT_DIGITS = 2


def as_of_date(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def finance_columns() -> list[Column]:
    """Daily finance measures over rows that hold the additive parts."""
    net, listed = F.sum("net_sum"), F.sum("list_sum")
    margin = net - listed * COST_SHARE
    return [
        F.round(net, 2).alias("total_revenue"),
        F.round(F.sum("tax_sum"), 2).alias("total_tax"),
        F.round(F.sum("discount_sum"), 2).alias("total_discounts"),
        F.round(F.sum("receivable_sum"), 2).alias("accounts_receivable"),
        F.sum("line_count").alias("order_count"),
        mean("net_sum", "net_count").alias("average_order_value"),
        F.round(margin, 2).alias("estimated_margin"),
        F.round(margin / F.nullif(net, F.lit(0)) * 100, 2).alias("margin_percentage"),
        mean("open_age_sum", "open_count", 1).alias("avg_open_order_age"),
    ]


def single_line_parts() -> list[Column]:
    """The parts of one row of the published wide table."""

    def counted(name: str) -> Column:
        return F.col(name).isNotNull().cast("bigint")

    return [
        F.col("net_amount").alias("net_sum"),
        F.col("tax_amount").alias("tax_sum"),
        F.col("discount_amount").alias("discount_sum"),
        F.col("extended_price").alias("list_sum"),
        counted("order_key").alias("line_count"),
        counted("net_amount").alias("net_count"),
        F.lit(1).cast("bigint").alias("row_count"),
    ]


def open_order_parts(as_of: date | None = None) -> list[Column]:
    """Receivables and open-order age of rows that hold the parts above."""
    open_order = is_open("order_status")
    age = F.datediff(as_of_date(as_of), F.col("order_date"))
    aged = open_order & F.col("order_date").isNotNull()
    zero = F.lit(0)
    return [
        F.when(open_order, F.col("net_sum")).otherwise(zero).alias("receivable_sum"),
        F.when(aged, age.cast("bigint") * F.col("row_count")).alias("open_age_sum"),
        F.when(aged, F.col("row_count")).otherwise(zero).alias("open_count"),
    ]


def mean(total: str, count: str, digits: int = 2) -> Column:
    """Mean from summed parts; NULL when nothing was counted."""
    return F.round(F.sum(total) / F.nullif(F.sum(count), F.lit(0)), digits)


def share(hits: str) -> Column:
    """Percentage of rows from summed parts."""
    return F.round(F.sum(hits) * 100 / F.sum("row_count"), PERCENT_DIGITS)


def percentage(condition: Column) -> Column:
    """Percentage of rows for which the condition holds; an unknown condition counts as no."""
    return F.round(F.count_if(condition) * 100 / F.count(F.lit(1)), PERCENT_DIGITS)
