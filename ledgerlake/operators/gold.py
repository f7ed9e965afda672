"""Gold layer: the wide order-detail table and the daily metrics computed from it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import line_metrics as m
from ledgerlake.functions import measures
from ledgerlake.operators import silver
from ledgerlake.operators.joins import fits_broadcast, join_dimension
from ledgerlake.operators.order_totals import (
    order_totals,
    orders_with_totals,
    weighted_order_totals,
)
from ledgerlake.operators.silver import order_line_columns

# Columns the dimensions add to an order line (keys and stamps stay out).
_CUSTOMER_COLUMNS = (
    "customer_name",
    "street_address",
    "nation_name",
    "region_name",
    "phone_number",
    "account_balance",
    "market_segment",
)
_PART_COLUMNS = (
    "part_name",
    "manufacturer",
    "brand",
    "product_type",
    "size",
    "container_type",
    "retail_price",
    "wholesale_price",
    "category",
    "packaging",
    "supply_cost",
    "available_qty",
    "supplier_name",
    "supplier_account_balance",
    "manufacturing_country",
    "manufacturing_region",
)
_GROUP = ("date", "customer_nation", "customer_region")


def _day():
    return F.date_format("order_date", "yyyy-MM-dd")


def _customer_side(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("customer_key").alias("dim_customer_key"), *_CUSTOMER_COLUMNS)


def _part_side(part: DataFrame, part_only: bool) -> DataFrame:
    keys = [F.col("part_key").alias("dim_part_key")]
    if not part_only:
        keys.append(F.col("supplier_key").alias("dim_supplier_key"))
    return part.select(*keys, *_PART_COLUMNS)


def wide_order_details(
    fct: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    part_only: bool = False,
    customer_keys: DataFrame | None = None,
    part_keys: DataFrame | None = None,
) -> DataFrame:
    """Order lines with their customer and their part as supplied by the line's supplier.

    ``part_only`` joins the part dimension on the part alone, which repeats a line once per
    supplier of its part (the historical behaviour). When ``fct`` is not a stored table,
    ``customer_keys`` and ``part_keys`` are cheaper frames to find its hot keys in.
    """
    lines = fct.drop("etl_inserted")
    on = {"part_key": "dim_part_key"}
    if not part_only:
        on["supplier_key"] = "dim_supplier_key"
    located = join_dimension(
        lines,
        _customer_side(customer),
        {"customer_key": "dim_customer_key"},
        skew_source=fct if customer_keys is None else customer_keys,
    )
    wide = join_dimension(
        located,
        _part_side(part, part_only),
        on,
        skew_source=fct if part_keys is None else part_keys,
    )
    return wide.select(*lines.columns, *_CUSTOMER_COLUMNS, *_PART_COLUMNS)


def located_order_lines(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame
) -> DataFrame:
    """Order lines with their customer's columns, without a stored order-line fact.

    Customers are joined at order grain, before the lines multiply the rows, and hot keys are
    found on the stored tables.
    """
    return _located(orders, lineitem, customer, lineitem, ())


def _texts_first(df: DataFrame) -> DataFrame:
    """The same columns, texts ahead of numbers: such rows compress better in a shuffle."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*texts, *[c for c in df.columns if c not in texts])


def wide_order_details_from_sources(
    orders: DataFrame,
    lineitem: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    part_only: bool = False,
    suppliers: DataFrame | None = None,
) -> DataFrame:
    """``wide_order_details`` in one plan, without a stored order-line fact.

    Parts are joined straight after the scan, customers at order grain, so lines are shuffled
    twice instead of three times.

    With ``suppliers``, ``part`` is ``dim_part`` without them: rows are shuffled narrow.
    ``part_labels`` are computed last, and suppliers within the broadcast threshold are joined
    last, to lines whose part they offer. Larger ones are joined to the parts.
    """
    joined_last = suppliers is not None and fits_broadcast(suppliers)
    if suppliers is not None and not joined_last:
        part = join_dimension(part, suppliers, {"supplier_key": "s_suppkey"})
    held = [c for c in _PART_COLUMNS if c in part.columns]
    side = part.select(
        F.col("part_key").alias("dim_part_key"),
        F.col("supplier_key").alias("dim_supplier_key"),
        *held,
    )
    on = {"l_partkey": "dim_part_key"}
    if not part_only:
        on["l_suppkey"] = "dim_supplier_key"
    supplied = join_dimension(
        _texts_first(lineitem.drop("etl_inserted")), _texts_first(side), on, skew_source=lineitem
    )
    # only a line that found its part has the key of the supplier
    extras = ["dim_supplier_key", *held] if joined_last else held
    wide = _located(orders, _texts_first(supplied), customer, lineitem, tuple(extras))
    lines = [c for c in wide.columns if c not in extras]
    if joined_last:
        wide = join_dimension(wide, suppliers, {"dim_supplier_key": "s_suppkey"})
    labels = {name: c for name, c in silver.part_labels().items() if name not in held}
    return wide.withColumns(labels).select(*lines, *_PART_COLUMNS)


def _located(
    orders: DataFrame,
    lines: DataFrame,
    customer: DataFrame,
    lineitem: DataFrame,
    line_extras: tuple[str, ...],
) -> DataFrame:
    orders_located = join_dimension(
        orders.drop("etl_inserted"),
        _customer_side(customer),
        {"o_custkey": "dim_customer_key"},
        skew_source=orders,
    )
    joined = join_dimension(
        lines.drop("etl_inserted"),
        orders_located,
        {"l_orderkey": "o_orderkey"},
        "inner",
        skew_source=lineitem,
    )
    return joined.select(*order_line_columns(), *_CUSTOMER_COLUMNS, *line_extras)


# Read contract of the stored wide table: published column -> stored column.
WIDE_READ_COLUMNS = {
    "order_key": "order_key",
    "line_number": "line_number",
    "order_date": "order_date",
    "order_status": "order_status",
    "order_priority": "order_priority",
    "extended_price": "extended_price",
    "net_amount": "net_amount",
    "discount_amount": "discount_amount",
    "tax_amount": "tax_amount",
    "customer_name": "customer_name",
    "market_segment": "market_segment",
    "customer_nation": "nation_name",
    "customer_region": "region_name",
    "part_name": "part_name",
    "manufacturer": "manufacturer",
    "brand": "brand",
    "product_type": "product_type",
    "manufacturing_country": "manufacturing_country",
    "manufacturing_region": "manufacturing_region",
    "shipping_delay_days": "shipping_delay_days",
    "delivery_delay_days": "delivery_delay_days",
    "is_late_delivery": "is_late_delivery",
}


def wide_read(wide: DataFrame) -> DataFrame:
    """The published 22 columns of the wide table (the stamp is added by the store)."""
    return wide.select(*[F.col(stored).alias(name) for name, stored in WIDE_READ_COLUMNS.items()])


def finance_metrics(wide: DataFrame, as_of: date | None = None) -> DataFrame:
    """Daily finance measures by customer nation and region, from the published wide table.

    ``as_of`` fixes the day that open orders are aged to; None means today.
    """
    return _finance(
        wide.select(
            _day().alias("date"),
            "customer_nation",
            "customer_region",
            "order_date",
            "order_status",
            *measures.single_line_parts(),
        ),
        as_of,
    )


def _finance(summed: DataFrame, as_of: date | None) -> DataFrame:
    parts = summed.select("*", *measures.open_order_parts(as_of))
    return parts.groupBy(*_GROUP).agg(*measures.finance_columns())


#: The parts that finance measures are made from; sums of them can be summed again.
_FINANCE_PARTS = (
    "net_sum", "tax_sum", "discount_sum", "list_sum", "receivable_sum", "line_count", "net_count",
    "open_age_sum", "open_count",
)


def _located_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders with the place and segment of their customer."""
    return join_dimension(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"),
        customer.select(
            F.col("customer_key").alias("dim_customer_key"),
            F.col("nation_name").alias("customer_nation"),
            F.col("region_name").alias("customer_region"),
            "market_segment",
        ),
        {"o_custkey": "dim_customer_key"},
        skew_source=orders,
    )


def finance_metrics_from_sources(
    orders: DataFrame,
    lineitem: DataFrame,
    customer: DataFrame,
    geography: DataFrame,
    as_of: date | None = None,
    partsupp: DataFrame | None = None,
) -> DataFrame:
    """``finance_metrics`` straight from orders, lines, customers and ``silver.geo``.

    No finance measure uses a part column, so parts are not joined. Of customers only the nation
    key is, and the nations' names come in after the sums by day and nation. Passing ``partsupp``
    gives the historical results, where a line counted once per supplier of its part.
    """
    if partsupp is None:
        totals = order_totals(lineitem)
    else:
        totals = weighted_order_totals(lineitem, partsupp)
    placed = join_dimension(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"),
        customer.select("c_custkey", "c_nationkey"),
        {"o_custkey": "c_custkey"},
        skew_source=orders,
    )
    parts = orders_with_totals(placed, totals).select("*", *measures.open_order_parts(as_of))
    by_nation = parts.groupBy(_day().alias("date"), "c_nationkey").agg(
        *[F.sum(part).alias(part) for part in _FINANCE_PARTS]
    )
    named = join_dimension(by_nation, geography, {"c_nationkey": "geo_nationkey"})
    groups = ("date", F.col("nation_name").alias("customer_nation"))
    return named.groupBy(*groups, F.col("region_name").alias("customer_region")).agg(
        *measures.finance_columns()
    )


def fanout_by_date(orders: DataFrame, lineitem: DataFrame, partsupp: DataFrame) -> DataFrame:
    """Row count and sums per order date of the part-only wide table, without building it."""
    totals = weighted_order_totals(lineitem, partsupp)
    summed = orders_with_totals(orders.select("o_orderkey", "o_orderdate"), totals)
    return summed.groupBy(_day().alias("date")).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("net_sum").alias("net_amount"),
        F.sum("list_sum").alias("extended_price"),
    )


# Read contract of the stored sales metrics: published column -> stored column.
SALES_READ_COLUMNS = {
    "date": "date",
    "market_segment": "market_segment",
    "region": "customer_region",
    "total_sales": "total_sales",
    "total_discounts": "total_discounts",
    "average_order_value": "average_order_value",
    "number_of_orders": "number_of_orders",
    "number_of_items": "number_of_items",
    "avg_shipping_delay": "avg_shipping_delay",
    "avg_delivery_delay": "avg_delivery_delay",
    "late_delivery_percentage": "late_delivery_percentage",
    "unique_customers": "unique_customers",
    "unique_products": "unique_products",
    "fulfillment_rate": "fulfillment_rate",
}


_SALES_GROUP = ("date", "market_segment", "customer_region")
#: The parts that sales measures are made from; sums of them can be summed again.
_SALES_PARTS = (
    "net_sum", "net_count", "discount_sum", "line_count", "row_count", "shipping_sum",
    "shipping_count", "delivery_sum", "delivery_count", "late_count", "closed_count",
)


def daily_sales_metrics(wide: DataFrame) -> DataFrame:
    """Daily sales by market segment and customer region.

    Needs ``customer_key`` and ``part_key`` besides the published wide columns. Items are
    lines; orders, customers and products are exact distinct counts.
    """
    lines = wide.withColumn("date", _day())
    orders = lines.groupBy(*_SALES_GROUP, "order_key", "customer_key").agg(
        F.sum("net_amount").alias("net_sum"),
        F.count("net_amount").alias("net_count"),
        F.sum("discount_amount").alias("discount_sum"),
        F.count("order_key").alias("line_count"),
        F.count(F.lit(1)).alias("row_count"),
        F.sum("shipping_delay_days").alias("shipping_sum"),
        F.count("shipping_delay_days").alias("shipping_count"),
        F.sum("delivery_delay_days").alias("delivery_sum"),
        F.count("delivery_delay_days").alias("delivery_count"),
        F.count_if("is_late_delivery").alias("late_count"),
        F.count_if(F.col("order_status") == m.CLOSED).alias("closed_count"),
    )
    return _sales(orders, lines.select(*_SALES_GROUP, "part_key"))


def daily_sales_metrics_from_sources(
    orders: DataFrame, lineitem: DataFrame, customer: DataFrame
) -> DataFrame:
    """``daily_sales_metrics`` straight from orders, lines and the customer dimension."""
    located = _located_orders(orders, customer).withColumn(
        "date", F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    summed = with_order_measures(orders_with_totals(located, order_totals(lineitem)))
    sold = join_dimension(
        lineitem.select("l_orderkey", F.col("l_partkey").alias("part_key")),
        located.select("o_orderkey", *_SALES_GROUP),
        {"l_orderkey": "o_orderkey"},
        "inner",
        skew_source=lineitem,
    )
    return _sales(summed, sold)


def with_order_measures(summed: DataFrame) -> DataFrame:
    """Adds the parts that combine line totals with the order's date and status."""
    day, dated = F.unix_date("order_date"), F.col("order_date").isNotNull()
    closed = F.col("order_status") == m.CLOSED
    ship_days, ships = F.col("ship_day_sum"), F.col("ship_day_count")
    return summed.select(
        "*",
        (ship_days - ships * day).alias("shipping_sum"),
        F.when(dated, ships).otherwise(0).alias("shipping_count"),
        F.when(closed, F.col("row_count")).otherwise(0).alias("closed_count"),
    )


def _sales(orders: DataFrame, sold: DataFrame) -> DataFrame:
    """Measures of order rows holding line totals, joined with the distinct parts sold.

    Only the part count needs lines.
    """
    # An order is one row here and has one customer, so one row per customer counts both.
    per_customer = orders.groupBy(*_SALES_GROUP, "customer_key").agg(
        *[F.sum(part).alias(part) for part in _SALES_PARTS],
        F.count("order_key").alias("order_count"),
    )
    measured = per_customer.groupBy(*_SALES_GROUP).agg(
        F.round(F.sum("net_sum"), 2).alias("total_sales"),
        F.round(F.sum("discount_sum"), 2).alias("total_discounts"),
        measures.mean("net_sum", "net_count").alias("average_order_value"),
        F.sum("order_count").alias("number_of_orders"),
        F.sum("line_count").alias("number_of_items"),
        measures.mean("shipping_sum", "shipping_count").alias("avg_shipping_delay"),
        measures.mean("delivery_sum", "delivery_count").alias("avg_delivery_delay"),
        measures.share("late_count").alias("late_delivery_percentage"),
        F.count("customer_key").alias("unique_customers"),
        measures.share("closed_count").alias("fulfillment_rate"),
    )
    products = sold.groupBy(*[F.col(c).alias(f"sold_{c}") for c in _SALES_GROUP]).agg(
        F.count_distinct("part_key").alias("unique_products")
    )
    # unknown segments and regions are groups of their own on both sides
    same_group = [F.col(c).eqNullSafe(F.col(f"sold_{c}")) for c in _SALES_GROUP]
    return measured.join(products, same_group).select(
        *_SALES_GROUP, *[c for c in SALES_READ_COLUMNS if c not in ("region", *_SALES_GROUP)]
    )
