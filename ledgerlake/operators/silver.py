"""Silver layer: geography, customer and part dimensions, and the order-line fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import line_metrics as m
from ledgerlake.operators.joins import join_dimension

GEO_KEYS = ("n_regionkey", "n_nationkey")
_SUPPLIER_COLUMNS = (
    "supplier_name",
    "supplier_account_balance",
    "manufacturing_country",
    "manufacturing_region",
)


def geo(nation: DataFrame, region: DataFrame, geo_key: str = "n_regionkey") -> DataFrame:
    """Nation with its region name.

    ``n_regionkey`` is the foreign key of the data model. ``n_nationkey`` reproduces the
    historical lookup, which compared the nation's own key to the region key.
    """
    if geo_key not in GEO_KEYS:
        raise ValueError(f"geo_key must be one of {GEO_KEYS}")
    return nation.join(region, F.col(geo_key) == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("geo_nationkey"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
    )


def dim_customer(customer: DataFrame, geography: DataFrame) -> DataFrame:
    located = join_dimension(customer, geography, {"c_nationkey": "geo_nationkey"})
    return located.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.col("c_address").alias("street_address"),
        "nation_name",
        "region_name",
        m.full_address("c_address", "nation_name", "region_name").alias("full_address"),
        F.col("c_phone").alias("phone_number"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("market_segment"),
    )


def supplier_enriched(supplier: DataFrame, geography: DataFrame) -> DataFrame:
    located = join_dimension(supplier, geography, {"s_nationkey": "geo_nationkey"})
    return located.select(
        "s_suppkey",
        F.col("s_name").alias("supplier_name"),
        F.col("s_acctbal").alias("supplier_account_balance"),
        F.col("nation_name").alias("manufacturing_country"),
        F.col("region_name").alias("manufacturing_region"),
    )


def part_labels() -> dict[str, Column]:
    """Columns of the part dimension that follow from its other columns."""
    return {
        "wholesale_price": m.wholesale_price("retail_price"),
        "category": F.col("product_type"),
        "packaging": F.col("container_type"),
    }


def _part_columns(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("part_key"),
        F.col("p_name").alias("part_name"),
        F.col("p_mfgr").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("size"),
        F.col("p_container").alias("container_type"),
        F.col("p_retailprice").alias("retail_price"),
    )


def part_enriched(part: DataFrame) -> DataFrame:
    return _part_columns(part).withColumns(part_labels())


def dim_part(
    part: DataFrame, partsupp: DataFrame, suppliers: DataFrame | None = None
) -> DataFrame:
    """One row per part and supplier; a part nobody supplies keeps one row without supplier.

    ``suppliers`` is the output of ``supplier_enriched``. The part side must survive, but a
    join that preserves parts can neither broadcast them nor split a hot part's supplier rows,
    so supplied parts come from an inner join driven by ``partsupp`` and the rest from an
    anti-join against its distinct keys.

    Without ``suppliers`` the rows are the narrow ones of the offers: their columns and
    ``part_labels`` are left to a join that adds them later.
    """
    parts = _part_columns(part) if suppliers is None else part_enriched(part)
    offers = partsupp.select(
        "ps_partkey", "ps_suppkey", "ps_availqty", "ps_supplycost", "ps_comment"
    )
    offered = join_dimension(offers, parts, {"ps_partkey": "part_key"}, "inner")
    supplied, supplier_key, supplier_columns = offered, (), ()
    if suppliers is not None:
        supplied = join_dimension(
            offered, suppliers, {"ps_suppkey": "s_suppkey"}, skew_source=partsupp
        )
        supplier_key, supplier_columns = ("s_suppkey",), _SUPPLIER_COLUMNS
    offered_keys = partsupp.select(F.col("ps_partkey").alias("offered_key")).distinct()
    unsupplied = parts.join(offered_keys, F.col("part_key") == F.col("offered_key"), "left_anti")
    return supplied.unionByName(unsupplied, allowMissingColumns=True).select(
        *parts.columns,
        "ps_availqty",
        "ps_supplycost",
        "ps_comment",
        *supplier_key,
        F.col("ps_suppkey").alias("supplier_key"),
        *supplier_columns,
        F.col("ps_supplycost").alias("supply_cost"),
        F.col("ps_availqty").alias("available_qty"),
    )


def order_line_columns() -> list[Column]:
    """The order-line fact's columns over joined lineitem and orders."""
    price, discount, tax = "l_extendedprice", "l_discount", "l_tax"
    return [
        F.col("o_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_commitdate").alias("commit_date"),
        F.col("l_receiptdate").alias("receipt_date"),
        F.col("o_totalprice").alias("order_total_amount"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("l_quantity").alias("quantity"),
        F.col(price).alias("extended_price"),
        F.col(discount).alias("discount_percentage"),
        F.col(tax).alias("tax_percentage"),
        m.net_amount(price, discount, tax).alias("net_amount"),
        m.discount_amount(price, discount).alias("discount_amount"),
        m.tax_amount(price, discount, tax).alias("tax_amount"),
        F.col("l_shipmode").alias("ship_mode"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        m.shipping_delay_days("l_shipdate", "o_orderdate").alias("shipping_delay_days"),
        m.delivery_delay_days("l_receiptdate", "l_shipdate").alias("delivery_delay_days"),
        m.is_late_delivery("l_receiptdate", "l_commitdate").alias("is_late_delivery"),
    ]


def fct_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order line; lines without an order and orders without lines drop out."""
    orders = orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    lines = lineitem.drop("etl_inserted")
    joined = join_dimension(
        lines, orders, {"l_orderkey": "o_orderkey"}, "inner", skew_source=lineitem
    )
    return joined.select(*order_line_columns())
