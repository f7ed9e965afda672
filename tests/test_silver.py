from decimal import Decimal

import pytest
from conftest import frame, rows_of

from ledgerlake.operators import silver


def d(text):
    return Decimal(text)


def geo(tables, key="n_regionkey"):
    return silver.geo(tables["nation"], tables["region"], key)


def test_fct_orders_metrics(tables):
    got = rows_of(
        silver.fct_orders(tables["orders"], tables["lineitem"]),
        "order_key", "line_number", "net_amount", "discount_amount", "tax_amount",
        "shipping_delay_days", "delivery_delay_days", "is_late_delivery",
    )
    assert got == [
        (1001, 1, d("418.00"), d("20.00"), d("38.00"), 2, 3, False),
        (1001, 2, d("315.00"), d("0.00"), d("15.00"), 3, 4, True),
        (1002, 1, d("81.00"), d("9.00"), d("0.00"), 1, 2, False),
        (1003, 1, d("44.00"), d("10.00"), d("4.00"), 3, 2, False),
        (1004, 1, d("180.00"), d("50.00"), d("30.00"), 2, 6, True),
    ]


def test_fct_orders_has_25_columns(tables):
    fct = silver.fct_orders(tables["orders"], tables["lineitem"])
    assert len(fct.columns) == 25
    assert fct.columns[:5] == [
        "order_key", "line_number", "customer_key", "part_key", "supplier_key"
    ]


def test_unknown_dates_are_not_late_and_have_no_delay(edge_tables):
    fct = silver.fct_orders(edge_tables["orders"], edge_tables["lineitem"])
    got = {
        r["order_key"]: (r["is_late_delivery"], r["shipping_delay_days"], r["delivery_delay_days"])
        for r in fct.collect()
    }
    assert got[1005] == (False, 5, 3)
    assert got[1006] == (True, None, None)
    assert got[1007] == (True, -1, 0)
    assert 9999 not in got


@pytest.mark.parametrize(
    ("key", "of_brez", "of_cora"),
    [("n_regionkey", "EAST", "SOUTH"), ("n_nationkey", "SOUTH", "EAST")],
)
def test_dim_customer_region(tables, key, of_brez, of_cora):
    got = rows_of(
        silver.dim_customer(tables["customer"], geo(tables, key)),
        "customer_key", "nation_name", "region_name",
    )
    assert got == [
        (21, "BREZ", of_brez),
        (22, "ALBA", "NORTH"),
        (23, "CORA", of_cora),
        (24, "ALBA", "NORTH"),
    ]


def test_dim_customer_keeps_unknown_nations(edge_tables):
    got = silver.dim_customer(edge_tables["customer"], geo(edge_tables)).filter("customer_key = 25")
    row = got.first()
    assert (row["nation_name"], row["region_name"], row["full_address"]) == (None, None, "Address 25")
    known = silver.dim_customer(edge_tables["customer"], geo(edge_tables)).filter("customer_key = 22")
    assert known.first()["full_address"] == "Address 22, ALBA, NORTH"


def test_geo_rejects_other_keys(tables):
    with pytest.raises(ValueError, match="geo_key"):
        geo(tables, "n_name")


def test_dim_part_grain_is_part_and_supplier(edge_tables):
    suppliers = silver.supplier_enriched(edge_tables["supplier"], geo(edge_tables))
    parts = silver.dim_part(edge_tables["part"], edge_tables["partsupp"], suppliers)
    got = rows_of(
        parts, "part_key", "supplier_key", "supply_cost", "wholesale_price",
        "supplier_name", "manufacturing_country",
    )
    assert got == [
        (501, 71, d("33.00"), 64.0, "Supplier 71", "CORA"),
        (501, 73, d("11.00"), 64.0, "Supplier 73", "BREZ"),
        (502, 72, d("25.00"), 51.2, "Supplier 72", "ALBA"),
        (503, 73, d("140.00"), 200.0, "Supplier 73", "BREZ"),
        (504, 71, d("9.00"), 15.2, "Supplier 71", "CORA"),
        (505, None, None, 24.8, None, None),
    ]


def test_dim_part_ignores_offers_of_unknown_parts(spark, tables):
    offers = frame(spark, "partsupp", [(999, 71, 1, 1), (501, 88, 5, 6)])
    suppliers = silver.supplier_enriched(tables["supplier"], geo(tables))
    got = rows_of(
        silver.dim_part(tables["part"], offers, suppliers),
        "part_key", "supplier_key", "s_suppkey", "available_qty",
    )
    assert got == [
        (501, 88, None, 5),
        (502, None, None, None),
        (503, None, None, None),
        (504, None, None, None),
    ]
