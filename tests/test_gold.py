from datetime import datetime
from decimal import Decimal

import pytest
from conftest import AS_OF, frame, rows_of
from pyspark.sql import functions as F

from ledgerlake.operators import gold, interface, silver
from ledgerlake.operators.order_totals import order_totals, weighted_order_totals


class Model:
    def __init__(self, tables, geo_key="n_regionkey"):
        self.tables = tables
        self.geo = silver.geo(tables["nation"], tables["region"], geo_key)
        self.customers = silver.dim_customer(tables["customer"], self.geo)
        self.suppliers = silver.supplier_enriched(tables["supplier"], self.geo)
        self.parts = silver.dim_part(tables["part"], tables["partsupp"], self.suppliers)
        self.fct = silver.fct_orders(tables["orders"], tables["lineitem"])

    def wide(self, part_only=False):
        return gold.wide_order_details(self.fct, self.customers, self.parts, part_only)

    def finance(self, part_only=False):
        return gold.finance_metrics(gold.wide_read(self.wide(part_only)), AS_OF)

    def finance_direct(self, partsupp=None):
        t = self.tables
        return gold.finance_metrics_from_sources(
            t["orders"], t["lineitem"], t["customer"], self.geo, AS_OF, partsupp
        )


def d(text):
    return Decimal(text)


@pytest.mark.parametrize(
    ("geo_key", "of_brez", "of_cora"),
    [("n_regionkey", "EAST", "SOUTH"), ("n_nationkey", "SOUTH", "EAST")],
)
def test_finance_metrics(tables, geo_key, of_brez, of_cora):
    model = Model(tables, geo_key)
    expected = [
        ("2024-05-03", "ALBA", "NORTH", d("733.00"), d("53.00"), d("20.00"), d("733.00"),
         2, d("366.50"), 173.0, 23.6, 38.0),
        ("2024-05-03", "BREZ", of_brez, d("81.00"), d("0.00"), d("9.00"), d("0.00"),
         1, d("81.00"), 9.0, 11.11, None),
        ("2024-05-06", "ALBA", "NORTH", d("180.00"), d("30.00"), d("50.00"), d("0.00"),
         1, d("180.00"), 20.0, 11.11, None),
        ("2024-05-06", "CORA", of_cora, d("44.00"), d("4.00"), d("10.00"), d("44.00"),
         1, d("44.00"), 4.0, 9.09, 35.0),
    ]
    assert rows_of(model.finance()) == expected
    assert rows_of(model.finance_direct()) == expected


def test_finance_edge_cases(edge_tables):
    model = Model(edge_tables)
    got = {r[:3]: r for r in rows_of(model.finance())}
    # an unknown status is not open; an unknown nation is a group of its own
    unknown = got[("2024-05-08", None, None)]
    assert unknown[3] == d("150.00")
    assert unknown[6] == d("25.00")  # only the open order of the unknown customer
    assert unknown[7] == 3
    assert unknown[11] == 33.0
    # no revenue: no margin rate rather than a division error
    empty = got[("2024-05-09", "BREZ", "EAST")]
    assert (empty[3], empty[10], empty[11]) == (d("0.00"), None, 32.0)
    assert rows_of(model.finance_direct()) == sorted(got.values(), key=repr)


def test_finance_ages_to_today_by_default(tables):
    wide = gold.wide_read(Model(tables).wide())
    age = gold.finance_metrics(wide).filter("avg_open_order_age IS NOT NULL").select(
        (F.col("avg_open_order_age") == F.datediff(F.current_date(), F.to_date("date"))).alias("x")
    )
    assert [r["x"] for r in age.collect()] == [True, True]


def test_wide_has_one_row_per_line(edge_tables):
    model = Model(edge_tables)
    wide = model.wide()
    assert wide.count() == model.fct.count()
    got = rows_of(wide.filter("part_key = 501"), "order_key", "supplier_key", "supplier_name")
    assert got == [(1001, 71, "Supplier 71"), (1004, 71, "Supplier 71"),
                   (1005, 73, "Supplier 73"), (1007, 71, "Supplier 71")]
    # the part exists, but this supplier does not offer it
    assert rows_of(wide.filter("part_key = 505"), "part_name", "supplier_name") == [(None, None)]


def test_part_only_repeats_lines_per_supplier(edge_tables):
    model = Model(edge_tables)
    wide = model.wide(part_only=True)
    assert wide.count() == model.fct.count() + 4  # four lines of part 501, two suppliers
    assert rows_of(wide.filter("order_key = 1005"), "supplier_key", "supplier_name") == [
        (73, "Supplier 71"),
        (73, "Supplier 73"),
    ]


@pytest.mark.parametrize("part_only", [False, True])
def test_wide_from_sources_is_the_same(edge_tables, part_only):
    model, t = Model(edge_tables), edge_tables
    direct = gold.wide_order_details_from_sources(
        t["orders"], t["lineitem"], model.customers, model.parts, part_only
    )
    wide = model.wide(part_only)
    assert direct.columns == wide.columns
    assert rows_of(direct) == rows_of(wide)


@pytest.mark.parametrize("part_only", [False, True])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_suppliers_joined_last_change_nothing(
    spark, setting, edge_tables, tmp_path, part_only, threshold
):
    """Repeated suppliers, parts and offers, offers of unknown parts and null keys included."""
    odd = dict(edge_tables)
    nameless = frame(spark, "supplier", [(70, 20)]).withColumn("s_suppkey", F.lit(None))
    odd["supplier"] = odd["supplier"].union(frame(spark, "supplier", [(71, 10)])).union(nameless)
    odd["part"] = odd["part"].union(frame(spark, "part", [(504, 20, "S"), (None, 5, "T")]))
    odd["partsupp"] = odd["partsupp"].union(
        frame(spark, "partsupp", [(504, 71, 4, 8), (999, 71, 1, 1), (999, 71, 2, 2),
                                  (501, 88, 5, 6), (None, 71, 1, 1), (502, None, 1, 1)])
    )
    odd["lineitem"] = odd["lineitem"].union(
        frame(spark, "lineitem", [
            (1001, 999, 71, 3, 1, 10, 0.0, 0.0, 5, 9, 8),
            (1001, 501, 88, 4, 1, 10, 0.0, 0.0, 5, 9, 8),
            (1002, 504, 71, 5, 1, 10, 0.0, 0.0, 5, 9, 8),
            (1002, None, 71, 6, 1, 10, 0.0, 0.0, 5, 9, 8),
            (1003, 502, None, 7, 1, 10, 0.0, 0.0, 5, 9, 8),
        ])
    )
    for name, rows in odd.items():  # files have a size that can be below the threshold
        rows.write.parquet(f"{tmp_path}/{name}")
        odd[name] = spark.read.parquet(f"{tmp_path}/{name}")
    model = Model(odd)
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    wide = model.wide(part_only)
    direct = gold.wide_order_details_from_sources(
        odd["orders"], odd["lineitem"], model.customers,
        silver.dim_part(odd["part"], odd["partsupp"]), part_only, model.suppliers,
    )
    assert direct.columns == wide.columns
    assert direct.dtypes == wide.dtypes
    assert text_of(direct) == text_of(wide)


def text_of(df):
    return sorted(repr(tuple(row)) for row in df.collect())


def test_weights_equal_the_fan_out(edge_tables):
    model, t = Model(edge_tables), edge_tables
    assert rows_of(model.finance_direct(t["partsupp"])) == rows_of(model.finance(part_only=True))
    by_date = gold.fanout_by_date(t["orders"], t["lineitem"], t["partsupp"])
    wide = model.wide(part_only=True)
    expected = wide.groupBy(F.date_format("order_date", "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)), F.sum("net_amount"), F.sum("extended_price")
    )
    assert rows_of(by_date) == rows_of(expected)


def test_weighted_totals_count_unknown_amounts_once(edge_tables):
    lines = edge_tables["lineitem"].withColumn("l_tax", F.lit(None).cast("decimal(15,2)"))
    totals = weighted_order_totals(lines, edge_tables["partsupp"])
    assert {r["net_count"] for r in totals.collect()} == {0}


def test_wide_read_contract(tables):
    assert gold.wide_read(Model(tables).wide()).columns == [
        "order_key", "line_number", "order_date", "order_status", "order_priority",
        "extended_price", "net_amount", "discount_amount", "tax_amount", "customer_name",
        "market_segment", "customer_nation", "customer_region", "part_name", "manufacturer",
        "brand", "product_type", "manufacturing_country", "manufacturing_region",
        "shipping_delay_days", "delivery_delay_days", "is_late_delivery",
    ]


def test_sums_over_groups_equal_sums_over_lines(edge_tables):
    model = Model(edge_tables)
    totals = model.finance().agg(F.sum("total_revenue"), F.sum("order_count")).first()
    lines = model.fct.agg(F.sum("net_amount"), F.count("order_key")).first()
    assert tuple(totals) == tuple(lines)


@pytest.fixture
def sales_lines(spark):
    """The rows on which the sales measures are defined."""
    first, second = datetime(2023, 1, 1), datetime(2023, 1, 2)
    rows = [
        (1, 1, 1, 101, "BUILDING", "EUROPE", first, "F", 900.0, 100.0, 5, 5, False),
        (1, 2, 1, 102, "BUILDING", "EUROPE", first, "F", 475.0, 25.0, 5, 5, False),
        (2, 1, 2, 103, "AUTOMOBILE", "EUROPE", first, "O", 2000.0, 0.0, 5, 5, True),
        (3, 1, 3, 104, "MACHINERY", "AMERICA", second, "F", 1200.0, 300.0, 5, 5, False),
        (3, 2, 3, 105, "MACHINERY", "AMERICA", second, "P", 720.0, 80.0, 5, 5, True),
    ]
    return spark.createDataFrame(
        rows,
        "order_key bigint, line_number bigint, customer_key bigint, part_key bigint, "
        "market_segment string, customer_region string, order_date timestamp, "
        "order_status string, net_amount double, discount_amount double, "
        "shipping_delay_days bigint, delivery_delay_days bigint, is_late_delivery boolean",
    )


def test_daily_sales_metrics(sales_lines):
    got = {r["market_segment"]: r.asDict() for r in gold.daily_sales_metrics(sales_lines).collect()}
    assert len(got) == 3
    building = got["BUILDING"]
    assert building["date"] == "2023-01-01"
    assert building["customer_region"] == "EUROPE"
    assert building["total_sales"] == 1375.0
    assert building["total_discounts"] == 125.0
    assert building["average_order_value"] == 687.5
    assert building["number_of_orders"] == 1
    assert building["number_of_items"] == 2
    assert building["unique_customers"] == 1
    assert building["unique_products"] == 2
    assert building["late_delivery_percentage"] == 0.0
    assert building["fulfillment_rate"] == 100.0
    machinery = got["MACHINERY"]
    assert machinery["late_delivery_percentage"] == 50.0
    assert machinery["fulfillment_rate"] == 50.0
    assert machinery["avg_shipping_delay"] == 5.0


def test_daily_sales_from_sources_is_the_same(edge_tables):
    model, t = Model(edge_tables), edge_tables
    wide = model.wide().withColumnRenamed("region_name", "customer_region")
    direct = gold.daily_sales_metrics_from_sources(t["orders"], t["lineitem"], model.customers)
    expected = gold.daily_sales_metrics(wide)
    assert direct.columns == expected.columns
    assert rows_of(direct) == rows_of(expected)


def test_daily_sales_report(spark, sales_lines):
    report = interface.daily_sales_report(gold.daily_sales_metrics(sales_lines))
    interface.publish_view(report, "daily_sales_report")
    seen = spark.sql("SELECT * FROM global_temp.daily_sales_report")
    assert seen.columns == [
        "Date", "Market Segment", "Region", "Total Revenue", "Average Order Value",
        "Order Count", "Late Delivery %", "Fulfillment Rate %",
    ]
    groups = sales_lines.select("order_date", "market_segment", "customer_region").distinct()
    assert seen.count() == groups.count() == 3


def test_finance_dashboard_labels(tables):
    assert interface.finance_dashboard(Model(tables).finance()).columns == [
        "date", "pays_client", "region_client", "revenu_total", "taxes_totales",
        "remises_totales", "creances_clients", "marge_estimee", "taux_marge_pct",
        "nombre_commandes", "valeur_moyenne_commande", "age_moyen_commandes_jours",
    ]


def test_supply_chain_dashboard(edge_tables):
    model, t = Model(edge_tables), edge_tables
    got = rows_of(interface.supply_chain_dashboard(model.fct))
    assert got[0] == ("2024-05-03", 2.0, 33.33, 33.33)
    assert got[-1] == ("2024-05-09", None, 100.0, 0.0)
    direct = interface.supply_chain_dashboard_from_sources(t["orders"], t["lineitem"])
    assert rows_of(direct) == got


def test_supplier_performance(tables):
    model = Model(tables)
    got = rows_of(interface.supplier_performance(model.fct, model.suppliers))
    assert got[0] == (71, "Supplier 71", "CORA", "SOUTH", 3.67, 33.33, 33.33)
    assert len(got) == 3


def test_inventory_analysis(tables):
    got = rows_of(interface.inventory_analysis(Model(tables).fct))
    assert got == [
        ("2024-05-03", d("9.00"), 3, 5.0),
        ("2024-05-06", d("3.00"), 2, 6.5),
    ]


def test_publish_replaces_and_drops_the_stamp(spark, tables, tmp_path):
    path = str(tmp_path / "dashboard")
    name = ("finance", "finance_dashboard_view")
    finance = interface.finance_dashboard(Model(tables).finance())
    interface.publish(finance.withColumn("etl_inserted", F.current_timestamp()), path)
    location = interface.publish(finance.limit(1), path, catalog_name=name)
    seen = spark.table(".".join(name))
    assert seen.columns == finance.columns
    assert seen.count() == spark.read.parquet(location).count() == 1
    assert [p.name for p in (tmp_path / "dashboard").iterdir()] == [location.rpartition("/")[2]]
    spark.sql("DROP TABLE finance.finance_dashboard_view")


def test_a_name_follows_the_newest_place_and_columns(spark, tables, tmp_path):
    name = ("finance", "moved_view")
    finance = interface.finance_dashboard(Model(tables).finance())
    interface.publish(finance.limit(1), str(tmp_path / "first"), catalog_name=name)
    assert spark.table("finance.moved_view").count() == 1
    interface.publish(finance, str(tmp_path / "second"), catalog_name=name)
    assert spark.table("finance.moved_view").count() == 4
    interface.publish(finance.select("date"), str(tmp_path / "third"), catalog_name=name)
    assert spark.table("finance.moved_view").columns == ["date"]
    spark.sql("DROP TABLE finance.moved_view")


def test_a_failed_publish_keeps_the_old_rows(spark, tables, tmp_path):
    path, name = str(tmp_path / "dashboard"), ("finance", "kept_view")
    finance = interface.finance_dashboard(Model(tables).finance())
    location = interface.publish(finance, path, catalog_name=name)
    broken = finance.withColumn("date", F.expr("cast(assert_true(date < '2024') AS string)"))
    with pytest.raises(Exception, match="is not true"):
        interface.publish(broken, path, catalog_name=name)
    assert spark.table("finance.kept_view").count() == 4
    assert spark.read.parquet(location).count() == 4
    spark.sql("DROP TABLE finance.kept_view")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_orders_are_summed_exactly(spark, setting, ansi):
    """Beyond what 64 bits hold in cents."""
    setting("spark.sql.ansi.enabled", ansi)
    lines = spark.range(10_000).selectExpr(
        "id % 2 AS l_orderkey",
        "cast(if(id % 2 = 0, '9999999999999.99', '-9999999999999.99') AS decimal(15,2))"
        " AS l_extendedprice",
        "cast(0 AS decimal(15,2)) AS l_discount", "cast(0 AS decimal(15,2)) AS l_tax",
        "date'2024-05-01' AS l_shipdate", "date'2024-05-01' AS l_commitdate",
        "date'2024-05-01' AS l_receiptdate",
    )
    huge = lines.union(lines).union(lines)
    got = {r["totals_key"]: r["list_sum"] for r in order_totals(huge).collect()}
    assert got == {0: d("149999999999999850.00"), 1: d("-149999999999999850.00")}
