"""Interface layer: business-named outputs, and publishing them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import line_metrics as m
from ledgerlake.functions.measures import mean, percentage, share
from ledgerlake.operators.gold import with_order_measures
from ledgerlake.operators.order_totals import order_totals, orders_with_totals

# Published label -> gold column.
FINANCE_LABELS = {
    "date": "date",
    "pays_client": "customer_nation",
    "region_client": "customer_region",
    "revenu_total": "total_revenue",
    "taxes_totales": "total_tax",
    "remises_totales": "total_discounts",
    "creances_clients": "accounts_receivable",
    "marge_estimee": "estimated_margin",
    "taux_marge_pct": "margin_percentage",
    "nombre_commandes": "order_count",
    "valeur_moyenne_commande": "average_order_value",
    "age_moyen_commandes_jours": "avg_open_order_age",
}

# Report heading -> gold column.
SALES_LABELS = {
    "Date": "date",
    "Market Segment": "market_segment",
    "Region": "customer_region",
    "Total Revenue": "total_sales",
    "Average Order Value": "average_order_value",
    "Order Count": "number_of_orders",
    "Late Delivery %": "late_delivery_percentage",
    "Fulfillment Rate %": "fulfillment_rate",
}


def _relabel(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(source).alias(label) for label, source in labels.items()])


def finance_dashboard(finance: DataFrame) -> DataFrame:
    return _relabel(finance, FINANCE_LABELS)


def daily_sales_report(sales: DataFrame) -> DataFrame:
    """Accepts the metrics as computed or as read back, where the region is ``region``."""
    if "customer_region" not in sales.columns:
        sales = sales.withColumnRenamed("region", "customer_region")
    return _relabel(sales, SALES_LABELS)


def _closed_share():
    return percentage(F.col("order_status") == m.CLOSED)


def _order_day():
    return F.date_format("order_date", "yyyy-MM-dd").alias("date")


def supply_chain_dashboard(fct: DataFrame) -> DataFrame:
    """Shipping delay, late share and closed share of order lines per order date."""
    return fct.groupBy(_order_day()).agg(
        F.round(F.avg("shipping_delay_days"), 2).alias("delai_moyen_expedition_jours"),
        percentage(F.col("is_late_delivery")).alias("livraisons_tardives_pct"),
        _closed_share().alias("taux_execution_commandes_pct"),
    )


def supply_chain_dashboard_from_sources(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """``supply_chain_dashboard`` straight from orders and lines."""
    summed = with_order_measures(
        orders_with_totals(
            orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), order_totals(lineitem)
        )
    )
    return summed.groupBy(_order_day()).agg(
        mean("shipping_sum", "shipping_count").alias("delai_moyen_expedition_jours"),
        share("late_count").alias("livraisons_tardives_pct"),
        share("closed_count").alias("taux_execution_commandes_pct"),
    )


def supplier_performance(fct: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Delivery measures per supplier, with the supplier's name and place.

    Lines are aggregated before the supplier is looked up, so a hot supplier is one row by then.
    """
    measured = fct.groupBy("supplier_key").agg(
        F.round(F.avg("delivery_delay_days"), 2).alias("delai_moyen_livraison_jours"),
        percentage(F.col("is_late_delivery")).alias("taux_retard_pct"),
        _closed_share().alias("taux_execution_pct"),
    )
    names = suppliers.select(
        "s_suppkey", "supplier_name", "manufacturing_country", "manufacturing_region"
    )
    return measured.join(names, F.col("supplier_key") == F.col("s_suppkey"), "left").select(
        "supplier_key",
        "supplier_name",
        "manufacturing_country",
        "manufacturing_region",
        "delai_moyen_livraison_jours",
        "taux_retard_pct",
        "taux_execution_pct",
    )


def inventory_analysis(fct: DataFrame) -> DataFrame:
    """Ordered quantity, distinct products and order-to-receipt days per order date."""
    return fct.groupBy(_order_day()).agg(
        F.sum("quantity").alias("quantite_commandee"),
        F.count_distinct("part_key").alias("nombre_produits_distincts"),
        F.round(F.avg(F.datediff("receipt_date", "order_date")), 2).alias("temps_traitement_jours"),
    )


def publish(
    df: DataFrame, path: str, fmt: str = "parquet", catalog_name: tuple[str, str] | None = None
) -> str:
    """Replace the published table under ``path``; the folder that holds it now.

    The rows go to a new folder, the catalog's table is pointed there once it is complete, and
    only then the older folders go. A publish that fails leaves the table as it was. The run
    stamp is not published.
    """
    spark = df.sparkSession
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    older = [s.getPath() for s in fs.listStatus(location)] if fs.exists(location) else []
    new = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    try:
        df.drop("etl_inserted").write.format(fmt).save(new)
        if catalog_name:
            register(spark, *catalog_name, new, fmt)
    except Exception:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(new), True)
        raise
    for folder in older:
        fs.delete(folder, True)
    return new


def publish_view(df: DataFrame, name: str) -> None:
    """Publish as a view that every session of the application sees in ``global_temp``."""
    df.createOrReplaceGlobalTempView(name)


def register(spark: SparkSession, schema: str, table: str, path: str, fmt: str = "parquet") -> None:
    """Make a stored table queryable by name in the session catalog.

    A table of that name is pointed to ``path``; with other columns it is made anew. Its files
    are not the catalog's to delete.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    name, location = f"`{schema}`.`{table}`", path.replace("'", "\\'")
    if spark.catalog.tableExists(f"{schema}.{table}"):
        stored = spark.read.format(fmt).load(path).dtypes
        if spark.table(name).dtypes == stored:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(f"{schema}.{table}")
            return
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{location}'")
