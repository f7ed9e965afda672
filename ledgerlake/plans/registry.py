"""The tables of the pipeline: what each is made from, how, and what readers see."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import schemas
from ledgerlake.operators import gold, interface, silver


@dataclass(frozen=True)
class Options:
    """Choices that change results.

    ``geo_key``: nation column compared with the region key. ``part_only``: join parts without
    the supplier. Both defaults follow the data model; ``HISTORICAL`` reproduces the older
    results. ``as_of``: the day open orders are aged to, None for today.
    """

    geo_key: str = "n_regionkey"
    part_only: bool = False
    as_of: date | None = None


HISTORICAL = Options(geo_key="n_nationkey", part_only=True)

Inputs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``transform`` gets the upstream tables by name, as readers see them, with the
    ``internal_columns`` that only other tables need. ``read_columns`` maps published to stored
    columns (None: as stored). ``direct`` makes the table in one lazy plan from
    ``direct_upstream``, where no stored table is wanted in between. ``parted_by`` names upstream
    tables and a column of each: rows whose columns differ never meet, so the table can be made
    in parts.
    """

    name: str
    layer: str
    primary_keys: tuple[str, ...]
    upstream: tuple[str, ...] = ()
    transform: Callable[[Inputs, Options], DataFrame] | None = None
    read_columns: Mapping[str, str] | None = None
    internal_columns: tuple[str, ...] = ()
    direct_upstream: tuple[str, ...] = ()
    direct: Callable[[Inputs, Options], DataFrame] | None = None
    parted_by: Mapping[str, str] | None = None
    jdbc_table: str | None = None
    jdbc_partition_column: str | None = None

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.layer}/{self.name}"

    def published(self, stored: DataFrame, internal: bool = False) -> DataFrame:
        """What readers see of a stored (or just computed) table."""
        if self.read_columns is None:
            return stored
        named = [F.col(source).alias(name) for name, source in self.read_columns.items()]
        if internal:
            named += [F.col(name) for name in self.internal_columns]
        if schemas.STAMP in stored.columns:
            named.append(F.col(schemas.STAMP))
        return stored.select(*named)


def _same(names: list[str]) -> dict[str, str]:
    return {n: n for n in names}


def _bronze(table: str) -> TableSpec:
    small = table in ("region", "nation")
    return TableSpec(
        name=table,
        layer="bronze",
        primary_keys=schemas.PRIMARY_KEYS[table],
        read_columns=_same(schemas.columns(table)),
        jdbc_table=f"public.{table}",
        # the first key column splits the scan; nation and region are one task each
        jdbc_partition_column=None if small else schemas.PRIMARY_KEYS[table][0],
    )


def _geo(t: Inputs, o: Options) -> DataFrame:
    return silver.geo(t["nation"], t["region"], o.geo_key)


def _dim_part(t: Inputs, o: Options) -> DataFrame:
    suppliers = silver.supplier_enriched(t["supplier"], _geo(t, o))
    return silver.dim_part(t["part"], t["partsupp"], suppliers)


def _wide(t: Inputs, o: Options) -> DataFrame:
    return gold.wide_order_details(
        t["fct_orders"], t["dim_customer"], t["dim_part"], o.part_only
    )


def _wide_direct(t: Inputs, o: Options) -> DataFrame:
    return gold.wide_order_details_from_sources(
        t["orders"],
        t["lineitem"],
        t["dim_customer"],
        silver.dim_part(t["part"], t["partsupp"]),
        o.part_only,
        silver.supplier_enriched(t["supplier"], _geo(t, o)),
    )


def _finance_direct(t: Inputs, o: Options) -> DataFrame:
    offers = t["partsupp"] if o.part_only else None
    return gold.finance_metrics_from_sources(
        t["orders"], t["lineitem"], t["customer"], _geo(t, o), o.as_of, offers
    )


def _sales_direct(t: Inputs, o: Options) -> DataFrame:
    if o.part_only:  # distinct parts and averages over the repeated lines
        wide = _wide_direct(t, o).withColumnRenamed("region_name", "customer_region")
        return gold.daily_sales_metrics(wide)
    return gold.daily_sales_metrics_from_sources(t["orders"], t["lineitem"], t["dim_customer"])


# The columns readers of each stored table see.
_DIM_CUSTOMER_READ = [
    "customer_key",
    "customer_name",
    "street_address",
    "nation_name",
    "region_name",
    "phone_number",
    "account_balance",
    "market_segment",
]

# supplier_key rides along so that the wide table can join the supplier's own offer
_DIM_PART_READ = [
    "part_key",
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
    "supplier_key",
    "supplier_name",
    "supplier_account_balance",
    "manufacturing_country",
    "manufacturing_region",
]

_OFFERED_FROM = ("part", "partsupp", "supplier", "nation", "region")

REGISTRY: dict[str, TableSpec] = {
    spec.name: spec
    for spec in [
        *[_bronze(t) for t in schemas.SOURCE_TABLES],
        TableSpec(
            name="fct_orders",
            layer="silver",
            primary_keys=("order_key", "line_number"),
            upstream=("orders", "lineitem"),
            transform=lambda t, o: silver.fct_orders(t["orders"], t["lineitem"]),
        ),
        TableSpec(
            name="dim_customer",
            layer="silver",
            primary_keys=("customer_key",),
            upstream=("customer", "nation", "region"),
            transform=lambda t, o: silver.dim_customer(t["customer"], _geo(t, o)),
            read_columns=_same(_DIM_CUSTOMER_READ),
        ),
        TableSpec(
            name="dim_part",
            layer="silver",
            primary_keys=("part_key", "supplier_key"),
            upstream=_OFFERED_FROM,
            transform=_dim_part,
            read_columns=_same(_DIM_PART_READ),
        ),
        TableSpec(
            name="wide_order_details",
            layer="gold",
            primary_keys=("order_key", "line_number"),
            upstream=("fct_orders", "dim_customer", "dim_part"),
            transform=_wide,
            read_columns=gold.WIDE_READ_COLUMNS,
            internal_columns=("customer_key", "part_key"),  # the sales metrics count them
            direct_upstream=("orders", "lineitem", "dim_customer", *_OFFERED_FROM),
            direct=_wide_direct,
            parted_by={"fct_orders": "part_key", "dim_part": "part_key"},
        ),
        TableSpec(
            name="finance_metrics",
            layer="gold",
            primary_keys=("date", "customer_nation", "customer_region"),
            upstream=("wide_order_details",),
            transform=lambda t, o: gold.finance_metrics(t["wide_order_details"], o.as_of),
            direct_upstream=("orders", "lineitem", "customer", "nation", "region", "partsupp"),
            direct=_finance_direct,
        ),
        TableSpec(
            name="daily_sales_metrics",
            layer="gold",
            primary_keys=("date", "market_segment", "region"),
            upstream=("wide_order_details",),
            transform=lambda t, o: gold.daily_sales_metrics(t["wide_order_details"]),
            read_columns=gold.SALES_READ_COLUMNS,
            direct_upstream=("orders", "lineitem", "dim_customer", *_OFFERED_FROM),
            direct=_sales_direct,
        ),
    ]
}


@dataclass(frozen=True)
class Published:
    """A business-named output: the catalog name and folder it is published under."""

    schema: str
    table: str
    folder: str
    upstream: tuple[str, ...]
    make: Callable[[Inputs, Options], DataFrame]

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/interface/{self.folder}"


def _supplier_performance(t: Inputs, o: Options) -> DataFrame:
    suppliers = silver.supplier_enriched(t["supplier"].drop(schemas.STAMP), _geo(t, o))
    return interface.supplier_performance(t["fct_orders"], suppliers)


PUBLISHED: dict[str, Published] = {
    "finance_dashboard": Published(
        "finance",
        "finance_dashboard_view",
        "finance/dashboard",
        ("finance_metrics",),
        lambda t, o: interface.finance_dashboard(t["finance_metrics"]),
    ),
    "supply_chain_dashboard": Published(
        "supply_chain",
        "supply_chain_dashboard_view",
        "supply_chain/dashboard",
        ("fct_orders",),
        lambda t, o: interface.supply_chain_dashboard(t["fct_orders"]),
    ),
    "supplier_performance": Published(
        "supply_chain",
        "supplier_performance_view",
        "supply_chain/supplier_performance",
        ("fct_orders", "supplier", "nation", "region"),
        _supplier_performance,
    ),
    "inventory_analysis": Published(
        "supply_chain",
        "inventory_analysis_view",
        "supply_chain/inventory_analysis",
        ("fct_orders",),
        lambda t, o: interface.inventory_analysis(t["fct_orders"]),
    ),
    "daily_sales_report": Published(
        "general",
        "daily_sales_report_view",
        "daily_sales_report",
        ("daily_sales_metrics",),
        lambda t, o: interface.daily_sales_report(t["daily_sales_metrics"]),
    ),
}


def order_of(*targets: str, direct: bool = False) -> list[TableSpec]:
    """The targets and everything they are made from, upstream first, each table once.

    ``direct`` follows the tables' direct plans where they have one.
    """
    done: dict[str, TableSpec] = {}

    def visit(name: str) -> None:
        if name not in done:
            spec = REGISTRY[name]
            for upstream in spec.direct_upstream if direct and spec.direct else spec.upstream:
                visit(upstream)
            done[name] = REGISTRY[name]

    for target in targets:
        if target not in REGISTRY:
            raise KeyError(f"unknown table {target}; known: {', '.join(REGISTRY)}")
        visit(target)
    return list(done.values())


_SCHEMAS: dict[str, T.StructType] = {}


def stored_schema(spark: SparkSession, name: str) -> T.StructType:
    """The table's stored columns without the stamp, from analysing its transform on no rows."""
    spec = REGISTRY[name]
    if spec.transform is None:
        return schemas.source_schema(name)
    if name not in _SCHEMAS:
        inputs = {
            u: REGISTRY[u].published(spark.createDataFrame([], stored_schema(spark, u)), True)
            for u in spec.upstream
        }
        _SCHEMAS[name] = spec.transform(inputs, Options()).schema
    return _SCHEMAS[name]
