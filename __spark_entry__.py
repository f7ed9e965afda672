"""Registered queries and the SQL they are compared with.

``entry`` runs the flagship query, ``queries`` maps names to ``(spark, folder) -> DataFrame``
over the sample tables, ``oracle_sql`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from ledgerlake import schemas  # noqa: E402
from ledgerlake.operators import gold, interface, quality, references, silver  # noqa: E402
from ledgerlake.operators.joins import join_dimension  # noqa: E402
from ledgerlake.plans import buckets, clustering, pipeline, snapshots, statistics  # noqa: E402
from ledgerlake.plans.registry import HISTORICAL, REGISTRY, Options  # noqa: E402
from ledgerlake.session import scratch_path  # noqa: E402
from ledgerlake.sources import files, jdbc, sample  # noqa: E402

try:  # the package of training-data operators and its pipeline may be absent
    import corpus_pipeline
    from ledgerlake.llm import queries as llm_queries

    LLM_QUERIES = llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    LLM_SQL = llm_queries.oracle_sql()
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "ledgerlake.llm"):
        raise
    LLM_QUERIES, LLM_SQL = {}, {}

AS_OF = date.fromisoformat(oracles.AS_OF)
Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """The sample's source tables, and what is modelled from them."""

    def __init__(self, spark: SparkSession, folder: str, geo_key: str = "n_regionkey"):
        self.spark, self.folder, self.geo_key = spark, folder, geo_key
        self._loaded: dict[str, DataFrame] = {}

    def source(self, table: str) -> DataFrame:
        if table not in self._loaded:
            self._loaded[table] = sample.load(self.spark, self.folder, table)
        return self._loaded[table]

    def geo(self) -> DataFrame:
        return silver.geo(self.source("nation"), self.source("region"), self.geo_key)

    def suppliers(self) -> DataFrame:
        return silver.supplier_enriched(self.source("supplier"), self.geo())

    def customers(self) -> DataFrame:
        return silver.dim_customer(self.source("customer"), self.geo())

    def parts(self) -> DataFrame:
        return silver.dim_part(self.source("part"), self.source("partsupp"), self.suppliers())

    def fct(self) -> DataFrame:
        return silver.fct_orders(self.source("orders"), self.source("lineitem"))

    def wide(self) -> DataFrame:
        return gold.wide_order_details_from_sources(
            self.source("orders"),
            self.source("lineitem"),
            self.customers(),
            silver.dim_part(self.source("part"), self.source("partsupp")),
            suppliers=self.suppliers(),
        )

    def sales(self) -> DataFrame:
        return gold.daily_sales_metrics_from_sources(
            self.source("orders"), self.source("lineitem"), self.customers()
        )

    def finance(self, historical: bool = False) -> DataFrame:
        return gold.finance_metrics_from_sources(
            self.source("orders"),
            self.source("lineitem"),
            self.source("customer"),
            self.geo(),
            AS_OF,
            self.source("partsupp") if historical else None,
        )


def _portable(df: DataFrame) -> DataFrame:
    """Money as double and dates as text, which every engine hands out alike."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(f"`{field.name}`").cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(f"`{field.name}`", "yyyy-MM-dd").alias(field.name)
        return F.col(f"`{field.name}`")

    return df.drop(schemas.STAMP).select(
        *[column(f) for f in df.schema.fields if f.name != schemas.STAMP]
    )


def _dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables(spark, folder)
    reports = [
        quality.not_null_report(tables.source(t), t, quality.SUITES[t])
        for t in schemas.SOURCE_TABLES
    ]
    return reduce(DataFrame.unionByName, reports)


def _dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Both expectations of every source table on its stamped form."""
    run_ts = datetime.now(timezone.utc)
    tables = Tables(spark, folder)
    reports = [
        quality.report(snapshots.stamp(tables.source(t), run_ts), t, quality.SUITES[t])
        for t in schemas.SOURCE_TABLES
    ]
    return reduce(DataFrame.unionByName, reports)


def _two_snapshots(spark: SparkSession, folder: str, table: str) -> tuple[str, datetime]:
    """Store a table twice, the newer snapshot whole and the older one with other text."""
    rows = sample.load(spark, folder, table)
    comment = rows.columns[-1]
    path = scratch_path(spark, table)
    newer = datetime.now(timezone.utc)
    older = rows.withColumn(comment, F.lit("superseded"))
    snapshots.write_snapshot(older, path, newer - timedelta(days=1))
    snapshots.write_snapshot(rows, path, newer, rebalance=True)
    return path, newer


def _snapshot_latest(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = _two_snapshots(spark, folder, "orders")
    return snapshots.read(spark, path, schemas.source_schema("orders"))


def _snapshot_by_partition(spark: SparkSession, folder: str) -> DataFrame:
    path, newer = _two_snapshots(spark, folder, "customer")
    schema = schemas.source_schema("customer")
    return snapshots.read(spark, path, schema, partition_values={schemas.STAMP: newer})


def _snapshot_compacted(spark: SparkSession, folder: str) -> DataFrame:
    path, _ = _two_snapshots(spark, folder, "orders")
    schema = schemas.source_schema("orders")
    snapshots.compact(spark, path, schema)
    snapshots.retain(spark, path)
    return snapshots.read(spark, path, schema, every_snapshot=True)


def _snapshot_merged(spark: SparkSession, folder: str) -> DataFrame:
    """A history whose older snapshot lacks a column, read with both snapshots' columns."""
    rows = sample.load(spark, folder, "customer")
    path = scratch_path(spark, "customer")
    newer = datetime.now(timezone.utc)
    snapshots.write_snapshot(rows.drop("c_comment"), path, newer - timedelta(days=1))
    snapshots.write_snapshot(rows, path, newer)
    return snapshots.read(spark, path, merge_schema=True, every_snapshot=True)


def _snapshot_clustered(spark: SparkSession, folder: str) -> DataFrame:
    """The fact stored for filters on date and customer, and some days of some customers."""
    path = scratch_path(spark, "fct_orders")
    fct = Tables(spark, folder).fct()
    run_ts = datetime.now(timezone.utc)
    snapshots.write_snapshot(fct, path, run_ts, cluster_by=("order_date", "customer_key"))
    stored = snapshots.read(spark, path, fct.schema)
    days = F.col("order_date").between(F.lit(date(1995, 3, 1)), F.lit(date(1996, 2, 28)))
    return stored.filter(days & F.col("customer_key").between(100, 400))


def _tbl(table: str) -> Query:
    """Write a table as delimited text and read it back."""

    def round_trip(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_path(spark, f"{table}.tbl")
        files.write_tbl(sample.load(spark, folder, table), path)
        return files.read_tbl(spark, path, table)

    return round_trip


def _dq_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Check every stamped source table in a run that is repeated, and read the results back."""
    run_ts, path = datetime.now(timezone.utc), scratch_path(spark, "checks")
    tables = Tables(spark, folder)
    for table in (*schemas.SOURCE_TABLES, *schemas.SOURCE_TABLES):
        rows = snapshots.stamp(tables.source(table), run_ts)
        quality.validate(rows, table, run_ts, results_path=path)
    return quality.read_results(spark, path).drop("run_ts", "observed")


def _fct_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The order-line fact from orders and lines kept in buckets of the order key."""
    path = scratch_path(spark, "buckets")
    schema = f"buckets_{path.rpartition('-')[2]}"
    plain = pipeline.sample_source(spark, folder)
    n_buckets = buckets.number_of(plain("lineitem"), least=8)
    for table in ("orders", "lineitem"):
        buckets.store(plain(table), schema, table, f"{path}/{table}", n_buckets)
    source = buckets.source(spark, schema, plain)
    return silver.fct_orders(source("orders"), source("lineitem"))


def _dq_watched(spark: SparkSession, folder: str) -> DataFrame:
    """Every source table stored with checks that count as it is written; what they saw."""
    source, root = pipeline.sample_source(spark, folder), scratch_path(spark, "checked")
    path = scratch_path(spark, "watched")
    run_ts = datetime.now(timezone.utc)
    for table in schemas.SOURCE_TABLES:
        spec = REGISTRY[table]
        pipeline.run_table(spark, spec, source(table), root, run_ts, results_path=path)
    columns = F.size(F.split("observed", ", "))
    nulls = F.split("observed", " ")[0]
    shape = F.col("expectation") == quality.COLUMNS_MATCH
    return quality.read_results(spark, path).select(
        "table", "expectation", "column", "success",
        F.when(shape, columns).otherwise(nulls).cast("long").alias("observed"), "row_count",
    )


def _key_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in each range of equal row counts, as a scan of the lines over JDBC would split."""
    lines = sample.load(spark, folder, "lineitem").select("l_orderkey")
    lines.createOrReplaceTempView("lines_to_split")
    (cuts,) = clustering.bucket_bounds(lines, ("l_orderkey",))
    sql = jdbc.histogram_sql("lines_to_split", "l_orderkey", 16, cuts)
    histogram = [(r["part"], r["low"], r["n"]) for r in spark.sql(sql).collect()]
    found = jdbc.range_predicates("l_orderkey", histogram)
    meets = F.array(*[F.expr(p) for p in found])
    place = F.array_position(meets, True).cast("int")
    return lines.groupBy(place.alias("range")).agg(
        F.count("*").alias("n_rows"), F.min("l_orderkey").alias("low")
    )


def _dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without a parent for every foreign key of the eight tables."""
    tables = Tables(spark, folder)
    return references.orphan_report({t: tables.source(t) for t in schemas.SOURCE_TABLES})


def _dq_orphans_found(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines whose order is not of the first of the segments."""
    tables = Tables(spark, folder)
    built = tables.source("customer").filter("c_mktsegment = 'BUILDING'")
    orders = tables.source("orders")
    their = orders.join(built, orders["o_custkey"] == built["c_custkey"], "left_semi")
    found = references.orphans(tables.source("lineitem"), "l_orderkey", their, "o_orderkey")
    return found.select("l_orderkey", "l_linenumber")


def _tbl_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text in which some lines are damaged: rows read, and rejects by reason."""
    orders = sample.load(spark, folder, "orders")
    clean, path = scratch_path(spark, "orders.tbl"), scratch_path(spark, "damaged.tbl")
    files.write_tbl(orders, clean)
    key = F.split("value", r"\|")[0].cast("long")
    spark.read.text(clean).select(
        F.when(key % 13 == 0, F.regexp_replace("value", r"^(\d+\|\d+)\|.*$", "$1|"))
        .when(key % 17 == 0, F.regexp_replace("value", r"^(\d+)\|(\d+)\|", "$1|x$2|"))
        .otherwise(F.col("value"))
        .alias("value")
    ).write.text(path)
    loaded = files.load_tbl(spark, path, "orders", scratch_path(spark, "rejects"), 0.5)
    read = loaded.rows.select(F.lit("read").alias("reason"), F.col("o_orderkey").alias("key"))
    rest = loaded.rejects.select("reason", F.split("line", r"\|")[0].cast("long").alias("key"))
    return (
        read.unionByName(rest)
        .groupBy("reason")
        .agg(F.count("*").alias("n_rows"), F.sum("key").alias("key_sum"))
    )


def _published_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "dashboard")
    dashboard = interface.finance_dashboard(Tables(spark, folder).finance())
    stamped = snapshots.stamp(dashboard, datetime.now(timezone.utc))
    return spark.read.parquet(interface.publish(stamped, path))


def _published_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Publish part of a dashboard, then the whole one elsewhere, and read it by its name."""
    dashboard = interface.finance_dashboard(Tables(spark, folder).finance())
    name = ("finance", "finance_dashboard_view")
    first = dashboard.limit(3)
    interface.publish(first, scratch_path(spark, "first"), catalog_name=name)
    interface.publish(dashboard, scratch_path(spark, "second"), catalog_name=name)
    return spark.table(".".join(name))


def _wealthy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of customers with high balances; the catalog's histogram decides the join."""
    tables = Tables(spark, folder)
    schema, name = "statistics", f"customer_{uuid4().hex}"
    interface.publish(
        tables.source("customer"), scratch_path(spark, "customer"), catalog_name=(schema, name)
    )
    statistics.analyze(spark, schema, name, ["c_custkey", "c_acctbal"])
    wealthy = spark.table(f"{schema}.{name}").filter("c_acctbal >= 9000")
    with statistics.used(spark):
        joined = join_dimension(
            tables.source("orders").select("o_orderkey", "o_custkey"),
            wealthy.select("c_custkey", "c_nationkey"),
            {"o_custkey": "c_custkey"},
            "inner",
        )
    return joined.groupBy(F.col("c_nationkey").alias("nation_key")).agg(
        F.count("o_orderkey").alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )


def _published_view(spark: SparkSession, folder: str) -> DataFrame:
    report = interface.daily_sales_report(Tables(spark, folder).sales())
    interface.publish_view(report, "daily_sales_report")
    return spark.table("global_temp.daily_sales_report")


def _sales_groups(tables: Tables) -> DataFrame:
    """How many rows the sales report must have."""
    lines = gold.located_order_lines(
        tables.source("orders"), tables.source("lineitem"), tables.customers()
    )
    return (
        lines.select("order_date", "market_segment", "region_name")
        .distinct()
        .agg(F.count(F.lit(1)).alias("group_count"))
    )


def _read(name: str) -> Query:
    """A table as readers see it."""
    return lambda spark, folder: pipeline.build(name, pipeline.sample_source(spark, folder))


def _lazy_finance(spark: SparkSession, folder: str) -> DataFrame:
    source = pipeline.sample_source(spark, folder)
    return pipeline.build("finance_metrics", source, Options(as_of=AS_OF))


def _persisted(name: str, options: Options = Options(as_of=AS_OF)) -> Query:
    """A table computed through the stored snapshots of everything it is made from."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        source = pipeline.sample_source(spark, folder)
        return pipeline.run(spark, name, source, scratch_path(spark, "pipeline"), options)

    return run


def _persisted_output(name: str) -> Query:
    """A published output, from stored snapshots to the published files."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        source = pipeline.sample_source(spark, folder)
        root = scratch_path(spark, "pipeline")
        return pipeline.run_published(spark, [name], source, root, Options(as_of=AS_OF))[name]

    return run


def _bronze(table: str) -> Query:
    return lambda spark, folder: sample.load(spark, folder, table)


def _modelled(make: Callable[[Tables], DataFrame], geo_key: str = "n_regionkey") -> Query:
    return lambda spark, folder: make(Tables(spark, folder, geo_key))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        **{f"bronze_{t}": _bronze(t) for t in schemas.SOURCE_TABLES},
        "dq_not_null": _dq_not_null,
        "dq_report": _dq_report,
        "geo_nation_region": _modelled(Tables.geo),
        "geo_nation_region_refkey": _modelled(Tables.geo, "n_nationkey"),
        "supplier_enriched": _modelled(Tables.suppliers),
        "part_enriched": _modelled(lambda t: silver.part_enriched(t.source("part"))),
        "dim_customer": _modelled(Tables.customers),
        "dim_customer_refkey": _modelled(Tables.customers, "n_nationkey"),
        "dim_part": _modelled(Tables.parts),
        "fct_orders": _modelled(Tables.fct),
        "fct_orders_bucketed": _fct_bucketed,
        "wide_order_details": _modelled(Tables.wide),
        "wide_order_details_fanout": _modelled(
            lambda t: gold.fanout_by_date(
                t.source("orders"), t.source("lineitem"), t.source("partsupp")
            )
        ),
        "finance_metrics": _modelled(Tables.finance),
        "finance_metrics_refcompat": _modelled(
            lambda t: t.finance(historical=True), "n_nationkey"
        ),
        "finance_dashboard": _modelled(lambda t: interface.finance_dashboard(t.finance())),
        "daily_sales_metrics": _modelled(Tables.sales),
        "daily_sales_report": _modelled(lambda t: interface.daily_sales_report(t.sales())),
        "supply_chain_dashboard": _modelled(
            lambda t: interface.supply_chain_dashboard_from_sources(
                t.source("orders"), t.source("lineitem")
            )
        ),
        "supplier_performance": _modelled(
            lambda t: interface.supplier_performance(t.fct(), t.suppliers())
        ),
        "inventory_analysis": _modelled(lambda t: interface.inventory_analysis(t.fct())),
        "snapshot_latest": _snapshot_latest,
        "snapshot_by_partition": _snapshot_by_partition,
        "snapshot_compacted": _snapshot_compacted,
        "snapshot_merged_schema": _snapshot_merged,
        "snapshot_clustered": _snapshot_clustered,
        "tbl_orders": _tbl("orders"),
        "tbl_lineitem": _tbl("lineitem"),
        "dq_results_saved": _dq_saved,
        "dq_watched": _dq_watched,
        "jdbc_key_ranges": _key_ranges,
        "dq_orphans": _dq_orphans,
        "dq_orphans_found": _dq_orphans_found,
        "tbl_rejects": _tbl_rejects,
        "dim_customer_read": _read("dim_customer"),
        "dim_part_read": _read("dim_part"),
        "wide_order_details_read": _persisted("wide_order_details"),
        "published_finance_dashboard": _published_dashboard,
        "statistics_wealthy_orders": _wealthy_orders,
        "published_twice": _published_twice,
        "published_sales_view": _published_view,
        "daily_sales_group_count": _modelled(_sales_groups),
        "lazy_pipeline_finance": _lazy_finance,
        "lazy_daily_sales_metrics": _read("daily_sales_metrics"),
        "persisted_pipeline_finance": _persisted("finance_metrics"),
        "persisted_finance_historical": _persisted(
            "finance_metrics", Options(HISTORICAL.geo_key, HISTORICAL.part_only, AS_OF)
        ),
        "persisted_daily_sales_metrics": _persisted("daily_sales_metrics"),
        "persisted_daily_sales_report": _persisted_output("daily_sales_report"),
        "persisted_supply_chain_dashboard": _persisted_output("supply_chain_dashboard"),
    }

    def portable(query: Query) -> Query:
        return lambda spark, folder: _portable(query(spark, folder))

    return {name: portable(query) for name, query in found.items()} | LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    return oracles.build() | LLM_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily finance metrics by customer nation and region."""
    return queries()["finance_metrics"](spark, "/root/testdata/sf0.001")
