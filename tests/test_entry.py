"""Every registered query against its SQL, on the smallest sample."""

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlake.operators import joins

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()
#: The queries of the package of training-data operators have tests of their own.
NAMES = sorted(set(entry.queries()) - set(entry.LLM_QUERIES))


def views(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def db():
    return views(FOLDER)


@pytest.fixture(scope="module")
def skewed_folder(tmp_path_factory):
    """A third of the lines on one order and part, a third of the orders on one customer.

    Some orders have no customer, and a fifth of the lines are exact copies of one line.
    """
    folder = tmp_path_factory.mktemp("skewed")
    changed = {
        "lineitem": "SELECT * REPLACE ("
        " CASE WHEN rowid % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,"
        " CASE WHEN rowid % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey) FROM lineitem"
        " UNION ALL SELECT line.* FROM (SELECT * FROM lineitem WHERE rowid = 1) line,"
        " range(1200)",
        "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 3"
        " WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS o_custkey) FROM orders",
    }
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE TABLE {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        query = changed.get(table, f"SELECT * FROM {table}")
        connection.execute(f"COPY ({query}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    ["dim_part", "fct_orders", "wide_order_details", "wide_order_details_fanout",
     "finance_metrics", "finance_metrics_refcompat", "daily_sales_metrics",
     "supply_chain_dashboard", "supplier_performance", "inventory_analysis",
     "lazy_pipeline_finance"],
)
def test_hot_keys(spark, setting, monkeypatch, skewed_folder, name):
    """Hot keys as the sketch finds them, with joins as on large tables."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.shuffle.partitions", "8")
    setting(joins.SEARCH, "true")
    found = []
    search = joins.hot_keys
    monkeypatch.setattr(joins, "hot_keys", lambda *a: found.append(search(*a)) or found[-1])
    got = entry.queries()[name](spark, skewed_folder)
    assert_equal(got, views(skewed_folder), entry.oracle_sql()[name])
    if name not in ("dim_part", "supply_chain_dashboard"):
        assert any(found)


def assert_equal(got, connection, sql):
    """The same columns, and the same rows over them."""
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    expected = [dict(zip(names, row, strict=True)) for row in cursor.fetchall()]
    got = [row.asDict() for row in got.collect()]
    order = sorted(names)
    assert sorted(repr([r[n] for n in order]) for r in got) == sorted(
        repr([r[n] for n in order]) for r in expected
    )


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) - set(entry.LLM_QUERIES) == set(NAMES)


@pytest.mark.parametrize(
    "name",
    ["dim_customer", "dim_part", "fct_orders", "wide_order_details",
     "finance_metrics_refcompat", "daily_sales_metrics"],
)
def test_queries_as_on_large_tables(spark, setting, monkeypatch, db, name):
    """No broadcasts, and every key is salted."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    searched = []

    def every_hash(df, keys, partitions):
        searched.append(keys)
        hashes = df.select(joins.F.xxhash64(*keys)).distinct().collect()
        return [(r[0], 2 + r[0] % 3) for r in hashes]

    setting(joins.SEARCH, "true")
    monkeypatch.setattr(joins, "hot_keys", every_hash)
    assert_equal(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name])
    assert searched


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    assert_equal(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name])


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns[:3] == ["date", "customer_nation", "customer_region"]
    assert flagship.count() > 0
