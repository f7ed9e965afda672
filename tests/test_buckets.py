import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from ledgerlake.operators import silver
from ledgerlake.plans import buckets, pipeline


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def schema(spark, request):
    name = f"b_{abs(hash(request.node.name))}"
    yield name
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def plan(df):
    df.collect()  # adaptive plans are final once they ran
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def keep(spark, tables, schema, path, numbers=(4, 4)):
    for table, n in zip(("orders", "lineitem"), numbers, strict=True):
        buckets.store(tables[table], schema, table, f"{path}/{table}", n)
    return buckets.source(spark, schema, lambda t: tables[t])


def test_orders_and_lines_join_without_a_shuffle(spark, tables, tmp_path, schema, no_broadcast):
    source = keep(spark, tables, schema, tmp_path)
    assert buckets.spec_of(spark, schema, "lineitem") == (4, ["l_orderkey"])
    fact = silver.fct_orders(source("orders"), source("lineitem"))
    assert "Exchange" not in plan(fact)
    plain = silver.fct_orders(tables["orders"], tables["lineitem"])
    assert "Exchange" in plan(plain)
    assert rows(fact) == rows(plain) and rows(fact)


def test_the_fact_groups_by_order_without_a_shuffle(spark, tables, tmp_path, schema, no_broadcast):
    fact = silver.fct_orders(tables["orders"], tables["lineitem"])
    buckets.store(fact, schema, "fct_orders", str(tmp_path), 8)
    kept = spark.table(f"{schema}.fct_orders")
    sums = kept.groupBy("order_key").agg(F.sum("quantity").alias("q"))
    assert "Exchange" not in plan(sums)
    assert rows(sums) == rows(fact.groupBy("order_key").agg(F.sum("quantity").alias("q")))


def test_other_numbers_of_buckets_still_join_right(spark, tables, tmp_path, schema, no_broadcast):
    source = keep(spark, tables, schema, tmp_path, (2, 8))
    fact = silver.fct_orders(source("orders"), source("lineitem"))
    assert plan(fact).count("Exchange") <= 2
    assert rows(fact) == rows(silver.fct_orders(tables["orders"], tables["lineitem"]))


def test_other_tables_come_from_elsewhere(spark, tables, tmp_path, schema):
    source = keep(spark, tables, schema, tmp_path)
    built = pipeline.build("fct_orders", source, run_ts=RUN_TS)
    assert rows(built) == rows(pipeline.build("fct_orders", lambda t: tables[t], run_ts=RUN_TS))
    assert source("nation") is tables["nation"]


def test_stored_again_and_failing(spark, tables, tmp_path, schema):
    for n in (2, 4):
        buckets.store(tables["orders"], schema, "orders", str(tmp_path), n)
    assert buckets.spec_of(spark, schema, "orders")[0] == 4
    broken = tables["orders"].withColumn("o_comment", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        buckets.store(broken, schema, "orders", str(tmp_path), 8)
    assert buckets.spec_of(spark, schema, "orders")[0] == 4
    assert rows(spark.table(f"{schema}.orders")) == rows(tables["orders"])
    assert spark.catalog.listTables(schema)[0].name == "orders"
    assert len(spark.catalog.listTables(schema)) == 1
    buckets.store(tables["orders"].limit(0), schema, "orders", str(tmp_path), 4)
    assert spark.table(f"{schema}.orders").count() == 0


def test_numbers():
    sizes = [0, 1, 256 << 20, (256 << 20) + 1, 3 << 30, 100 << 40]
    assert [buckets.number_for(n) for n in sizes] == [1, 1, 1, 2, 16, 1 << 19]


def test_number_of_buckets_grows_with_the_rows(spark):
    wide = "id", *[f"cast(id AS string) AS s{i}" for i in range(4)]
    few, many = (spark.range(n).selectExpr(*wide) for n in (1_000, 16_000))
    width = few._jdf.schema().defaultSize()
    assert buckets.number_of(few, 1_000 * width) == 1
    assert buckets.number_of(many, 1_000 * width) == 16
    assert buckets.number_of(few, 1_000 * width, least=8) == 8
    assert buckets.number_of(few.limit(0)) == 1


def test_bucketed_query_takes_its_buckets_from_the_rows(spark, monkeypatch):
    import __spark_entry__ as entry

    seen = []
    store = buckets.store
    monkeypatch.setattr(
        buckets, "number_of", lambda df, least: seen.append(df.count()) or max(least, 16)
    )
    monkeypatch.setattr(buckets, "store", lambda *a: seen.append(a[-1]) or store(*a))
    entry.queries()["fct_orders_bucketed"](spark, "/root/testdata/sf0.001").count()
    assert seen[0] > 0 and seen[1:] == [16, 16]
