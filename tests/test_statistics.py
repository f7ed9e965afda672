import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import interface
from ledgerlake.operators.joins import fits_broadcast
from ledgerlake.plans import statistics


@pytest.fixture
def uneven(spark, tmp_path):
    """A published table of 20,000 rows, 200 of them far above the others, and a null."""
    name = f"uneven_{uuid.uuid4().hex}"
    value = F.when(F.col("id") % 100 == 7, 500 + F.col("id") % 500).otherwise(F.col("id") % 10)
    rows = spark.range(20_000).select(
        F.col("id").alias("key"), F.when(F.col("id") > 0, value).alias("value")
    )
    interface.publish(rows, str(tmp_path / "t"), catalog_name=("statistics_test", name))
    yield name
    spark.sql(f"DROP TABLE statistics_test.{name}")


def described(spark, name, column):
    rows = spark.sql(f"DESCRIBE EXTENDED statistics_test.{name} `{column}`").collect()
    return {r.info_name: r.info_value for r in rows}


def test_analysis_counts_the_whole_table(spark, uneven):
    statistics.analyze(spark, "statistics_test", uneven, ["key", "value"])
    found = described(spark, uneven, "value")
    assert (found["min"], found["max"], found["num_nulls"]) == ("0", "907", "1")
    assert "num_of_bins" in found["histogram"]
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"


def test_the_histogram_decides_the_broadcast(spark, uneven, monkeypatch):
    few, many = (spark.table(f"statistics_test.{uneven}").filter(c) for c in
                 ("value >= 500", "value < 500"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "30000")
    try:
        assert not fits_broadcast(few) and not fits_broadcast(many)
        statistics.analyze(spark, "statistics_test", uneven, ["key", "value"])
        few, many = (spark.table(f"statistics_test.{uneven}").filter(c) for c in
                     ("value >= 500", "value < 500"))
        with statistics.used(spark):
            assert fits_broadcast(few) and not fits_broadcast(many)
            orders = spark.range(200_000).withColumnRenamed("id", "key")
            plan = orders.join(few, "key")._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan
            plan = orders.join(many, "key")._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_published_anew_has_no_stale_statistics(spark, uneven, tmp_path):
    statistics.analyze(spark, "statistics_test", uneven, ["value"])
    rows = spark.table(f"statistics_test.{uneven}").filter("value < 3")
    interface.publish(rows, str(tmp_path / "u"), catalog_name=("statistics_test", uneven))
    assert described(spark, uneven, "value").get("max") in (None, "NULL")
