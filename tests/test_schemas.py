import pytest
from conftest import rows_of

from ledgerlake import schemas


def test_eight_tables():
    widths = {t: len(schemas.columns(t)) for t in schemas.SOURCE_TABLES}
    assert widths == {
        "region": 3, "nation": 4, "customer": 8, "supplier": 7, "part": 9, "partsupp": 5,
        "orders": 9, "lineitem": 16,
    }


def test_keys_name_existing_columns():
    every = {c for t in schemas.SOURCE_TABLES for c in schemas.columns(t)}
    assert {c for keys in schemas.PRIMARY_KEYS.values() for c in keys} <= every
    for column, (table, key) in schemas.FOREIGN_KEYS.items():
        assert column in every
        assert key in schemas.columns(table)


def test_conform_casts_orders_and_trims(spark):
    rows = spark.createDataFrame(
        [("extra", "note", "EUROPE    ", 1)], "x string, r_comment string, r_name string, r_regionkey bigint"
    )
    got = schemas.conform(rows, "region")
    assert got.schema == schemas.source_schema("region")
    assert rows_of(got) == [(1, "EUROPE", "note")]


def test_conform_names_missing_columns(spark):
    with pytest.raises(ValueError, match="r_name"):
        schemas.conform(spark.createDataFrame([(1, "n")], "r_regionkey int, r_comment string"), "region")


def test_lenient_conform_turns_unreadable_values_into_null(spark):
    rows = spark.createDataFrame([("one", "EUROPE", "n")], "r_regionkey string, r_name string, r_comment string")
    assert rows_of(schemas.conform(rows, "region", lenient=True)) == [(None, "EUROPE", "n")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        schemas.conform(rows, "region").collect()


def test_empty_has_the_schema(spark):
    assert schemas.empty(spark, "lineitem").schema == schemas.source_schema("lineitem")
