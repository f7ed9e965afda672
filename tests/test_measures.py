"""Line amounts against exact decimal arithmetic, and sums at their limits."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import frame
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.functions import line_metrics as m
from ledgerlake.operators.order_totals import order_totals

CENT = Decimal("0.01")


def cents(value):
    return value.quantize(CENT, rounding=ROUND_HALF_UP)


@pytest.fixture(scope="module")
def amounts():
    draw = random.Random(7)
    rows = [(Decimal(draw.randrange(1, 10**draw.randrange(1, 13))) * CENT,
             Decimal(draw.randrange(0, 101)) * CENT,
             Decimal(draw.randrange(0, 31)) * CENT) for _ in range(3000)]
    return [*rows, (Decimal("0.05"), Decimal("0.50"), Decimal("0.00")), (None, CENT, CENT)]


def test_line_amounts_are_exact(spark, amounts):
    lines = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(amounts)],
        "id int, p decimal(15,2), d decimal(15,2), t decimal(15,2)",
    )
    got = lines.select(
        "id",
        m.net_amount("p", "d", "t").alias("net"),
        m.discount_amount("p", "d").alias("discount"),
        m.tax_amount("p", "d", "t").alias("tax"),
    )
    for row in got.collect():
        price, discount, tax = amounts[row["id"]]
        if price is None:
            assert (row["net"], row["discount"], row["tax"]) == (None, None, None)
            continue
        assert row["net"] == cents(price * (1 - discount) * (1 + tax))
        assert row["discount"] == cents(price * discount)
        assert row["tax"] == cents(price * (1 - discount) * tax)


def many_lines(spark, price, count):
    line = frame(spark, "lineitem", [(1, 101, 1, 1, 1, 1, 0.0, 0.0, 9, 9, 12)])
    priced = line.withColumn("l_extendedprice", F.lit(Decimal(price)).cast("decimal(15,2)"))
    copies = priced.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(count)))).drop("n")
    return schemas.conform(copies, "lineitem")


def test_large_orders_add_up(spark):
    got = order_totals(many_lines(spark, "9999999999999.99", 9_000)).first()
    assert got["net_sum"] == Decimal("9999999999999.99") * 9_000
    assert got["row_count"] == 9_000


def test_measures_without_lines(spark, tables):
    assert order_totals(tables["lineitem"].limit(0)).count() == 0


def test_unknown_status_is_neither_open_nor_closed(spark):
    rows = spark.createDataFrame([("F",), ("O",), (None,)], "s string")
    assert [r[0] for r in rows.select(m.is_open("s")).collect()] == [False, True, None]
