import sys
from datetime import date, datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerlake import schemas  # noqa: E402

RUN_TS = datetime(2024, 6, 10, 7, 45, 5, 250, tzinfo=timezone.utc)
AS_OF = date(2024, 6, 10)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Set session options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def day(number: int) -> date:
    return date(2024, 5, number)


def money(value) -> Decimal:
    return Decimal(str(value)).quantize(Decimal("0.01"))


# Four customers, four orders and five lines; comments, addresses and phones are filler. Nation
# and region keys overlap, so that a lookup by the wrong key finds another region.
ROWS = {
    "region": [(10, "NORTH"), (20, "SOUTH"), (30, "EAST")],
    "nation": [(10, "ALBA", 10), (20, "BREZ", 30), (30, "CORA", 20), (40, "DUNE", 10)],
    "customer": [
        (21, 20, "FURNITURE", 150),
        (22, 10, "MACHINERY", 975),
        (23, 30, "FURNITURE", 40),
        (24, 10, "BUILDING", -12),
    ],
    "supplier": [(71, 30), (72, 10), (73, 20)],
    "part": [(501, 80, "K"), (502, 64, "M"), (503, 250, "P"), (504, 19, "R")],
    "partsupp": [(501, 71, 12, 33), (502, 72, 7, 25), (503, 73, 90, 140), (504, 71, 3, 9)],
    "orders": [(1001, 22, "O", 3, 700), (1002, 21, "F", 3, 90), (1003, 23, "P", 6, 55),
               (1004, 22, "F", 6, 310)],
    "lineitem": [
        (1001, 501, 71, 1, 4, 400, 0.05, 0.10, 5, 9, 8),
        (1001, 503, 73, 2, 2, 300, 0.00, 0.05, 6, 7, 10),
        (1002, 502, 72, 1, 3, 90, 0.10, 0.00, 4, 6, 6),
        (1003, 504, 71, 1, 1, 50, 0.20, 0.10, 9, 12, 11),
        (1004, 501, 71, 1, 2, 200, 0.25, 0.20, 8, 8, 14),
    ],
}


def full_row(table: str, row: tuple) -> tuple:
    """A source row in the full schema from the columns that matter."""
    if table == "region":
        return (*row, "note")
    if table == "nation":
        return (*row, "note")
    if table == "customer":
        key, nation, segment, balance = row
        return (key, f"Customer {key}", f"Address {key}", nation, f"phone-{key}",
                money(balance), segment, "note")
    if table == "supplier":
        key, nation = row
        return (key, f"Supplier {key}", f"Street {key}", nation, f"phone-{key}",
                money(100 * key), "note")
    if table == "part":
        key, price, letter = row
        return (key, f"Part {letter}", "Manufacturer#1", "Brand#1", "STANDARD", 5, "SM BOX",
                money(price), "note")
    if table == "partsupp":
        part, supplier, quantity, cost = row
        return (part, supplier, quantity, money(cost), "note")
    if table == "orders":
        key, customer, status, on, total = row
        ordered = None if on is None else day(on)
        return (key, customer, status, money(total), ordered, "1-URGENT", "Clerk#1", 0, "note")
    order, part, supplier, line, quantity, price, discount, tax, ship, commit, receipt = row
    days = [None if d is None else day(d) for d in (ship, commit, receipt)]
    return (order, part, supplier, line, money(quantity), money(price), money(discount),
            money(tax), "N", "O", *days, "NONE", "RAIL", "note")


def frame(spark, table: str, rows: list[tuple]):
    return spark.createDataFrame(
        [full_row(table, r) for r in rows], schemas.source_schema(table)
    )


@pytest.fixture
def tables(spark):
    return {t: frame(spark, t, rows) for t, rows in ROWS.items()}


# Edge cases the base rows lack: unknown nation, unknown status, unknown commit date, a group
# without revenue, a part with two suppliers, a part nobody supplies, an unknown customer.
EDGE = {
    "customer": [*ROWS["customer"], (25, 99, "BUILDING", 600)],
    "part": [*ROWS["part"], (505, 31, "V")],
    "partsupp": [*ROWS["partsupp"], (501, 73, 110, 11)],
    "orders": [*ROWS["orders"], (1005, 25, None, 8, 10), (1006, 21, "O", 9, 0),
               (1007, 77, "O", 8, 10), (1008, None, "F", 8, 10)],
    "lineitem": [
        *ROWS["lineitem"],
        (1005, 501, 73, 1, 1, 100, 0.0, 0.0, 13, None, 16),
        (1006, 505, 72, 1, 1, 0, 0.0, 0.0, None, 8, 12),
        (1007, 501, 71, 1, 2, 50, 0.5, 0.0, 7, 2, 7),
        (1008, 503, 73, 1, 2, 50, 0.5, 0.0, 3, 2, 3),
        (9999, 501, 71, 1, 1, 1, 0.0, 0.0, 1, 1, 1),
    ],
}


@pytest.fixture
def edge_tables(spark):
    return {t: frame(spark, t, EDGE.get(t, rows)) for t, rows in ROWS.items()}


def rows_of(df, *names):
    """Rows as sorted tuples of the named columns."""
    found = df.select(*names) if names else df
    return sorted((tuple(r) for r in found.collect()), key=repr)
