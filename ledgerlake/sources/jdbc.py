"""Reading source tables over JDBC, split into key ranges."""

from __future__ import annotations

import logging
import os
import random
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
R = TypeVar("R")

TARGET_PARTITION_MB = 128


@dataclass(frozen=True)
class Retry:
    """How often to try, and how long to wait: doubling from the first to the longest wait."""

    max_retries: int = 5
    initial_backoff: float = 1.0
    max_backoff: float = 30.0


@dataclass(frozen=True)
class JdbcConnection:
    """Where and how to connect."""

    url: str
    user: str | None = None
    password: str | None = None
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000
    retry: Retry = Retry()

    @classmethod
    def from_env(cls) -> JdbcConnection:
        """Connection named by ``UPS_HOST/PORT/DATABASE/USERNAME/PASSWORD``."""
        env = os.environ
        return cls(
            f"jdbc:postgresql://{env['UPS_HOST']}:{env['UPS_PORT']}/{env['UPS_DATABASE']}",
            env["UPS_USERNAME"],
            env["UPS_PASSWORD"],
        )

    def properties(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password}
        return {
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
            **{k: v for k, v in given.items() if v is not None},
        }


def with_retry(
    action: Callable[[], R], retry: Retry = Retry(), sleep: Callable[[float], None] = time.sleep
) -> R:
    """Run ``action``, waiting longer after each failure, with 20 % jitter.

    Meant for the eager calls that set a scan up. Failures while reading rows are Spark task
    failures and are retried by the scheduler.
    """
    for attempt in range(1, retry.max_retries + 1):
        try:
            return action()
        except Exception as error:
            if attempt == retry.max_retries:
                raise
            delay = retry.initial_backoff * 2 ** (attempt - 1) * random.uniform(0.8, 1.2)
            log.warning("attempt %d of %d failed: %s", attempt, retry.max_retries, error)
            sleep(min(delay, retry.max_backoff))
    raise ValueError("max_retries must be at least 1")


def plan_partitions(table_bytes: int | None, target_mb: int = TARGET_PARTITION_MB) -> int:
    """Partitions of about ``target_mb`` each; one when the size is unknown."""
    if not table_bytes:
        return 1
    return max(1, int(table_bytes / (target_mb * 1024 * 1024)))


def _one_row(spark: SparkSession, connection: JdbcConnection, select: str):
    query = f"({select}) answer"
    return with_retry(
        lambda: spark.read.jdbc(connection.url, query, properties=connection.properties()).first(),
        connection.retry,
    )


def jdbc_bounds(
    spark: SparkSession, connection: JdbcConnection, table: str, column: str
) -> tuple[int | None, int | None]:
    """Smallest and largest key, computed by the source; None for an empty table."""
    select = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = _one_row(spark, connection, select)
    return row[0], row[1]


def jdbc_row_count(spark: SparkSession, connection: JdbcConnection, table: str) -> int:
    return int(_one_row(spark, connection, f"SELECT COUNT(*) AS n FROM {table}")[0])


def _literal(value: object) -> str:
    """A key as SQL text."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def histogram_sql(table: str, column: str, ranges: int, cuts: Sequence[object] = ()) -> str:
    """Ranges of equal row counts: number, smallest key and rows of each; 0 are rows without key.

    The source sorts its keys, for which it may use their index, and sends a row per range. An
    engine of many tasks without an index takes ``cuts``, some keys in ascending order: it sorts
    the slices between them each by itself instead of all keys at once. Cuts change no result.
    """
    if cuts:
        return _sliced_histogram_sql(table, column, ranges, list(cuts))
    known = f"CASE WHEN {column} IS NULL THEN 0 ELSE 1 END"
    return (
        f"SELECT h.part, MIN(h.k) AS low, COUNT(*) AS n FROM (SELECT {column} AS k, {known}"
        f" * NTILE({ranges}) OVER (PARTITION BY {known} ORDER BY {column}) AS part"
        f" FROM {table}) h GROUP BY h.part"
    )


def _sliced_histogram_sql(table: str, column: str, ranges: int, cuts: list) -> str:
    """Keys are counted first, so that one with many rows is a row like any other.

    The rows of the slices before make a place within a slice one in the whole table.
    """
    slices = _slice_sql(column, cuts, 0)
    parts = " UNION ALL ".join(f"SELECT {i} AS part" for i in range(1, ranges + 1))
    return (
        f"WITH counted AS (SELECT slice, k, COUNT(*) AS n FROM (SELECT {column} AS k,"
        f" {slices} AS slice FROM {table}) keyed GROUP BY slice, k),"
        " sizes AS (SELECT slice, SUM(n) AS n FROM counted WHERE k IS NOT NULL GROUP BY slice),"
        " earlier AS (SELECT slice, SUM(n) OVER (ORDER BY slice) - n AS n,"
        " SUM(n) OVER () AS total FROM sizes),"
        " placed AS (SELECT c.k, c.n, e.total, e.n + SUM(c.n) OVER (PARTITION BY c.slice"
        " ORDER BY c.k) AS last FROM counted c JOIN earlier e ON c.slice = e.slice"
        " WHERE c.k IS NOT NULL),"
        # the row that begins a part: the first parts have one more where rows are left over
        " begun AS (SELECT p.part, s.total, CAST(FLOOR(s.total / "
        f"{ranges}) AS BIGINT) AS size, s.total % {ranges} AS over"
        f" FROM ({parts}) p CROSS JOIN (SELECT SUM(n) AS total FROM sizes) s),"
        " starts AS (SELECT part, (part - 1) * size"
        " + CASE WHEN part - 1 < over THEN part - 1 ELSE over END + 1 AS at,"
        " size + CASE WHEN part <= over THEN 1 ELSE 0 END AS n FROM begun)"
        " SELECT s.part, p.k AS low, s.n FROM starts s JOIN placed p"
        " ON s.at <= p.last AND s.at > p.last - p.n WHERE s.n > 0"
        " UNION ALL SELECT 0 AS part, MIN(k) AS low, SUM(n) AS n FROM counted WHERE k IS NULL"
        " HAVING COUNT(*) > 0"
    )


def _slice_sql(column: str, cuts: list, first: int) -> str:
    """The number of cuts that are at most the key, by halving them."""
    if not cuts:
        return str(first)
    middle = len(cuts) // 2
    below = _slice_sql(column, cuts[:middle], first)
    above = _slice_sql(column, cuts[middle + 1 :], first + middle + 1)
    return f"CASE WHEN {column} < {_literal(cuts[middle])} THEN {below} ELSE {above} END"


def range_predicates(column: str, histogram: list[tuple[int, object, int]]) -> list[str]:
    """Conditions, each true for the rows of one range; every row meets exactly one.

    The first and last range are open, so rows that come or change later are read, too. A key
    with more rows than a range makes one range of several. Rows without a key have their own
    range if there are any, and else join the first.
    """
    lows = sorted({low for part, low, _ in histogram if part})
    none = any(not part for part, _, _ in histogram)
    missing = f"{column} IS NULL"
    if len(lows) < 2:
        return [missing, f"{column} IS NOT NULL"] if none and lows else []
    cuts = [_literal(low) for low in lows[1:]]
    first = f"{column} < {cuts[0]}"
    found = [first if none else f"({first} OR {missing})"]
    found += [
        f"{column} >= {low} AND {column} < {high}"
        for low, high in zip(cuts, cuts[1:], strict=False)
    ]
    found.append(f"{column} >= {cuts[-1]}")
    return [missing, *found] if none else found


def jdbc_histogram(
    spark: SparkSession, connection: JdbcConnection, table: str, column: str, ranges: int
) -> list[tuple[int, object, int]]:
    query = f"({histogram_sql(table, column, ranges)}) answer"
    rows = with_retry(
        lambda: spark.read.jdbc(
            connection.url, query, properties=connection.properties()
        ).collect(),
        connection.retry,
    )
    return [(int(r[0]), r[1], int(r[2])) for r in rows]


def read_jdbc(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    row_bytes: int = 200,
    target_partition_mb: int = TARGET_PARTITION_MB,
    equal_rows: bool = False,
) -> DataFrame:
    """Scan ``table``; with a ``partition_column`` as parallel key ranges.

    Without ``num_partitions`` the count follows from the table's rows times ``row_bytes``. The
    ranges of a numeric key are of equal width, or with ``equal_rows`` have about as many rows
    each, whatever the gaps and clusters of the keys; that takes any ordered key and one more
    query. Either way rows beyond the bounds, or without a key, are read too.
    """
    how: dict[str, object] = {}
    if partition_column is not None:
        if num_partitions is None:
            table_bytes = jdbc_row_count(spark, connection, table) * row_bytes
            num_partitions = plan_partitions(table_bytes, target_partition_mb)
        if num_partitions > 1 and equal_rows:
            found = jdbc_histogram(spark, connection, table, partition_column, num_partitions)
            predicates = range_predicates(partition_column, found)
            how = {"predicates": predicates} if predicates else {}
        elif num_partitions > 1:
            low, high = jdbc_bounds(spark, connection, table, partition_column)
            if low is not None:
                how = {
                    "column": partition_column,
                    "lowerBound": int(low),
                    "upperBound": int(high),
                    "numPartitions": num_partitions,
                }
    return with_retry(
        lambda: spark.read.jdbc(connection.url, table, properties=connection.properties(), **how),
        connection.retry,
    )
