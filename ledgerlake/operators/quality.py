"""Data-quality checks that run before a table is written."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.schemas import PRIMARY_KEYS, SOURCE_TABLES, STAMP, columns

COLUMNS_MATCH = "expect_table_columns_to_match_ordered_list"
NOT_NULL = "expect_column_values_to_not_be_null"

RESULT_SCHEMA = (
    "run_ts timestamp, table string, expectation string, column string, "
    "success boolean, observed string, row_count bigint"
)


class InvalidDataError(Exception):
    """A table failed its suite; nothing was written."""


@dataclass(frozen=True)
class Suite:
    """Expected columns in order (None: unchecked) and columns that must not hold NULL."""

    column_list: tuple[str, ...] | None = None
    not_null: tuple[str, ...] = ()


def suite_from_json(text: str) -> Suite:
    """A suite from the expectation-list JSON form."""
    column_list, not_null = None, []
    for expectation in json.loads(text)["expectations"]:
        kind, arguments = expectation["expectation_type"], expectation["kwargs"]
        if kind == COLUMNS_MATCH:
            column_list = tuple(arguments["column_list"])
        elif kind == NOT_NULL:
            not_null.append(arguments["column"])
        else:
            raise ValueError(f"unknown expectation {kind}")
    return Suite(column_list, tuple(not_null))


def suites_from_folder(folder: str) -> dict[str, Suite]:
    """The suites of a folder on the driver: one ``<table>.json`` per table."""
    return {path.stem: suite_from_json(path.read_text()) for path in Path(folder).glob("*.json")}


# Each source table: its columns plus the stamp in order, and a first key column without NULLs.
SUITES: dict[str, Suite] = {
    table: Suite((*columns(table), STAMP), (PRIMARY_KEYS[table][0],)) for table in SOURCE_TABLES
}


def columns_match(df: DataFrame, expected: tuple[str, ...]) -> bool:
    return tuple(df.columns) == tuple(expected)


def _counts(names: tuple[str, ...]) -> list[Column]:
    """``row_count``, and per column its NULL count."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in names],
    ]


def not_null(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One row: ``row_count`` and per column its NULL count. One pass over those columns only."""
    return df.agg(*_counts(names))


class Watched:
    """The counts that a suite needs, taken by the job that writes a table.

    Nothing is read again. Counts of a task that ran twice are counted once, because only the
    last stage of the job counts, and it takes the first result of each task.
    """

    def __init__(self, suite: Suite | None):
        self.suite = suite
        self.names: tuple[str, ...] = ()
        self._seen: list[Observation] = []

    def watch(self, rows: DataFrame) -> DataFrame:
        """The same rows; to be written next, and once. Parts of a table are watched in turn."""
        if self.suite is None:
            return rows
        self.names = tuple(c for c in self.suite.not_null if c in rows.columns)
        self._seen.append(Observation())
        return rows.observe(self._seen[-1], *_counts(self.names))

    def counts(self, written: DataFrame) -> dict[str, int]:
        """The counts, once the rows are written; a plan that Spark knew to be empty has none."""
        seen = [part.get for part in self._seen]
        if all("row_count" in part for part in seen):
            return {name: sum(part[name] for part in seen) for name in seen[0]}
        return not_null(written, self.names).first().asDict()


def not_null_report(df: DataFrame, table: str, suite: Suite) -> DataFrame:
    """The NULL checks of one table as rows (table, column, row_count, null_count, success)."""
    counted = not_null(df, suite.not_null)
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in suite.not_null
    ]
    return counted.select("row_count", F.inline(F.array(*pairs))).select(
        F.lit(table).alias("table"),
        "column",
        "row_count",
        "null_count",
        (F.col("null_count") == 0).alias("success"),
    )


def report(df: DataFrame, table: str, suite: Suite) -> DataFrame:
    """Every expectation of the suite as a row, computed in one pass when the frame is read.

    ``observed`` is the number of columns, or the number of NULLs.
    """
    counted = not_null(df, suite.not_null)
    shape = (COLUMNS_MATCH, None, len(df.columns), columns_match(df, suite.column_list or ()))
    rows = [
        F.struct(
            F.lit(shape[0]).alias("expectation"),
            F.lit(shape[1]).cast("string").alias("column"),
            F.lit(shape[2]).cast("bigint").alias("observed"),
            F.lit(shape[3]).alias("success"),
        )
    ]
    for name in suite.not_null:
        rows.append(
            F.struct(
                F.lit(NOT_NULL).alias("expectation"),
                F.lit(name).alias("column"),
                F.col(name).alias("observed"),
                (F.col(name) == 0).alias("success"),
            )
        )
    return counted.select("row_count", F.inline(F.array(*rows))).select(
        F.lit(table).alias("table"), "expectation", "column", "success", "observed", "row_count"
    )


def _suite(table: str, suites: dict[str, Suite] | None) -> Suite | None:
    return (SUITES if suites is None else suites).get(table)


def check(
    df: DataFrame,
    table: str,
    run_ts: datetime,
    suites: dict[str, Suite] | None = None,
    watched: Watched | None = None,
) -> list[tuple]:
    """Evaluate the table's suite; rows of ``RESULT_SCHEMA``. No suite gives no rows.

    ``watched`` has counted the rows while they were written; otherwise they are read.
    """
    suite = _suite(table, suites)
    if suite is None:
        return []
    present = tuple(c for c in suite.not_null if c in df.columns)
    if watched is not None and suite.not_null:
        # a column that was added to what was written is a literal
        counts = dict.fromkeys(present, 0) | watched.counts(df)
    else:
        counts = not_null(df, present).first() if present else None
    rows = counts["row_count"] if counts else None
    results = []
    if suite.column_list is not None:
        matches = columns_match(df, suite.column_list)
        seen = ", ".join(df.columns)
        results.append((run_ts, table, COLUMNS_MATCH, None, matches, seen, rows))
    for name in suite.not_null:
        nulls = counts[name] if name in present else None
        seen = "column missing" if nulls is None else f"{nulls} nulls"
        results.append((run_ts, table, NOT_NULL, name, nulls == 0, seen, rows))
    return results


def watched(table: str, suites: dict[str, Suite] | None = None) -> Watched:
    return Watched(_suite(table, suites))


def validate(
    df: DataFrame,
    table: str,
    run_ts: datetime,
    suites: dict[str, Suite] | None = None,
    results_path: str | None = None,
    watched: Watched | None = None,
) -> None:
    """Raise ``InvalidDataError`` unless the table meets its suite.

    A check that cannot be evaluated counts as failed. With ``results_path`` the outcome is
    kept there either way.
    """
    try:
        results = check(df, table, run_ts, suites, watched)
    except Exception as error:
        raise InvalidDataError(f"{table}: checks could not run: {error}") from error
    if results_path and results:
        save_results(df.sparkSession, results, results_path)
    failed = [f"{r[2]}({r[3] or ''}): {r[5]}" for r in results if not r[4]]
    if failed:
        raise InvalidDataError(f"{table}: " + "; ".join(failed))


def save_results(spark: SparkSession, results: list[tuple], path: str) -> None:
    """Keep one row per checked expectation (a handful per table and run).

    Results lie in a folder for each run and table. Those of a repeated run replace what it left
    before, and runs or tables that are checked at the same time do not meet.
    """
    rows = spark.createDataFrame(results, RESULT_SCHEMA).coalesce(1)
    named = rows.select(
        "*", F.concat(F.lit("run-"), F.unix_micros("run_ts")).alias("run"),
        F.col("table").alias("checked"),
    )
    writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("run", "checked").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The kept results of all runs and tables."""
    return spark.read.parquet(path).drop("run", "checked")
