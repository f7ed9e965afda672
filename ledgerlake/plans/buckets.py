"""Source tables kept in buckets of the order key, so that repeated runs join without a shuffle.

Orders and lines are dealt into buckets once, by the hash that joins use, one sorted file for each
bucket. The catalog holds the number of buckets and the key. Every later run that joins or groups
by the order key then reads matching buckets in one task, whatever is asked of them. Numbers of
buckets are powers of two: tables stored with different numbers still join right, and Spark
shuffles or merges the buckets of one side.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: The column each table is dealt by.
ORDER_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "fct_orders": "order_key"}
#: Bytes of a bucket to aim for.
BUCKET_BYTES = 256 << 20


def number_for(input_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The power of two that leaves at most ``bucket_bytes`` in a bucket on average."""
    return 1 << max(0, -(-input_bytes // bucket_bytes) - 1).bit_length()


def number_of(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 1) -> int:
    """The number of buckets for a table's rows, from their count and their width by its schema.

    Files say too little: rows grow several times over when a task sorts them.
    """
    width = df._jdf.schema().defaultSize()
    return max(least, number_for(df.count() * width, bucket_bytes))


def _name(schema: str, table: str) -> str:
    return f"`{schema}`.`{table}`"


def spec_of(spark: SparkSession, schema: str, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets and their columns, as the catalog has them; none if not in buckets."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(schema, table)}").collect()
    found = {row["col_name"]: row["data_type"] for row in described}
    if "Num Buckets" not in found:
        return None
    columns = [c.strip(" `") for c in found["Bucket Columns"].strip("[]").split(",")]
    return int(found["Num Buckets"]), columns


def store(
    df: DataFrame, schema: str, table: str, path: str, n_buckets: int, key: str | None = None
) -> None:
    """Keep ``df`` as the catalog's table, in buckets of ``key``, in a new folder under ``path``.

    The new files are whole before the older table's name goes to them; a write that fails
    leaves the older table. Its files stay, since readers may be at work on them.
    """
    spark, key = df.sparkSession, key or ORDER_KEYS[table]
    version = uuid.uuid4().hex
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    unfinished = f"{table}_{version}"
    dealt = df.repartition(n_buckets, key)  # one task and so one file for each bucket
    writer = dealt.write.format("parquet").bucketBy(n_buckets, key).sortBy(key)
    try:
        writer.option("path", f"{path.rstrip('/')}/{version}").saveAsTable(
            _name(schema, unfinished)
        )
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {_name(schema, unfinished)}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {_name(schema, table)}")
    spark.sql(f"ALTER TABLE {_name(schema, unfinished)} RENAME TO {_name(schema, table)}")


def source(
    spark: SparkSession, schema: str, other: Callable[[str], DataFrame]
) -> Callable[[str], DataFrame]:
    """A source of tables: those kept in buckets from the catalog, the rest from ``other``."""

    def read(table: str) -> DataFrame:
        kept = spark.catalog.tableExists(f"{schema}.{table}")
        return spark.table(_name(schema, table)) if kept else other(table)

    return read
