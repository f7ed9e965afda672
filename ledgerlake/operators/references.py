"""Foreign keys: which rows refer to a key that their parent table does not have.

Keys of both tables become bitmaps, one for each run of 32,768 keys, in the tasks that read them;
only bitmaps are shuffled, however often a key is repeated. A run has orphans if parent and child
together have more keys than the parent alone. Only rows of such runs meet the parent's keys in an
exact anti-join, so a clean table is checked without shuffling its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import FOREIGN_KEYS, columns

_RUN, _BITS = "_key_run", "_key_bits"


def _run(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key).cast("long"))


def key_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """The distinct keys as bitmaps; NULL is no key. They add up by ``bitmap_or_agg``."""
    position = F.bitmap_bit_position(F.col(key).cast("long"))
    known = rows.filter(F.col(key).isNotNull())
    return known.groupBy(_run(key).alias(_RUN)).agg(F.bitmap_construct_agg(position).alias(_BITS))


def runs_with_orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """The runs of keys in which the child has some that the parent lacks, and how many."""
    sides = [
        key_bitmaps(parent, key).withColumn("_parent", F.lit(True)),
        key_bitmaps(child, column).withColumn("_parent", F.lit(False)),
    ]
    own = F.bitmap_or_agg(F.when(F.col("_parent"), F.col(_BITS)))
    both = F.bitmap_count(F.bitmap_or_agg(_BITS))
    return (
        reduce(DataFrame.unionByName, sides)
        .groupBy(_RUN)
        .agg((both - F.coalesce(F.bitmap_count(own), F.lit(0))).alias("orphan_keys"))
        .filter("orphan_keys > 0")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """The child's rows whose ``column`` holds a key that the parent lacks."""
    runs = runs_with_orphans(child, column, parent, key).select(_RUN)
    suspects = child.withColumn(_RUN, _run(column)).join(runs, _RUN, "left_semi").drop(_RUN)
    keys = parent.select(F.col(key).alias("_parent_key"))
    return suspects.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def _table_of(column: str, tables: dict[str, DataFrame]) -> str:
    return next(t for t in tables if column in columns(t))


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """A row per foreign key: rows with a key, and rows and keys without a parent."""
    reports = []
    for column, (parent, key) in FOREIGN_KEYS.items():
        child = _table_of(column, tables)
        found = orphans(tables[child].select(column), column, tables[parent].select(key), key)
        counted = found.groupBy(column).agg(F.count("*").alias("n"))
        totals = counted.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
            F.count("*").alias("orphan_keys"),
        )
        rows = tables[child].agg(F.count(column).alias("keyed_rows"))
        names = [F.lit(x).alias(n) for x, n in ((child, "table"), (column, "column"))]
        one = F.lit(1)
        reports.append(
            totals.withColumn("_one", one)
            .join(F.broadcast(rows.withColumn("_one", one)), "_one")
            .select(
                *names, F.lit(parent).alias("parent"), "keyed_rows", "orphan_rows", "orphan_keys"
            )
        )
    return reduce(DataFrame.unionByName, reports)
