"""Statistics of published tables in the catalog, and plans that use them.

``analyze`` has Spark count a table's rows and, in the chosen columns, nulls, distinct values, least
and greatest values and a histogram of bins of equal row counts. Under ``used`` Spark estimates a
filter from them, and so does ``joins.fits_broadcast``: the few rows that a filter leaves of a large
table are then sent to the tasks, and many rows are shuffled, whatever a uniform spread of the values
would suggest. Publishing a table anew drops its statistics, so none are stale.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

HISTOGRAMS = {"spark.sql.statistics.histogram.enabled": "true"}
USED = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.planStats.enabled": "true"}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def analyze(spark: SparkSession, schema: str, table: str, columns: Sequence[str]) -> None:
    """Count a catalog table whole; two passes for columns that have a histogram."""
    name = f"{_quoted(schema)}.{_quoted(table)}"
    with _settings(spark, HISTOGRAMS):
        spark.sql(
            f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS "
            + ", ".join(map(_quoted, columns))
        )


def used(spark: SparkSession):
    """A context in which plans are estimated from the catalog's statistics."""
    return _settings(spark, USED)
