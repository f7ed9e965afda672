"""Reading source tables from files: ``|``-delimited text and parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.schemas import conform, empty, source_schema

_TRAILER = "_after_last_delimiter"


class TooManyRejectsError(Exception):
    """More of a file's rows could not be read than the caller allows."""


@dataclass(frozen=True)
class Loaded:
    """What a delimited file gave: readable rows, where the others are, and how many of each."""

    rows: DataFrame
    rejects: DataFrame
    row_count: int
    reject_count: int


def read_tbl(spark: SparkSession, path: str, table: str, mode: str = "FAILFAST") -> DataFrame:
    """Read generator output: ``|`` after every field, no quoting, empty field = NULL.

    A file missing from an existing folder gives an empty table; a missing folder is an error.
    An unreadable row fails the job, as a bulk load would; ``mode`` takes Spark's other CSV modes.
    """
    schema = T.StructType([*source_schema(table).fields, T.StructField(_TRAILER, T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("quote", "")
        .option("escape", "")
        .option("nullValue", "")
        .option("mode", mode)
    )
    try:
        rows = reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            raise
        return empty(spark, table)
    return conform(rows.drop(_TRAILER), table)


def _reason(fields: Column, table: str) -> Column:
    """Why a line cannot be read: its number of fields, or the first field of another type."""
    schema = source_schema(table)
    given, wanted = F.size(fields) - 1, len(schema)
    count = F.concat(given.cast("string"), F.lit(f" fields, expected {wanted}"))
    reason = F.when(given != wanted, count)
    for i, field in enumerate(schema.fields):
        text = F.get(fields, F.lit(i))
        unread = (text != "") & text.try_cast(field.dataType).isNull()
        reason = reason.when(unread, F.lit(f"{field.name} is not {field.dataType.simpleString()}"))
    return reason


def load_tbl(
    spark: SparkSession, path: str, table: str, rejects_path: str, most_rejected: float = 0.01
) -> Loaded:
    """Read delimited text and keep the lines that cannot be read apart, with file and reason.

    A field ends with ``|``; an empty one is NULL, and empty lines do not count. One pass stores
    the rejects and counts all lines; the share of rejects may be ``most_rejected`` at most.
    Every line is either a row or a reject, whichever columns are used later: unlike a CSV scan,
    which parses only those that are asked for. Rows are read when they are used.
    """
    fields = F.split("value", r"\|")
    lines = spark.read.text(path).filter("value <> ''").select(
        "value", F.col("_metadata.file_path").alias("file"), _reason(fields, table).alias("reason")
    )
    seen = Observation()
    lines.observe(seen, F.count(F.lit(1)).alias("n"), F.count("reason").alias("rejected")).filter(
        "reason IS NOT NULL"
    ).select("file", F.col("value").alias("line"), "reason").write.parquet(rejects_path)
    n, rejected = seen.get.get("n", 0), seen.get.get("rejected", 0)
    if rejected > most_rejected * n:
        raise TooManyRejectsError(
            f"{table}: {rejected} of {n} lines cannot be read; see {rejects_path}"
        )
    typed = [
        F.nullif(F.get(fields, F.lit(i)), F.lit("")).cast(field.dataType).alias(field.name)
        for i, field in enumerate(source_schema(table).fields)
    ]
    rows = lines.filter("reason IS NULL").select(*typed)
    return Loaded(conform(rows, table), spark.read.parquet(rejects_path), n, rejected)


def write_tbl(df: DataFrame, path: str) -> None:
    """Write the text form that ``read_tbl`` reads."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat(F.concat_ws("|", *fields), F.lit("|"))).write.text(path)


def read_parquet_table(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """``<directory>/<table>.parquet`` in the source schema."""
    return conform(spark.read.parquet(f"{directory.rstrip('/')}/{table}.parquet"), table)
