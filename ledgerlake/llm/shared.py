"""What several operators of this package need: words, local bindings, stored tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

#: White space as the contracts of the text operators define it (regular expression class).
SPACE = r"\x20\x09-\x0D"
#: The same characters for ``bytes.split`` and ``bytes.strip``, whose defaults they are.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def text_of(column: str | Column = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: its longest runs without white space."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once per row.

    A plain column that a lambda refers to may be inlined by the optimiser and then computed for
    every element; the variable of an enclosing lambda cannot be.
    """
    return F.transform(F.array(value), body)[0]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the folder all executors share and read it back.

    Cuts the lineage: what follows reads files that survive a lost executor. The files go when
    the application ends, because a lazy result may read them until then.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Session setting for the bytes of a batch that Spark hands to Python.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library's source to the executors, once per application.

    Tasks that run Python import it there. It goes through the folder that all of them share.
    Unless the session says otherwise, the batches sent to Python are bounded in bytes, too:
    Spark's own bound is a number of rows, and texts may be long.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(32 << 20))
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    path = f"{scratch_path(spark, 'source')}/{package.name}.zip"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(data.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)
