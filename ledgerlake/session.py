"""Session settings for a cluster run, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The block-skew factor makes shuffles of more than 2,000 partitions report the true size of
# outlier blocks; without it adaptive execution sees averages and cannot spot a hot partition.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.shuffle.accurateBlockSkewedFactor": "5",
}


_MB, _GB = 1024**2, 1024**3


def sized_for(input_bytes: int, scan_mb: int = 256) -> dict[str, str]:
    """Partition settings for a run over that much input.

    Shuffles start with one partition per GB, which adaptive execution merges where less data
    arrives. Scans take ``scan_mb`` per task; more of it means fewer shuffle blocks.
    """
    partitions = max(200, -(-input_bytes // _GB))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{scan_mb * _MB}b",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{256 * _MB}b",
    }


def build_session(
    app: str = "ledgerlake", settings: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Session setting that drops a query's shuffle files when the query ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, shuffle files go with the query that wrote them, not when the driver collects.

    For jobs whose frames run once, such as those that store a table.
    """
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder the cluster names in ``spark.checkpoint.dir``.

    What is stored there is removed when the application ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerlake-")
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    drop_at_exit(spark, path)
    return path


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Let the file system remove a path when the application ends."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
