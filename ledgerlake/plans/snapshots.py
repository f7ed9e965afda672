"""Tables stored as time-stamped snapshots, one ``etl_inserted`` folder per run.

A folder's name spells its stamp in UTC, so it means the same instant in every session and sorts
by time. Snapshots are found by listing these folders; only the files of those that are read are
listed further.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.plans.clustering import clustered
from ledgerlake.schemas import STAMP

PARTITION_KEYS = (STAMP,)
FILE_FORMATS = ("parquet", "orc")
TABLE_FORMATS = ("delta", "iceberg", "hudi")  # these keep their own history
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_PREFIX = f"{STAMP}="
#: Bytes of a file that compaction makes, at most.
TARGET_BYTES = 128 << 20
#: How the files are compressed: they outlast the run, and every layer is kept.
CODEC = "zstd"
#: What a swap of files is about to do; readers skip names that begin like this.
_NOTE = "_swap.json"


def is_file_format(fmt: str) -> bool:
    """Whether snapshots are folders of plain files; other formats must be known ones."""
    if fmt not in (*FILE_FORMATS, *TABLE_FORMATS):
        known = ", ".join((*FILE_FORMATS, *TABLE_FORMATS))
        raise ValueError(f"tables cannot be stored as {fmt}; known formats: {known}")
    return fmt in FILE_FORMATS


def stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumn(STAMP, F.lit(run_ts).cast("timestamp"))


def stamped_schema(schema: T.StructType) -> T.StructType:
    """The stored schema: the table's columns, then the stamp."""
    fields = [f for f in schema.fields if f.name != STAMP]
    return T.StructType([*fields, T.StructField(STAMP, T.TimestampType())])


def micros(instant: datetime) -> int:
    """Microseconds since the epoch; an instant without zone is in UTC."""
    aware = instant if instant.tzinfo else instant.replace(tzinfo=timezone.utc)
    return (aware - _EPOCH) // timedelta(microseconds=1)


def _text(stamp_us: int) -> str:
    """A stamp as folders spell it."""
    instant = _EPOCH + timedelta(microseconds=stamp_us)
    return instant.strftime("%Y-%m-%d %H:%M:%S.%fZ")


def _folder(path: str, stamp_us: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{_text(stamp_us).replace(':', '%3A')}"


def _hadoop(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path as it knows it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def stored_snapshots(spark: SparkSession, path: str) -> dict[int, str]:
    """The table's snapshots, oldest first: stamp in microseconds and folder."""
    fs, table = _hadoop(spark, path)
    if not fs.exists(table):
        return {}
    found = {}
    for status in fs.listStatus(table):
        name = status.getPath().getName()
        value = unquote(name.removeprefix(_PREFIX))
        if name.startswith(_PREFIX) and value[:1].isdigit():
            found[micros(datetime.fromisoformat(value))] = status.getPath().toString()
    return dict(sorted(found.items()))


def stage(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    rebalance: bool = False,
    watch: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    cluster_by: tuple[str, ...] = (),
    more: Sequence[DataFrame] = (),
) -> str:
    """Write a table's rows beside its snapshots, where no reader looks; the staging folder.

    ``rebalance`` evens file sizes out with one more shuffle: worth it after a read with few or
    uneven tasks, not after a join or aggregation, whose partitions are sized already. ``cluster_by``
    lays them out for filters on those columns instead. ``watch`` sees the rows as they are
    written, after the last shuffle. ``more`` are further rows, each written when the ones before
    are.
    """
    folder = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        for part in (df, *more):
            rows = part.drop(STAMP)
            if cluster_by:
                rows = clustered(rows, cluster_by)
            elif rebalance:
                rows = rows.hint("rebalance")
            writer = watch(rows).write.format(fmt).option("compression", CODEC)
            writer.mode("append").save(folder)
    except Exception:
        discard(df.sparkSession, folder)
        raise
    return folder


def discard(spark: SparkSession, folder: str) -> None:
    fs, location = _hadoop(spark, folder)
    fs.delete(location, True)


def install(spark: SparkSession, staged: str, path: str, stamp_us: int) -> None:
    """Make staged files the snapshot of a stamp, in place of an older one of the same stamp."""
    fs, source = _hadoop(spark, staged)
    _, target = _hadoop(spark, _folder(path, stamp_us))
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{staged} could not be renamed to {target}")


def write_snapshot(
    df: DataFrame,
    path: str,
    run_ts: datetime,
    rebalance: bool = False,
    fmt: str = "parquet",
    cluster_by: tuple[str, ...] = (),
) -> None:
    """Store ``df`` as the snapshot of ``run_ts``; other snapshots of the table stay.

    Files are staged and renamed when all are written, so a failed run changes nothing. A table
    without rows has a snapshot, too: a file without rows.
    """
    if is_file_format(fmt):
        staged = stage(df, path, fmt, rebalance, cluster_by=cluster_by)
        install(df.sparkSession, staged, path, micros(run_ts))
        return
    rows = stamp(df.hint("rebalance") if rebalance else df, run_ts)
    writer = rows.write.format(fmt).mode("overwrite").partitionBy(*PARTITION_KEYS)
    writer.option("mergeSchema", "true").save(path)


def _load(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    fmt: str,
    merge_schema: bool,
    folders: list[str] | None = None,
) -> DataFrame:
    """The rows of a table, or of some of its snapshots' folders."""
    reader = spark.read.format(fmt)
    if not is_file_format(fmt):
        return reader.load(path)
    reader = reader.option("basePath", path)
    if merge_schema or schema is None:
        # inferred partition values come back as text
        rows = reader.option("mergeSchema", "true").load(folders or path)
        return rows.withColumn(STAMP, F.col(STAMP).cast("timestamp"))
    stored = stamped_schema(schema)
    if folders == []:
        return spark.createDataFrame([], stored)
    return reader.schema(stored).load(folders or path)


def latest(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """Stamp of the newest snapshot in microseconds since the epoch."""
    if is_file_format(fmt):
        return max(stored_snapshots(spark, path), default=None)
    rows = spark.read.format(fmt).load(path)
    return rows.agg(F.unix_micros(F.max(STAMP)).alias("us")).first()["us"]


def _at(stamp_us: int) -> Column:
    return F.col(STAMP) == F.timestamp_micros(F.lit(stamp_us))


def _asked(spark: SparkSession, value: object) -> int:
    """A stamp as a caller gives it: an instant, or text in the session's time zone."""
    if isinstance(value, datetime):
        return micros(value)
    return spark.range(1).select(F.unix_micros(F.lit(value).cast("timestamp"))).first()[0]


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    partition_values: dict[str, object] | None = None,
    columns: list[Column | str] | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
    every_snapshot: bool = False,
) -> DataFrame:
    """Read the newest snapshot, the named partitions, or with ``every_snapshot`` the history.

    Only the files of the snapshots wanted are listed. ``merge_schema`` takes the union of all
    files' columns instead of ``schema``.
    """
    values = dict(partition_values or {})
    if is_file_format(fmt):
        stored = stored_snapshots(spark, path)
        if STAMP in values:
            asked = _asked(spark, values.pop(STAMP))
            folders = [stored[asked]] if asked in stored else []
        elif values or every_snapshot or not stored:
            folders = list(stored.values())
        else:
            folders = [stored[max(stored)]]
        for folder in folders:
            finish_swap(spark, folder)
        rows = _load(spark, path, schema, fmt, merge_schema, folders)
    else:
        rows = _load(spark, path, schema, fmt, merge_schema)
        if not values and not every_snapshot:
            newest = latest(spark, path, fmt)
            rows = rows.filter(F.lit(False) if newest is None else _at(newest))
    if values:
        rows = rows.filter(reduce(and_, (F.col(k) == F.lit(v) for k, v in values.items())))
    return rows.select(*columns) if columns else rows


def _data_files(spark: SparkSession, folder: str) -> dict[str, int]:
    """The files of a snapshot by name, and their bytes."""
    fs, location = _hadoop(spark, folder)
    found = {f.getPath().getName(): f.getLen() for f in fs.listStatus(location)}
    return {name: size for name, size in found.items() if name[0] not in "_."}


def newest_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a table's newest snapshot."""
    stored = stored_snapshots(spark, path)
    return sum(_data_files(spark, stored[max(stored)]).values()) if stored else 0


def bins_of_small_files(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Files of less than half the target, in groups of at most the target (first fit, large first).

    A file that finds no company stays as it is, and so do all larger ones.
    """
    bins: list[tuple[int, list[str]]] = []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        if 2 * sizes[name] >= target:
            continue
        for i, (filled, names) in enumerate(bins):
            if filled + sizes[name] <= target:
                bins[i] = (filled + sizes[name], [*names, name])
                break
        else:
            bins.append((sizes[name], [name]))
    return [names for _, names in bins if len(names) > 1]


def _merge(
    spark: SparkSession, path: str, folder: str, bins: list[list[str]], rows_of, fmt: str
) -> str:
    """One file for each bin, written where no reader looks."""
    names = [(name, i) for i, own in enumerate(bins) for name in own]
    numbers = spark.createDataFrame(names, "_file string, _bin int")
    small = rows_of([f"{folder}/{name}" for name, _ in names])
    rows = small.withColumn("_file", F.col("_metadata.file_name")).join(
        F.broadcast(numbers), "_file"  # a row per small file of one snapshot
    )
    merged = rows.repartitionById(len(bins), "_bin").drop("_file", "_bin", STAMP)
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        merged.write.format(fmt).option("compression", CODEC).save(staged)
    except Exception:
        discard(spark, staged)
        raise
    return staged


def _swap_files(spark: SparkSession, folder: str, staged: str, old: list[str]) -> None:
    """Put staged files in the place of old ones: noted first, so that it can be finished later."""
    note = {"staged": staged, "add": sorted(_data_files(spark, staged)), "drop": old}
    fs, at = _hadoop(spark, f"{staged}/{_NOTE}")
    out = fs.create(at)
    out.write(json.dumps(note).encode())
    out.close()
    _, noted = _hadoop(spark, f"{folder}/{_NOTE}")
    if not fs.rename(at, noted):
        raise OSError(f"{folder}: its merged files could not be noted")
    finish_swap(spark, folder)


def finish_swap(spark: SparkSession, folder: str) -> None:
    """Finish a swap of files that was noted but interrupted; readers do so before they list."""
    fs, noted = _hadoop(spark, f"{folder}/{_NOTE}")
    if not fs.exists(noted):
        return
    stream = fs.open(noted)
    note = json.loads(bytes(stream.readAllBytes()))
    stream.close()
    for name in note["drop"]:
        discard(spark, f"{folder}/{name}")
    for name in note["add"]:
        _, source = _hadoop(spark, f"{note['staged']}/{name}")
        _, target = _hadoop(spark, f"{folder}/{name}")
        if fs.exists(source) and not fs.rename(source, target):
            raise OSError(f"{source} could not be renamed to {target}")
    fs.delete(noted, False)
    discard(spark, note["staged"])


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    stamp_us: int | None = None,
    fmt: str = "parquet",
    target_bytes: int = TARGET_BYTES,
) -> None:
    """Merge the small files of one snapshot (the newest by default); large ones are not touched.

    Files under half of ``target_bytes`` are grouped into bins of that size, and each bin becomes
    one file, staged while the old ones are read. Until all are written nothing changes; the
    swap is noted before it begins and finished by the next reader if it is interrupted. A table
    format compacts itself.
    """
    if not is_file_format(fmt):
        spark.sql(f"OPTIMIZE {fmt}.`{path}`")
        return
    stored = stored_snapshots(spark, path)
    stamp_us = max(stored, default=None) if stamp_us is None else stamp_us
    if stamp_us not in stored:
        return
    folder = stored[stamp_us]
    finish_swap(spark, folder)
    bins = bins_of_small_files(_data_files(spark, folder), target_bytes)
    if bins:
        staged = _merge(
            spark, path, folder, bins, lambda f: _load(spark, path, schema, fmt, False, f), fmt
        )
        _swap_files(spark, folder, staged, [name for own in bins for name in own])


def retain(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete all but the ``keep`` newest snapshots of a file table; returns their stamps."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    stored = stored_snapshots(spark, path)
    dropped = sorted(stored, reverse=True)[keep:]
    for stamp_us in dropped:
        discard(spark, stored[stamp_us])
    return [_text(stamp_us) for stamp_us in dropped]
