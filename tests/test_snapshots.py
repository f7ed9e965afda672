import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import RUN_TS, rows_of

from ledgerlake import schemas
from ledgerlake.plans import snapshots

SCHEMA = schemas.source_schema("region")


def micros(instant):
    return int(instant.timestamp()) * 1_000_000 + instant.microsecond


@pytest.fixture
def store(spark, tables, tmp_path):
    """A table with three daily snapshots of one, two and three rows."""
    path = str(tmp_path / "region")
    for back, rows in ((2, 1), (1, 2), (0, 3)):
        df = tables["region"].filter(f"r_regionkey <= {10 * rows}")
        snapshots.write_snapshot(df, path, RUN_TS - timedelta(days=back))
    return path


def test_stamp_is_one_literal(tables):
    got = snapshots.stamp(tables["region"], RUN_TS)
    assert got.columns == ["r_regionkey", "r_name", "r_comment", "etl_inserted"]
    assert got.select("etl_inserted").distinct().count() == 1


def test_files_are_compressed_with_zstd(store):
    files = list(Path(store).rglob("*.parquet"))
    assert files
    for file in files:
        meta = pq.ParquetFile(file).metadata
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        assert {g.column(0).compression for g in groups} <= {"ZSTD"}


def test_latest_is_the_last_written(spark, store):
    assert snapshots.latest(spark, store) == micros(RUN_TS)
    assert snapshots.read(spark, store, SCHEMA).count() == 3


def test_latest_lists_no_files_of_older_snapshots(spark, store):
    files = snapshots.read(spark, store, SCHEMA).inputFiles()
    newest = snapshots.stored_snapshots(spark, store)[micros(RUN_TS)]
    assert files and all(newest.rpartition("/")[2] in unquote_once(f) for f in files)


def unquote_once(name):
    return name.replace("%253A", "%3A").replace("%20", " ")


@pytest.fixture
def new_york(setting):
    setting("spark.sql.session.timeZone", "America/New_York")


def test_stamps_across_the_end_of_summer_time(spark, new_york, tables, tmp_path):
    """05:50 and 06:10 UTC are 01:50 and 01:10 in New York."""
    path = str(tmp_path / "region")
    first = datetime(2025, 11, 2, 5, 50, tzinfo=timezone.utc)
    second = first + timedelta(minutes=20)
    snapshots.write_snapshot(tables["region"], path, first)
    snapshots.write_snapshot(tables["region"].limit(2), path, second)
    assert snapshots.latest(spark, path) == micros(second)
    assert snapshots.read(spark, path, SCHEMA).count() == 2
    (got,) = snapshots.read(spark, path, SCHEMA).selectExpr("unix_micros(etl_inserted)").distinct().collect()
    assert got[0] == micros(second)
    assert snapshots.read(spark, path, SCHEMA, partition_values={"etl_inserted": first}).count() == 3
    assert snapshots.retain(spark, path, keep=1) == ["2025-11-02 05:50:00.000000Z"]
    assert snapshots.read(spark, path, SCHEMA).count() == 2


def test_unknown_formats_are_refused(spark, tables, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        snapshots.write_snapshot(tables["region"], str(tmp_path / "region"), RUN_TS, fmt="csv")


def test_read_by_partition(spark, store):
    older = {"etl_inserted": RUN_TS - timedelta(days=1)}
    assert snapshots.read(spark, store, SCHEMA, partition_values=older).count() == 2
    assert snapshots.read(
        spark, store, SCHEMA, partition_values={**older, "r_regionkey": 20}
    ).count() == 1


def test_partition_values_may_be_text(spark, store):
    got = snapshots.read(
        spark, store, SCHEMA, partition_values={"etl_inserted": "2024-06-09 07:45:05.00025"}
    )
    assert got.count() == 2


def test_read_history_and_columns(spark, store):
    assert snapshots.read(spark, store, SCHEMA, every_snapshot=True).count() == 6
    assert snapshots.read(spark, store, SCHEMA, columns=["r_name"]).columns == ["r_name"]


def test_stored_stamp_is_a_timestamp(spark, store):
    got = snapshots.read(spark, store, SCHEMA)
    assert got.schema["etl_inserted"].dataType.typeName() == "timestamp"
    merged = snapshots.read(spark, store, merge_schema=True)
    assert merged.schema["etl_inserted"].dataType.typeName() == "timestamp"
    assert merged.count() == 3


def test_whole_second_stamps(spark, tables, tmp_path):
    path = str(tmp_path / "region")
    instant = datetime(2024, 3, 31, 1, 30, tzinfo=timezone.utc)
    snapshots.write_snapshot(tables["region"], path, instant)
    snapshots.write_snapshot(tables["region"].limit(1), path, instant + timedelta(microseconds=5))
    assert snapshots.read(spark, path, SCHEMA).count() == 1
    assert snapshots.retain(spark, path) == ["2024-03-31 01:30:00.000000Z"]
    assert snapshots.read(spark, path, SCHEMA).count() == 1


def test_empty_snapshot_supersedes(spark, store, tables):
    later = RUN_TS + timedelta(days=1)
    snapshots.write_snapshot(tables["region"].limit(0), store, later)
    assert snapshots.latest(spark, store) == micros(later)
    assert snapshots.read(spark, store, SCHEMA).count() == 0
    snapshots.retain(spark, store)
    assert snapshots.latest(spark, store) == micros(later)


def test_retain(spark, store):
    assert len(snapshots.retain(spark, store, keep=2)) == 1
    assert snapshots.read(spark, store, SCHEMA, every_snapshot=True).count() == 5
    snapshots.retain(spark, store)
    assert rows_of(snapshots.read(spark, store, SCHEMA, every_snapshot=True), "r_regionkey") == [
        (10,), (20,), (30,)
    ]
    with pytest.raises(ValueError, match="keep"):
        snapshots.retain(spark, store, keep=0)


def test_new_columns_are_read_with_merge_schema(spark, store, tables):
    later = RUN_TS + timedelta(days=1)
    wider = tables["region"].selectExpr("*", "upper(r_name) AS r_label")
    snapshots.write_snapshot(wider, store, later)
    merged = snapshots.read(spark, store, merge_schema=True, every_snapshot=True)
    assert "r_label" in merged.columns
    assert merged.filter("r_label IS NULL").count() == 6
    assert "r_label" not in snapshots.read(spark, store, SCHEMA).columns


def data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_compact_merges_small_files(spark, tables, tmp_path):
    path = str(tmp_path / "region")
    snapshots.write_snapshot(tables["region"], path, RUN_TS - timedelta(days=1))
    before = len(data_files(path))
    snapshots.write_snapshot(tables["region"].repartition(3), path, RUN_TS)
    many = len(data_files(path))
    assert many > before + 1
    expected = rows_of(snapshots.read(spark, path, SCHEMA))
    snapshots.compact(spark, path, SCHEMA)
    assert len(data_files(path)) == before + 1
    assert rows_of(snapshots.read(spark, path, SCHEMA)) == expected
    assert snapshots.read(spark, path, SCHEMA, every_snapshot=True).count() == 6


def test_failed_write_leaves_the_table_as_it_was(spark, store, tables):
    broken = tables["region"].selectExpr(
        "r_regionkey", "CAST(assert_true(r_regionkey < 30) AS STRING) AS r_name", "r_comment"
    )
    with pytest.raises(Exception, match="is not true"):
        snapshots.write_snapshot(broken, store, RUN_TS + timedelta(days=1))
    assert snapshots.latest(spark, store) == micros(RUN_TS)
    assert snapshots.read(spark, store, SCHEMA).count() == 3


def test_orc_tables(spark, tables, tmp_path):
    path = str(tmp_path / "region")
    snapshots.write_snapshot(tables["region"], path, RUN_TS - timedelta(days=1), fmt="orc")
    snapshots.write_snapshot(tables["region"].repartition(3), path, RUN_TS, fmt="orc")
    snapshots.compact(spark, path, SCHEMA, fmt="orc")
    assert snapshots.read(spark, path, SCHEMA, fmt="orc", every_snapshot=True).count() == 6
    snapshots.write_snapshot(tables["region"].limit(0), path, RUN_TS + timedelta(days=1), fmt="orc")
    assert snapshots.read(spark, path, SCHEMA, fmt="orc").count() == 0
    snapshots.retain(spark, path)
    assert snapshots.read(spark, path, SCHEMA, fmt="orc", every_snapshot=True).count() == 0
