from pathlib import Path

import pytest
from conftest import RUN_TS, rows_of
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.plans import snapshots

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
TARGET = 60_000


def files(path):
    return {f.name: f.stat().st_size for f in Path(path).rglob("*.parquet")}


@pytest.fixture
def mixed(spark, tmp_path):
    """A snapshot of one large file and twelve small ones."""
    path = str(tmp_path / "t")
    rows = spark.range(9000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    part = F.when(F.col("k") < 6000, 0).otherwise(1 + F.col("k") % 12).cast("int")
    snapshots.write_snapshot(rows.repartitionById(13, part), path, RUN_TS)
    return path


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=4), st.integers(0, 120), max_size=30))
def test_bins(sizes):
    bins = snapshots.bins_of_small_files(sizes, 100)
    named = [n for own in bins for n in own]
    assert len(named) == len(set(named))
    assert all(sizes[n] < 50 for n in named)
    assert all(len(own) > 1 and sum(sizes[n] for n in own) <= 100 for own in bins)
    left = [n for n in sizes if sizes[n] < 50 and n not in named]
    assert len(left) <= 1


def test_only_small_files_are_rewritten(spark, mixed):
    before, rows = files(mixed), rows_of(snapshots.read(spark, mixed, SCHEMA))
    large = {n for n, size in before.items() if 2 * size >= TARGET}
    assert len(large) == 1 and len(before) == 13
    snapshots.compact(spark, mixed, SCHEMA, target_bytes=TARGET)
    after = files(mixed)
    assert large < set(after) and not (set(after) - large) & set(before)
    bins = snapshots.bins_of_small_files(before, TARGET)
    assert len(after) == 1 + len(bins) < len(before)
    assert rows_of(snapshots.read(spark, mixed, SCHEMA)) == rows
    snapshots.compact(spark, mixed, SCHEMA, target_bytes=TARGET)  # large enough now
    assert large < set(files(mixed)) and rows_of(snapshots.read(spark, mixed, SCHEMA)) == rows


def test_one_small_file_rewrites_nothing(spark, mixed):
    before = files(mixed)
    snapshots.compact(spark, mixed, SCHEMA, target_bytes=2 * min(before.values()))
    assert files(mixed) == before


def test_interrupted_before_the_swap(spark, mixed, monkeypatch):
    before, rows = files(mixed), rows_of(snapshots.read(spark, mixed, SCHEMA))

    def lost(*args):
        raise OSError("lost")

    monkeypatch.setattr(snapshots, "_swap_files", lost)
    with pytest.raises(OSError, match="lost"):
        snapshots.compact(spark, mixed, SCHEMA, target_bytes=TARGET)
    assert before.items() <= files(mixed).items()
    assert rows_of(snapshots.read(spark, mixed, SCHEMA)) == rows


@pytest.mark.parametrize("steps", [0, 1, 5])
def test_interrupted_within_the_swap(spark, mixed, monkeypatch, steps):
    """However far it came, the next reader finishes it."""
    rows, discard, left = rows_of(snapshots.read(spark, mixed, SCHEMA)), snapshots.discard, [steps]

    def lost(session, folder):
        if left[0] == 0:
            raise OSError("lost")
        left[0] -= 1
        discard(session, folder)

    monkeypatch.setattr(snapshots, "discard", lost)
    with pytest.raises(OSError, match="lost"):
        snapshots.compact(spark, mixed, SCHEMA, target_bytes=TARGET)
    monkeypatch.setattr(snapshots, "discard", discard)
    assert rows_of(snapshots.read(spark, mixed, SCHEMA)) == rows
    assert len(files(mixed)) < 13 and not list(Path(mixed).rglob("_swap.json"))


def test_failed_merge_leaves_all(spark, mixed, monkeypatch):
    before = files(mixed)
    wrong = T.StructType([T.StructField("k", T.DateType())])
    with pytest.raises(Exception, match="(?i)parquet|convert|expected"):
        snapshots.compact(spark, mixed, wrong, target_bytes=TARGET)
    assert files(mixed) == before
