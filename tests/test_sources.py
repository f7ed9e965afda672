from datetime import date, datetime, timedelta

import duckdb
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from ledgerlake import schemas
from ledgerlake.sources import files, jdbc


class FakeReader:
    """Stands in for ``spark.read``: answers metadata queries, records the scan."""

    def __init__(self, low=1, high=1000, rows=10_000_000, failures=0):
        self.answers = {"MIN": (low, high), "COUNT": (rows,)}
        self.failures = failures
        self.queries, self.scan = [], None

    @property
    def read(self):
        return self

    def jdbc(self, url, table, properties, **ranges):
        if self.failures:
            self.failures -= 1
            raise ConnectionError("not reachable")
        self.queries.append(table)
        self.scan = (url, table, properties, ranges)
        return self

    def first(self):
        kind = "MIN" if "MIN" in self.queries[-1] else "COUNT"
        return self.answers[kind]


CONNECTION = jdbc.JdbcConnection("jdbc:postgresql://db:5432/shop", "reader", "secret")


def test_connection_from_environment(monkeypatch):
    for name, value in {"HOST": "db", "PORT": "5432", "DATABASE": "shop", "USERNAME": "reader",
                        "PASSWORD": "secret"}.items():
        monkeypatch.setenv(f"UPS_{name}", value)
    assert jdbc.JdbcConnection.from_env() == CONNECTION
    assert CONNECTION.properties() == {
        "driver": "org.postgresql.Driver",
        "fetchsize": "10000",
        "user": "reader",
        "password": "secret",
    }


def test_unsplit_scan():
    reader = FakeReader()
    jdbc.read_jdbc(reader, CONNECTION, "public.nation")
    assert reader.queries == ["public.nation"]
    assert reader.scan[3] == {}


def test_split_scan_with_given_count():
    reader = FakeReader()
    jdbc.read_jdbc(reader, CONNECTION, "public.orders", "o_orderkey", num_partitions=4)
    assert reader.queries == [
        "(SELECT MIN(o_orderkey) AS lo, MAX(o_orderkey) AS hi FROM public.orders) answer",
        "public.orders",
    ]
    assert reader.scan[3] == {
        "column": "o_orderkey", "lowerBound": 1, "upperBound": 1000, "numPartitions": 4
    }


def test_split_scan_counts_rows():
    reader = FakeReader(rows=10_000_000)
    jdbc.read_jdbc(reader, CONNECTION, "public.orders", "o_orderkey", row_bytes=200)
    assert reader.scan[3]["numPartitions"] == 14  # 2 GB in parts of 128 MB


def test_empty_or_small_tables_are_one_task():
    for reader in (FakeReader(None, None), FakeReader(rows=10)):
        jdbc.read_jdbc(reader, CONNECTION, "public.orders", "o_orderkey")
        assert reader.scan[3] == {}


def test_plan_partitions():
    mb = 1024 * 1024
    sizes = [None, 0, 1, 128 * mb, 300 * mb, 12_800 * mb]
    assert [jdbc.plan_partitions(b) for b in sizes] == [1, 1, 1, 1, 2, 100]
    assert jdbc.plan_partitions(300 * mb, target_mb=10) == 30


def test_retry_waits_longer_each_time():
    waits = []
    reader = FakeReader(failures=4)
    got = jdbc.with_retry(
        lambda: reader.jdbc("url", "t", {}), jdbc.Retry(5, 1, 3), sleep=waits.append
    )
    assert got is reader
    for wait, base in zip(waits, (1, 2, 4, 8), strict=True):
        assert min(base * 0.8, 3) <= wait <= min(base * 1.2, 3)


def test_retry_gives_up():
    calls, waits = [], []

    def fail():
        calls.append(1)
        raise ConnectionError("not reachable")

    with pytest.raises(ConnectionError):
        jdbc.with_retry(fail, jdbc.Retry(max_retries=3), sleep=waits.append)
    assert (len(calls), len(waits)) == (3, 2)


@pytest.mark.parametrize("table", schemas.SOURCE_TABLES)
def test_tbl_round_trip(spark, edge_tables, tmp_path, table):
    path = str(tmp_path / f"{table}.tbl")
    files.write_tbl(edge_tables[table], path)
    got = files.read_tbl(spark, path, table)
    assert got.schema == edge_tables[table].schema
    assert rows_of(got) == rows_of(edge_tables[table])


def test_tbl_text(spark, tmp_path):
    path = tmp_path / "region.tbl"
    path.write_text('0|AFRICA   |a "quoted" note|\n1|AMERICA||\n')
    got = rows_of(files.read_tbl(spark, str(path), "region"))
    assert got == [(0, "AFRICA", 'a "quoted" note'), (1, "AMERICA", None)]


def test_missing_tbl_is_an_empty_table(spark, tmp_path):
    got = files.read_tbl(spark, str(tmp_path / "none.tbl"), "orders")
    assert got.columns == schemas.columns("orders")
    assert got.count() == 0


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_tbl(spark, str(tmp_path / "mistyped" / "orders.tbl"), "orders")


def test_unreadable_tbl_fails(spark, tmp_path):
    path = tmp_path / "region.tbl"
    path.write_text("zero|AFRICA|note|\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        files.read_tbl(spark, str(path), "region").collect()


def test_parquet_tables_are_conformed(spark, tables, tmp_path):
    as_stored = tables["orders"].select(
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"),
        F.rpad("o_clerk", 15, " ").alias("o_clerk"),
        *[c for c in tables["orders"].columns if c not in ("o_totalprice", "o_orderdate", "o_clerk")],
    )
    as_stored.write.parquet(str(tmp_path / "orders.parquet"))
    got = files.read_parquet_table(spark, str(tmp_path), "orders")
    assert got.schema == tables["orders"].schema
    assert rows_of(got) == rows_of(tables["orders"])


class SourceDatabase(FakeReader):
    """Answers the pushed-down queries over a table of keys, in this process."""

    def __init__(self, keys, kind="BIGINT"):
        super().__init__()
        self.db = duckdb.connect()
        self.db.execute(f"CREATE TABLE t (k {kind})")
        if keys:
            self.db.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])

    def collect(self):
        return self.db.execute(f"SELECT * FROM {self.queries[-1]}").fetchall()

    def rows_per_range(self):
        predicates = self.scan[3].get("predicates", ["TRUE"])
        sums = [f"count(*) FILTER (WHERE {p})" for p in predicates]
        meets = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in predicates)
        counts = self.db.execute(f"SELECT {', '.join(sums)} FROM t").fetchone()
        assert self.db.execute(f"SELECT count(*) FROM t WHERE {meets} <> 1").fetchone() == (0,)
        return counts


def split(keys, ranges, kind="BIGINT"):
    reader = SourceDatabase(keys, kind)
    jdbc.read_jdbc(reader, CONNECTION, "t", "k", num_partitions=ranges, equal_rows=True)
    return reader


def test_clustered_keys_are_split_by_rows():
    keys = [*range(1000), *range(10**9, 10**9 + 3000), 10**12, -(10**15)]
    reader = split(keys, 8)
    counts = reader.rows_per_range()
    assert len(counts) == 8 and max(counts) <= 2 * len(keys) / 8
    assert len(reader.queries) == 2  # the histogram and the scan
    wide = [0] * 8  # what equal widths would have done
    width = (10**12 + 10**15) / 8
    for k in keys:
        wide[min(7, int((k + 10**15) // width))] += 1
    assert max(wide) > 0.9 * len(keys)


def test_repeated_and_missing_keys():
    keys = [5] * 400 + list(range(400)) + [None] * 100
    counts = split(keys, 8).rows_per_range()
    assert sum(counts) == len(keys) and counts[0] == 100


def test_other_kinds_of_keys():
    days = [date(2024, 1, 1) + timedelta(days=i % 300) for i in range(1000)]
    assert max(split(days, 5, "DATE").rows_per_range()) <= 400
    names = [f"it's {i:04d}" for i in range(100)]
    assert split(names, 4, "VARCHAR").rows_per_range() == (25, 25, 25, 25)
    moments = [datetime(2024, 1, 1) + timedelta(seconds=7 * i) for i in range(90)]
    assert split(moments, 3, "TIMESTAMP").rows_per_range() == (30, 30, 30)


@pytest.mark.parametrize("ranges", [1, 4, 7])
@pytest.mark.parametrize("cuts", [[5], [-9, 5, 6, 300, 301, 10**9]])
@pytest.mark.parametrize(
    "keys", [[], [None] * 5, [3], [3, None], [5] * 400 + list(range(400)) + [None] * 100]
)
def test_slices_change_no_histogram(spark, keys, cuts, ranges):
    db = duckdb.connect()
    db.execute("CREATE TABLE t (k BIGINT)")
    if keys:
        db.executemany("INSERT INTO t VALUES (?)", [(k,) for k in keys])
    spark.createDataFrame([(k,) for k in keys], "k long").createOrReplaceTempView("sliced_keys")
    whole = sorted(db.execute(jdbc.histogram_sql("t", "k", ranges)).fetchall())
    sliced = jdbc.histogram_sql("t", "k", ranges, cuts)
    assert sorted(db.execute(sliced).fetchall()) == whole
    sliced = jdbc.histogram_sql("sliced_keys", "k", ranges, cuts)
    assert sorted(map(tuple, spark.sql(sliced).collect())) == whole


def test_slices_are_sorted_by_many_tasks(spark):
    spark.range(10).withColumnRenamed("id", "k").createOrReplaceTempView("sliced_keys")
    found = spark.sql(jdbc.histogram_sql("sliced_keys", "k", 4, [3, 6]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ntile" not in plan.lower() and "hashpartitioning(slice" in plan


@pytest.mark.parametrize("keys", [[], [None] * 5, [3] * 50, [3], [3, None]])
def test_tables_without_ranges(keys):
    assert sum(split(keys, 4).rows_per_range()) == len(keys)


def test_rows_that_come_later_are_read():
    reader = split(range(100), 4)
    reader.db.execute("INSERT INTO t VALUES (-50), (1000), (NULL)")
    assert sum(reader.rows_per_range()) == 103


@pytest.mark.parametrize("table", ["region", "orders", "lineitem"])
def test_clean_text_has_no_rejects(spark, edge_tables, tmp_path, table):
    files.write_tbl(edge_tables[table], f"{tmp_path}/t.tbl")
    loaded = files.load_tbl(spark, f"{tmp_path}/t.tbl", table, f"{tmp_path}/rejects", 0.0)
    assert rows_of(loaded.rows) == rows_of(files.read_tbl(spark, f"{tmp_path}/t.tbl", table))
    assert (loaded.row_count, loaded.reject_count) == (edge_tables[table].count(), 0)
    assert loaded.rejects.columns == ["file", "line", "reason"]


BAD = ["2|", "x|B|d|", "3|C|e", "4|D|f|g|", "99999999999|E|h|", "|F||"]


def test_bad_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "region.tbl"
    folder.mkdir()
    (folder / "a").write_text("\n".join(["1|A|c|", "", *BAD]) + "\n")
    (folder / "b").write_text("5|G|i|\n5|G|i|\n")
    loaded = files.load_tbl(spark, str(folder), "region", f"{tmp_path}/rejects", 0.9)
    assert sorted(rows_of(loaded.rows.select("r_regionkey")), key=repr) == sorted(
        [(1,), (None,), (5,), (5,)], key=repr
    )
    found = {r.line: (r.file.endswith("/a"), r.reason) for r in loaded.rejects.collect()}
    assert found == {
        "2|": (True, "1 fields, expected 3"),
        "x|B|d|": (True, "r_regionkey is not int"),
        "3|C|e": (True, "2 fields, expected 3"),
        "4|D|f|g|": (True, "4 fields, expected 3"),
        "99999999999|E|h|": (True, "r_regionkey is not int"),
    }
    assert loaded.row_count == 9 and loaded.reject_count == 5
    # whichever columns are used, the same lines are rows
    assert loaded.rows.select("r_name").count() == loaded.rows.count() == 4


def test_too_many_rejects(spark, tmp_path):
    (tmp_path / "r.tbl").write_text("1|A|c|\n2|\n")
    with pytest.raises(files.TooManyRejectsError, match="1 of 2"):
        files.load_tbl(spark, f"{tmp_path}/r.tbl", "region", f"{tmp_path}/rejects", 0.4)
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 1


def test_no_lines(spark, tmp_path):
    (tmp_path / "r.tbl").write_text("")
    loaded = files.load_tbl(spark, f"{tmp_path}/r.tbl", "region", f"{tmp_path}/rejects")
    assert (loaded.rows.count(), loaded.row_count, loaded.rejects.count()) == (0, 0, 0)
