from types import SimpleNamespace

import pytest

from ledgerlake.session import scratch_path, sized_for

TB = 1024**4


@pytest.mark.parametrize(
    ("size", "partitions"),
    [(0, 200), (300 * 1024**3 + 1, 301), (20 * TB, 20_480), (1000 * TB, 1_024_000)],
)
def test_partitions_follow_the_input(size, partitions):
    assert sized_for(size)["spark.sql.shuffle.partitions"] == str(partitions)
    assert sized_for(size, 512)["spark.sql.files.maxPartitionBytes"] == f"{512 * 1024**2}b"


def test_settings_are_accepted(spark, setting):
    for key, value in sized_for(TB).items():
        setting(key, value)
    assert spark.range(10).groupBy("id").count().count() == 10


def session(master, folder):
    """A session stub: the shared folder is fixed when a real one starts."""
    conf = SimpleNamespace(get=lambda key, default: folder if "checkpoint" in key else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


@pytest.fixture(autouse=True)
def dropped(monkeypatch):
    """Paths that go when the application ends."""
    paths = []
    monkeypatch.setattr("ledgerlake.session.drop_at_exit", lambda _, path: paths.append(path))
    return paths


def test_scratch_is_in_the_shared_folder(dropped):
    cluster = session("spark://cluster:7077", "s3a://bucket/shared/")
    first, second = scratch_path(cluster, "orders"), scratch_path(cluster, "orders")
    assert first.startswith("s3a://bucket/shared/orders-")
    assert first != second
    assert dropped == [first, second]


def test_scratch_without_a_shared_folder():
    assert "ledgerlake-" in scratch_path(session("local[2]", None), "orders")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session("spark://cluster:7077", None), "orders")
