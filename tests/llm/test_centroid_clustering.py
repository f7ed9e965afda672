import hashlib
import math

import numpy as np
import pytest

from ledgerlake.llm import centroid_clustering as clustering

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k, rounds, dimensions):
    """Lists and loops only: (id, cluster, distance), sorted, and the centroids."""
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == dimensions and all(
            c is not None and math.isfinite(c) for c in x
        ):
            kept.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in x]))

    def key(row):
        text = f"2:{'' if row[0] is None else row[0]}"
        digest = hashlib.sha256(text.encode()).hexdigest()
        return digest, row[0] is not None, row[0] or 0, row[1]

    centres = [v for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        ds = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centres]
        return ds.index(min(ds)), min(ds)

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[0], []).append(v)
        for c, vs in own.items():
            centres[c] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    found = sorted(((i, *near(v)) for i, v in kept), key=repr)
    return found, centres


def run(spark, rows, k=5, rounds=3, dimensions=4, extra=""):
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).repartition(3)
    for name in extra.split():
        df = df.selectExpr("*", f"'x' AS {name}")
    assigned, centres = clustering.cluster(df, k, rounds, dimensions)
    return sorted((tuple(r) for r in assigned.collect()), key=repr), centres.tolist()


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]  # a large group of copies
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, [0.0] * 4)]
    bad = [None, [], [1.0] * 3, [1.0] * 5, [1.0, None, 1.0, 1.0],
           [float("nan"), 0.0, 0.0, 0.0], [0.0, float("inf"), 0.0, 0.0]]
    return rows + [(1000 + i, x) for i, x in enumerate(bad)]


def test_equals_plain(spark, vectors):
    assert run(spark, vectors) == plain(vectors, 5, 3, 4)


def test_fewer_vectors_than_centroids_and_ties(spark):
    rows = [(1, [1.0] * 4), (2, [1.0] * 4), (3, [-1.0] * 4)]
    assert run(spark, rows) == plain(rows, 5, 3, 4)


def test_clashing_columns(spark, vectors):
    some = vectors[:40]
    assert run(spark, some, extra="v cluster distance n s0")[0] == plain(some, 5, 3, 4)[0]


def test_empty(spark):
    assigned, centres = clustering.cluster(spark.createDataFrame([], SCHEMA))
    assert clustering.with_inertia(assigned, centres).collect() == []


def test_wide_numbers(spark):
    """Few rows over a wide range, and a component whose squares would wrap."""
    rows = [(i, [float(i) * 5000, -float(i), 0.5, 0.25]) for i in range(50)]
    assert run(spark, rows) == plain(rows, 5, 3, 4)
    with pytest.raises(Exception, match="component is larger"):
        run(spark, [*rows, (99, [1e30, 0.0, 0.0, 0.0])])


def test_inertia(spark, vectors):
    df = spark.createDataFrame([(i, x, 0) for i, x in vectors], SCHEMA)
    assigned, centres = clustering.cluster(df, 5, 3, 4)
    found = clustering.with_inertia(assigned, centres).collect()
    assert {r.inertia for r in found} == {sum(r.distance for r in found)}
    for r in found:
        assert r.cluster_inertia == sum(x.distance for x in found if x.cluster == r.cluster)
        joined = ",".join(map(str, centres[r.cluster])).encode()
        assert r.centroid_sha256 == hashlib.sha256(joined).hexdigest()


@pytest.mark.parametrize("spread", [3, 10**6])
def test_tables_give_exact_distances(spread):
    rng = np.random.default_rng(spread)
    vectors = rng.integers(-spread, spread, size=(500, 7))
    centroids = rng.integers(-spread, spread, size=(9, 7))
    direct = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    chosen, distance = clustering.nearest(vectors, centroids)
    assert (chosen == direct.argmin(axis=1)).all() and (distance == direct.min(axis=1)).all()
