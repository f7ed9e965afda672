"""Centroid clustering of integer vectors; distances are sums of looked-up squares.

Components become whole numbers, ``floor(256 x)``, of which a dimension has few. So each round
tabulates the squared differences to all centroids once per dimension and occurring number, and a
vector's distances are the sums of the rows that its components select. A task tabulates what
occurs in a batch, which bounds a table by the batch, however many numbers occur in the corpus.
Only sums and sizes per cluster are shuffled, one row per task and cluster, and the driver holds
no more than the centroids. Vectors are stored once as numbers; every round reads them again.

Sums are exact: components may not leave ``LARGEST``, beyond which squared distances leave 64
bits, and a vector that does stops the job rather than wrap.

Defined results: only rows with exactly ``DIMENSIONS`` components, none null, infinite or not a
number, are vectors; others give no row. Every row is a vector, repeated rows and ids too; a null
id is hashed as empty and sorts first among equal hashes, then rows are ordered by components. Of
equally near centroids the one with the smaller number wins. Fewer vectors than centroids make as
many centroids as vectors; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import ship, stored

DIMENSIONS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: First part of what is hashed to choose the first centroids.
SALT = "2:"
#: The largest size of a component: 64 squares of differences of twice this fit in 64 bits.
LARGEST = 1 << 27
#: Vectors whose distances are held at once.
ROWS = 4096

ASSIGNED = "vec_id long, cluster int, distance long"


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id`` and ``v``, the components of the usable vectors as whole numbers."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )

    def whole(x: Column) -> Column:
        scaled = F.floor(F.lit(float(SCALE)) * x.cast("double"))
        fits = F.abs(x.cast("double")) <= F.lit(LARGEST / SCALE)
        return F.when(fits, scaled).otherwise(
            F.raise_error(F.lit(f"a component is larger than {LARGEST // SCALE}"))
        )

    return vectors.filter((F.size("embedding") == dimensions) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: whole(x).cast("int")).alias("v"),
    )


def first_centroids(vectors: DataFrame, k: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The ``k`` vectors with the least hashes of their ids."""
    key = F.concat(F.lit(SALT), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = vectors.orderBy(F.sha2(key, 256), F.col("vec_id").asc_nulls_first(), "v").limit(k)
    rows = [r["v"] for r in least.collect()]
    return np.array(rows, dtype=np.int64).reshape(len(rows), dimensions)


def occurring(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of a column and each row's place among them."""
    low, high = int(values.min()), int(values.max())
    if high - low > 4 * len(values) + 1024:
        return np.unique(values, return_inverse=True)
    there = np.zeros(high - low + 1, dtype=bool)
    there[values - low] = True
    places = np.cumsum(there) - 1
    return np.flatnonzero(there) + low, places[values - low]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the first of equals, and the squared distance."""
    total = np.zeros((len(vectors), len(centroids)), dtype=np.int64)
    row = np.empty_like(total)
    for dimension in range(vectors.shape[1]):
        values, places = occurring(vectors[:, dimension])
        table = (values[:, None] - centroids[None, :, dimension]) ** 2
        total += np.take(table, places, axis=0, out=row, mode="clip")
    chosen = total.argmin(axis=1)
    return chosen, total[np.arange(len(total)), chosen]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors, as many as are worked on at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            numbers = part.column("v").flatten().to_numpy().astype(np.int64)
            yield part.column("vec_id"), numbers.reshape(part.num_rows, -1)


def _sums(centroids: np.ndarray):
    """A task's number of vectors per cluster and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros(centroids.shape, dtype=np.int64)
        for _, vectors in _pieces(batches):
            chosen, _ = nearest(vectors, centroids)
            n += np.bincount(chosen, minlength=len(n))
            np.add.at(sums, chosen, vectors)
        met = np.flatnonzero(n)
        columns = [met.astype(np.int32), n[met], *sums[met].T]
        names = ["cluster", "n", *(f"s{i}" for i in range(sums.shape[1]))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in _pieces(batches):
            chosen, distance = nearest(vectors, centroids)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(chosen.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floors of their vectors' means; empty ones stay."""
    names = [f"s{i}" for i in range(centroids.shape[1])]
    schema = "cluster int, n long, " + ", ".join(f"{s} long" for s in names)
    found = (
        vectors.mapInArrow(_sums(centroids), schema)
        .groupBy("cluster")
        .agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names])
        .collect()
    )
    after = centroids.copy()
    for r in found:
        after[r["cluster"]] = [r[s] // r["n"] for s in names]
    return after


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and squared ``distance`` of every vector, and the centroids."""
    spark = vectors.sparkSession
    ship(spark)
    whole = stored(whole_vectors(vectors, dimensions), "whole-vectors")
    centroids = first_centroids(whole, k, dimensions)
    if not len(centroids):
        return spark.createDataFrame([], ASSIGNED), centroids
    for _ in range(rounds):
        centroids = moved(whole, centroids)
    return stored(whole.mapInArrow(_assigned(centroids), ASSIGNED), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the summed distances of the cluster and of all, and the centroid's digest.

    What is joined has one row per centroid.
    """
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()
    total = sum(r["s"] for r in sums)
    rows = [
        (
            r["cluster"],
            r["s"],
            total,
            hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest(),
        )
        for r in sums
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    told = assigned.sparkSession.createDataFrame(rows, schema)
    return assigned.join(F.broadcast(told), "cluster")
