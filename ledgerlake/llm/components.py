"""Connected components of a graph given by its edges, by alternating star operations.

Large stars link the larger neighbours of a node to its smallest one, small stars the smaller
neighbours. Both keep components as they are; repeated, they leave each node linked to the
smallest one of its component (Kiveris et al., "Connected Components in MapReduce and Beyond",
2014). Nothing is gathered on the driver but two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import stored


def _linked_to_least(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Edges from neighbours (and the node itself) to the least node of each neighbourhood.

    ``pairs`` are (u, v). The least nodes are stored, so that the join that hands them out has
    two plain exchanges below it, which adaptive execution splits where a node is hot.
    """
    least = stored(
        pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
        "least",
    )
    near = pairs.join(least, "u")
    if larger_only:
        links = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        links = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return links.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, of every node that is not a root.

    ``edges`` has long columns ``a`` and ``b``; loops and repeated edges do no harm.
    """
    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_linked_to_least(both, larger_only=True), "large-stars")
        now = stored(_linked_to_least(large, larger_only=False), "small-stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int]:
    """The number of edges and a checksum that does not depend on their order."""
    mixed = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(mixed).alias("mix")).first()
    return row["n"], row["mix"] or 0
