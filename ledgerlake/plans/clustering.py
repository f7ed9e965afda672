"""Rows laid out along a space-filling curve, so that file statistics skip on several columns.

Each column is cut into buckets of about equal row counts, whatever its distribution, and the bits
of the bucket numbers are interleaved. Rows near each other in all columns get near numbers; files
that hold ranges of them have narrow minima and maxima in every column. Sorting by one column
would leave the others spread over all files.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a bucket number, and so the logarithm of a column's buckets.
BITS = 8
#: Bytes of a range's rows in memory.
RANGE_BYTES = 128 << 20
PLACE = "_place_on_curve"
RANGE = "_range_of_curve"
ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def bucket_bounds(df: DataFrame, by: tuple[str, ...], bits: int = BITS) -> list[list]:
    """Per column the least values of its buckets but the first: ``2 ** bits - 1`` at most.

    Approximate quantiles, in one pass over these columns.
    """
    for name in by:
        if not isinstance(df.schema[name].dataType, ORDERED):
            raise ValueError(f"rows cannot be clustered by {name}: numbers, dates and times only")
    n = 1 << bits
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    found = df.agg(*[F.percentile_approx(c, shares, 100 * n).alias(c) for c in by]).first()
    return [sorted(set(found[c] or [])) for c in by]


def _bucket(value: Column, bounds: list, first: int = 0) -> Column:
    """The number of bounds that are at most the value, by halving them."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(value < F.lit(bounds[middle]), _bucket(value, bounds[:middle], first)).otherwise(
        _bucket(value, bounds[middle + 1 :], first + middle + 1)
    )


def placed(df: DataFrame, by: tuple[str, ...], bounds: list[list], bits: int = BITS) -> DataFrame:
    """Adds ``PLACE``, the interleaved bits of the columns' buckets; NULL is in the first bucket."""
    numbers = [f"_bucket_{i}" for i in range(len(by))]
    bucketed = df.select(
        "*",
        *[
            F.when(F.col(name).isNull(), 0).otherwise(_bucket(F.col(name), own)).alias(number)
            for name, own, number in zip(by, bounds, numbers, strict=True)
        ],
    )
    place = F.lit(0).cast("long")
    for j, number in enumerate(numbers):
        for i in range(bits):
            bit = F.shiftright(number, i).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(bit, i * len(by) + len(by) - 1 - j))
    return bucketed.select("*", place.alias(PLACE)).drop(*numbers)


def _cuts(keys: DataFrame, by: tuple[str, ...], bounds: list[list], parts: int, bits: int) -> list:
    """Places that cut the curve into ``parts`` ranges of about equal row counts."""
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = placed(keys, by, bounds, bits).agg(F.percentile_approx(PLACE, shares, 100 * parts))
    return found.first()[0] or []


def _range(place: Column, cuts: list, spread: Column) -> Column:
    """The number of a place's range; one that holds several cuts is spread over its ranges."""
    known = sorted(set(cuts))
    if not known:
        return F.lit(0)
    upto = F.array(F.lit(0), *[F.lit(bisect_right(cuts, cut)) for cut in known])
    nth = _bucket(place, known)
    last, before = F.get(upto, nth), F.get(upto, nth - 1)
    is_cut = F.get(F.array(*[F.lit(cut) for cut in known]), nth - 1) == place
    return F.when(is_cut, before + F.pmod(spread, last - before + 1)).otherwise(last).cast("int")


def clustered(
    df: DataFrame, by: tuple[str, ...], parts: int | None = None, bits: int = BITS
) -> DataFrame:
    """The same rows in ranges of the curve, sorted along it; a range becomes a file.

    Rows of one place on the curve are told apart by a hash, so a value that many rows share is
    spread over several ranges. One more pass over ``df`` computes only the columns of the curve;
    the quantiles that cut them, and then the curve, are taken from what it keeps. Without
    ``parts`` a range has about ``RANGE_BYTES`` of rows, as wide as the schema says.
    """
    keys = df.select(*by).persist(StorageLevel.DISK_ONLY)
    try:
        bounds = bucket_bounds(keys, by, bits)
        if parts is None:
            parts = max(1, -(-keys.count() * df._jdf.schema().defaultSize() // RANGE_BYTES))
        cuts = _cuts(keys, by, bounds, parts, bits) if parts > 1 else []
    finally:
        keys.unpersist()
    number = _range(F.col(PLACE), cuts, F.xxhash64(*[F.col(c) for c in df.columns]))
    rows = placed(df, by, bounds, bits).withColumn(RANGE, number)
    ranged = rows.repartitionById(parts, RANGE).drop(RANGE)
    return ranged.sortWithinPartitions(PLACE, *by).drop(PLACE)
