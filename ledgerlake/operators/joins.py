"""Joining a large fact to a dimension when a few keys may hold most of the fact's rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session setting that asks for the search of hot keys: it reads the key columns of each large
#: join's fact while the plan is made. Without it adaptive execution splits what it finds skewed.
SEARCH = "ledgerlake.hotKeys.search"
#: Session setting for the keys each sketch follows; by default four per shuffle partition.
ITEMS = "ledgerlake.hotKeys.items"
MERGE_TASKS = 256

_HASH, _SALTS, _SALT = "_key_hash", "_salts", "_salt"
_SALTED, _DIM_SALTED = "_salted_key", "_dim_salted_key"


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _plan(df: DataFrame):
    """The optimized plan, which carries size estimates; None in a remote session."""
    return df._jdf.queryExecution().optimizedPlan() if hasattr(df, "_jdf") else None


def _bytes(plan) -> int:
    return int(str(plan.stats().sizeInBytes()))


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether a dimension is within Spark's broadcast threshold; False when it is unknown.

    A dimension has about as many rows as the largest table it is made from, because it joins
    tables by their keys. Spark's estimate multiplies the sizes of joined tables instead, so the
    sum of the tables' own sizes decides where it is smaller.
    """
    plan = _plan(dim)
    if plan is None:
        return False
    tables = plan.collectLeaves()
    read = sum(_bytes(tables.apply(i)) for i in range(tables.size()))
    conf = dim.sparkSession._jsparkSession.sessionState().conf()
    return min(read, _bytes(plan)) <= conf.autoBroadcastJoinThreshold()


def search_wanted(spark: SparkSession) -> bool:
    return spark.conf.get(SEARCH, "false").lower() == "true"


def sketch_items(spark: SparkSession, partitions: int) -> int:
    """Keys that a sketch follows: enough for every key that fills a quarter of a partition.

    Spark's sketches follow a million keys at most.
    """
    return int(spark.conf.get(ITEMS, None) or min(1_000_000, max(1_024, 4 * partitions)))


def hot_keys(df: DataFrame, keys: list[str], partitions: int) -> list[tuple[int, int]]:
    """Key hashes that alone fill two or more of ``partitions`` equal shares, and how many.

    One pass over the key columns with a frequent-items sketch per task, merged in two steps so
    that no task receives every sketch; no row is shuffled by key. At most ``partitions`` pairs
    come back. A NULL key has a hash like any other. The counts are estimates, and a key that
    goes unnoticed costs balance, which adaptive execution evens out, and never rows.
    """
    tracked = sketch_items(df.sparkSession, partitions)
    listed = min(partitions, tracked)
    share = f"least({partitions}, ceil(count * {partitions} / n))"
    found = (
        df.select(F.xxhash64(*keys).alias("k"), F.spark_partition_id().alias("task"))
        .groupBy(F.expr(f"task % {MERGE_TASKS}"))
        .agg(
            F.expr(f"approx_top_k_accumulate(k, {tracked})").alias("sketch"),
            F.count(F.lit(1)).alias("n"),
        )
        .groupBy(F.lit("all"))  # a global aggregate cannot ship the sketch of a task without rows
        .agg(
            F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"),
            F.sum("n").alias("n"),
        )
        .selectExpr(f"inline(approx_top_k_estimate(sketch, {listed}))", "n")
        .selectExpr("item", f"cast({share} AS int) AS salts")
        .filter("salts > 1")
    )
    return [(row["item"], row["salts"]) for row in found.collect()]


def _with_salt(salt: Column) -> Column:
    """The key hash with a salt in its low bits: different for every salt of a key."""
    return F.col(_HASH).bitwiseXOR(salt.cast("bigint"))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    how: str = "left",
    skew_source: DataFrame | None = None,
) -> DataFrame:
    """``fact`` inner- or left-joined to ``dim`` on ``{fact column: dim column}``.

    A dimension within Spark's broadcast threshold is broadcast: the fact is not shuffled, so no
    key can be hot. Beyond it the join is Spark's, unless the session asks for the search of hot
    keys (``SEARCH``). If the search finds any, both sides are shuffled by key plus a salt. A
    fact row of a hot key takes one salt, the dimension rows of that key are repeated for every
    salt, so each pair still meets exactly once. The salts of all hot keys add up to at most two
    per shuffle partition, which bounds the repetition for dimensions with one row per key.

    The hot keys are fixed when the plan is made, so both sides agree on them. The salt is the
    task's partition number: a retried task gets the same one, and exact copies of a row spread
    too. ``skew_source`` is a cheaper frame with the fact's key columns (the table they come
    from) to find hot keys in when ``fact`` itself is a join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how}")
    fact_types, dim_types = ({f.name: f.dataType for f in df.schema} for df in (fact, dim))
    clash = fact_types.keys() & dim_types.keys()
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    mixed = [f"{f}/{d}" for f, d in on.items() if fact_types[f] != dim_types[d]]
    if mixed:  # the hash of a number depends on its width
        raise ValueError(f"join keys differ in type: {mixed}")

    condition = [F.col(f) == F.col(d) for f, d in on.items()]
    if fits_broadcast(dim):
        return fact.join(F.broadcast(dim), condition, how)
    spark = fact.sparkSession
    source = fact if skew_source is None else skew_source
    search = search_wanted(spark)
    hot = hot_keys(source, list(on), shuffle_partitions(spark)) if search else []
    if not hot:
        return fact.join(dim, condition, how)

    salts = F.coalesce(_SALTS, F.lit(1))
    # as many rows as there are hot keys: at most the number of shuffle partitions
    table = F.broadcast(spark.createDataFrame(hot, f"{_HASH} bigint, {_SALTS} int"))
    fact_keys, dim_keys = list(on), list(on.values())
    salted_fact = (
        (fact if how == "left" else fact.dropna(subset=fact_keys))
        .withColumn(_HASH, F.xxhash64(*fact_keys))
        .join(table, _HASH, "left")
        .withColumn(_SALTED, _with_salt(F.pmod(F.spark_partition_id(), salts)))
        .drop(_HASH, _SALTS)
    )
    salted_dim = (
        dim.dropna(subset=dim_keys)
        .withColumn(_HASH, F.xxhash64(*dim_keys))
        .join(table, _HASH, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
        .withColumn(_DIM_SALTED, _with_salt(F.col(_SALT)))
        .drop(_HASH, _SALTS, _SALT)
    )
    # One 64-bit key sorts much faster than the keys and the salt would; the true keys are
    # compared as well, wrapped so that Spark does not take them for sort keys again.
    same_keys = F.coalesce(reduce(and_, condition), F.lit(False))
    joined = salted_fact.join(salted_dim, (F.col(_SALTED) == F.col(_DIM_SALTED)) & same_keys, how)
    return joined.drop(_SALTED, _DIM_SALTED)
