"""Completes the sample tables, which lack some source columns, to the full source schema.

Missing columns are derived from keys with expressions that any SQL engine can repeat;
``partsupp`` is the set of (part, supplier) pairs that order lines use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schemas import conform


def _comment(key: str) -> str:
    return f"concat('Comment ', cast({key} as string))"


_DERIVED: dict[str, dict[str, str]] = {
    "region": {"r_comment": _comment("r_regionkey")},
    "nation": {"n_comment": _comment("n_nationkey")},
    "customer": {
        "c_address": "concat('Address ', cast(c_custkey as string))",
        "c_phone": "concat(cast(10 + c_nationkey as string), '-', "
        "lpad(cast(c_custkey as string), 7, '0'))",
        "c_comment": _comment("c_custkey"),
    },
    "supplier": {
        "s_address": "concat('Address ', cast(s_suppkey as string))",
        "s_phone": "concat(cast(10 + s_nationkey as string), '-', "
        "lpad(cast(s_suppkey as string), 7, '0'))",
        "s_comment": _comment("s_suppkey"),
    },
    "part": {
        "p_mfgr": "concat('Manufacturer#', cast(1 + p_partkey % 5 as string))",
        "p_container": "case p_partkey % 5 when 0 then 'SMALL BOX' when 1 then 'MEDIUM BOX' "
        "when 2 then 'LARGE BOX' when 3 then 'JUMBO BOX' else 'WRAP CASE' end",
        "p_comment": _comment("p_partkey"),
    },
    "orders": {
        "o_clerk": "concat('Clerk#', lpad(cast(o_orderkey % 1000 as string), 9, '0'))",
        "o_shippriority": "0",
        "o_comment": _comment("o_orderkey"),
    },
    "lineitem": {
        "l_commitdate": "date_add(cast(l_shipdate as date), "
        "cast((l_orderkey * 7 + l_linenumber * 13) % 61 - 30 as int))",
        "l_receiptdate": "date_add(cast(l_shipdate as date), "
        "cast(1 + (l_orderkey + l_linenumber * 3) % 30 as int))",
        "l_shipinstruct": "case (l_orderkey + l_linenumber) % 4 when 0 then 'DELIVER IN PERSON' "
        "when 1 then 'COLLECT COD' when 2 then 'NONE' else 'TAKE BACK RETURN' end",
        "l_shipmode": "case (l_orderkey * 3 + l_linenumber) % 7 when 0 then 'REG AIR' "
        "when 1 then 'AIR' when 2 then 'RAIL' when 3 then 'SHIP' when 4 then 'TRUCK' "
        "when 5 then 'MAIL' else 'FOB' end",
        "l_comment": _comment("l_orderkey"),
    },
    "partsupp": {
        "ps_availqty": "cast(1 + (ps_partkey * 31 + ps_suppkey * 17) % 9999 as int)",
        "ps_supplycost": "cast(cast(100 + (ps_partkey * 7 + ps_suppkey * 13) % 99900 "
        "as decimal(15,2)) / 100 as decimal(15,2))",
        "ps_comment": _comment("ps_partkey"),
    },
}


def load(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """One source table in the full schema, from ``<directory>/*.parquet``."""
    stored = "lineitem" if table == "partsupp" else table
    rows = spark.read.parquet(f"{directory.rstrip('/')}/{stored}.parquet")
    if table == "partsupp":
        rows = rows.selectExpr("l_partkey as ps_partkey", "l_suppkey as ps_suppkey").distinct()
    derived = [f"{expr} as {name}" for name, expr in _DERIVED[table].items()]
    return conform(rows.selectExpr("*", *derived), table)
