"""The eight source tables: columns, types, keys, and the projection that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STAMP = "etl_inserted"

_KEY = T.LongType()  # keys that grow with the business; 32 bits overflow near 2 billion orders
_INT = T.IntegerType()
_MONEY = T.DecimalType(15, 2)
_DATE = T.DateType()
_TEXT = T.StringType()


class _Char(T.StringType):
    """Marks a blank-padded CHAR column; it is stored as a trimmed string."""


_CHAR = _Char()

# Column order and types of the source schema.
_COLUMNS: dict[str, list[tuple[str, T.DataType]]] = {
    "region": [("r_regionkey", _INT), ("r_name", _CHAR), ("r_comment", _TEXT)],
    "nation": [
        ("n_nationkey", _INT),
        ("n_name", _CHAR),
        ("n_regionkey", _INT),
        ("n_comment", _TEXT),
    ],
    "customer": [
        ("c_custkey", _KEY),
        ("c_name", _TEXT),
        ("c_address", _TEXT),
        ("c_nationkey", _INT),
        ("c_phone", _CHAR),
        ("c_acctbal", _MONEY),
        ("c_mktsegment", _CHAR),
        ("c_comment", _TEXT),
    ],
    "supplier": [
        ("s_suppkey", _KEY),
        ("s_name", _CHAR),
        ("s_address", _TEXT),
        ("s_nationkey", _INT),
        ("s_phone", _CHAR),
        ("s_acctbal", _MONEY),
        ("s_comment", _TEXT),
    ],
    "part": [
        ("p_partkey", _KEY),
        ("p_name", _TEXT),
        ("p_mfgr", _CHAR),
        ("p_brand", _CHAR),
        ("p_type", _TEXT),
        ("p_size", _INT),
        ("p_container", _CHAR),
        ("p_retailprice", _MONEY),
        ("p_comment", _TEXT),
    ],
    "partsupp": [
        ("ps_partkey", _KEY),
        ("ps_suppkey", _KEY),
        ("ps_availqty", _INT),
        ("ps_supplycost", _MONEY),
        ("ps_comment", _TEXT),
    ],
    "orders": [
        ("o_orderkey", _KEY),
        ("o_custkey", _KEY),
        ("o_orderstatus", _CHAR),
        ("o_totalprice", _MONEY),
        ("o_orderdate", _DATE),
        ("o_orderpriority", _CHAR),
        ("o_clerk", _CHAR),
        ("o_shippriority", _INT),
        ("o_comment", _TEXT),
    ],
    "lineitem": [
        ("l_orderkey", _KEY),
        ("l_partkey", _KEY),
        ("l_suppkey", _KEY),
        ("l_linenumber", _INT),
        ("l_quantity", _MONEY),
        ("l_extendedprice", _MONEY),
        ("l_discount", _MONEY),
        ("l_tax", _MONEY),
        ("l_returnflag", _CHAR),
        ("l_linestatus", _CHAR),
        ("l_shipdate", _DATE),
        ("l_commitdate", _DATE),
        ("l_receiptdate", _DATE),
        ("l_shipinstruct", _CHAR),
        ("l_shipmode", _CHAR),
        ("l_comment", _TEXT),
    ],
}

SOURCE_TABLES = tuple(_COLUMNS)

# Declared keys. They are metadata; nothing de-duplicates on them.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "partsupp": ("ps_partkey", "ps_suppkey"),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
}

# Column -> (referenced table, referenced column).
FOREIGN_KEYS: dict[str, tuple[str, str]] = {
    "s_nationkey": ("nation", "n_nationkey"),
    "c_nationkey": ("nation", "n_nationkey"),
    "ps_partkey": ("part", "p_partkey"),
    "ps_suppkey": ("supplier", "s_suppkey"),
    "o_custkey": ("customer", "c_custkey"),
    "l_orderkey": ("orders", "o_orderkey"),
    "l_partkey": ("part", "p_partkey"),
    "l_suppkey": ("supplier", "s_suppkey"),
}


def _stored_type(dtype: T.DataType) -> T.DataType:
    return _TEXT if isinstance(dtype, _Char) else dtype


def columns(table: str) -> list[str]:
    return [name for name, _ in _COLUMNS[table]]


def source_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(n, _stored_type(t)) for n, t in _COLUMNS[table]])


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], source_schema(table))


def conform(df: DataFrame, table: str, lenient: bool = False) -> DataFrame:
    """Project ``df`` onto the source schema: declared order, declared types, CHARs trimmed.

    ``lenient`` turns values that do not fit their type into NULL instead of failing the
    job; the key checks then catch rows whose key was unreadable.
    """
    present = {f.name: f.dataType for f in df.schema}
    missing = [c for c in columns(table) if c not in present]
    if missing:
        raise ValueError(f"{table}: source lacks columns {missing}")
    cast = "try_cast" if lenient else "cast"

    def expression(name: str, dtype: T.DataType) -> str:
        stored, value = _stored_type(dtype), name
        if present[name] != stored:
            value = f"{cast}({value} AS {stored.simpleString()})"
        if isinstance(dtype, _Char):
            value = f"rtrim({value})"
        return f"{value} AS {name}"

    return df.selectExpr(*[expression(n, t) for n, t in _COLUMNS[table]])
