"""DuckDB SQL for the registered queries, over the sample tables.

Money is returned as double and dates as text on both sides. Averages are rounded with exact
integers, because rounding a binary average is engine-specific at half units.
"""

from __future__ import annotations

AS_OF = "2002-01-01"

_BRONZE = {
    "region": """
        SELECT r_regionkey, rtrim(r_name) AS r_name,
               concat('Comment ', r_regionkey::varchar) AS r_comment
        FROM region""",
    "nation": """
        SELECT n_nationkey, rtrim(n_name) AS n_name, n_regionkey,
               concat('Comment ', n_nationkey::varchar) AS n_comment
        FROM nation""",
    "customer": """
        SELECT c_custkey, c_name, concat('Address ', c_custkey::varchar) AS c_address,
               c_nationkey,
               concat((10 + c_nationkey)::varchar, '-', lpad(c_custkey::varchar, 7, '0')) AS c_phone,
               c_acctbal::decimal(15,2) AS c_acctbal, rtrim(c_mktsegment) AS c_mktsegment,
               concat('Comment ', c_custkey::varchar) AS c_comment
        FROM customer""",
    "supplier": """
        SELECT s_suppkey, rtrim(s_name) AS s_name,
               concat('Address ', s_suppkey::varchar) AS s_address, s_nationkey,
               concat((10 + s_nationkey)::varchar, '-', lpad(s_suppkey::varchar, 7, '0')) AS s_phone,
               s_acctbal::decimal(15,2) AS s_acctbal,
               concat('Comment ', s_suppkey::varchar) AS s_comment
        FROM supplier""",
    "part": """
        SELECT p_partkey, p_name,
               concat('Manufacturer#', (1 + p_partkey % 5)::varchar) AS p_mfgr,
               rtrim(p_brand) AS p_brand, p_type, p_size,
               CASE p_partkey % 5 WHEN 0 THEN 'SMALL BOX' WHEN 1 THEN 'MEDIUM BOX'
                    WHEN 2 THEN 'LARGE BOX' WHEN 3 THEN 'JUMBO BOX' ELSE 'WRAP CASE' END
                    AS p_container,
               p_retailprice::decimal(15,2) AS p_retailprice,
               concat('Comment ', p_partkey::varchar) AS p_comment
        FROM part""",
    "partsupp": """
        SELECT ps_partkey, ps_suppkey,
               (1 + (ps_partkey * 31 + ps_suppkey * 17) % 9999)::int AS ps_availqty,
               ((100 + (ps_partkey * 7 + ps_suppkey * 13) % 99900)::double / 100)::decimal(15,2)
                   AS ps_supplycost,
               concat('Comment ', ps_partkey::varchar) AS ps_comment
        FROM (SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem)""",
    "orders": """
        SELECT o_orderkey, o_custkey, rtrim(o_orderstatus) AS o_orderstatus,
               o_totalprice::decimal(15,2) AS o_totalprice, o_orderdate::date AS o_orderdate,
               rtrim(o_orderpriority) AS o_orderpriority,
               concat('Clerk#', lpad((o_orderkey % 1000)::varchar, 9, '0')) AS o_clerk,
               0 AS o_shippriority, concat('Comment ', o_orderkey::varchar) AS o_comment
        FROM orders""",
    "lineitem": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
               l_quantity::decimal(15,2) AS l_quantity,
               l_extendedprice::decimal(15,2) AS l_extendedprice,
               l_discount::decimal(15,2) AS l_discount, l_tax::decimal(15,2) AS l_tax,
               rtrim(l_returnflag) AS l_returnflag, rtrim(l_linestatus) AS l_linestatus,
               l_shipdate::date AS l_shipdate,
               l_shipdate::date + ((l_orderkey * 7 + l_linenumber * 13) % 61 - 30)::int
                   AS l_commitdate,
               l_shipdate::date + (1 + (l_orderkey + l_linenumber * 3) % 30)::int
                   AS l_receiptdate,
               CASE (l_orderkey + l_linenumber) % 4 WHEN 0 THEN 'DELIVER IN PERSON'
                    WHEN 1 THEN 'COLLECT COD' WHEN 2 THEN 'NONE'
                    ELSE 'TAKE BACK RETURN' END AS l_shipinstruct,
               CASE (l_orderkey * 3 + l_linenumber) % 7 WHEN 0 THEN 'REG AIR' WHEN 1 THEN 'AIR'
                    WHEN 2 THEN 'RAIL' WHEN 3 THEN 'SHIP' WHEN 4 THEN 'TRUCK' WHEN 5 THEN 'MAIL'
                    ELSE 'FOB' END AS l_shipmode,
               concat('Comment ', l_orderkey::varchar) AS l_comment
        FROM lineitem""",
}

_MONEY = {
    "customer": ["c_acctbal"],
    "supplier": ["s_acctbal"],
    "part": ["p_retailprice"],
    "partsupp": ["ps_supplycost"],
    "orders": ["o_totalprice"],
    "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
}
_DATES = {
    "orders": ["o_orderdate"],
    "lineitem": ["l_shipdate", "l_commitdate", "l_receiptdate"],
}

_KEY = {
    "region": "r_regionkey",
    "nation": "n_nationkey",
    "customer": "c_custkey",
    "supplier": "s_suppkey",
    "part": "p_partkey",
    "partsupp": "ps_partkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey",
}
_COLUMN_COUNT = {
    "region": 4,
    "nation": 5,
    "customer": 9,
    "supplier": 8,
    "part": 10,
    "partsupp": 6,
    "orders": 10,
    "lineitem": 17,
}


def _portable(relation: str, money: list[str], dates: list[str]) -> str:
    """Select everything, money as double and dates as text."""
    changed = [f"{c}::double AS {c}" for c in money] + [
        f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates
    ]
    replace = f" REPLACE ({', '.join(changed)})" if changed else ""
    return f"SELECT *{replace} FROM {relation}"


def _average(total: str, count: str, digits: int = 2) -> str:
    """``total / count`` rounded half away from zero, in integers; ``total`` must be integral."""
    scale = 10**digits
    rounded = f"(2 * abs({total})::hugeint * {scale} + {count}) // (2 * nullif({count}, 0))"
    return f"(CASE WHEN {total} < 0 THEN -1 ELSE 1 END * ({rounded}))::double / {scale}"


def _average_money(column: str) -> str:
    cents = f"sum({column} * 100)"
    return (
        f"((2 * {cents}::hugeint + count({column})) // (2 * nullif(count({column}), 0)))::double / 100"
    )


def _percent(condition: str) -> str:
    return _average(f"(100 * count(*) FILTER (WHERE {condition}))", "count(*)")


_SILVER = {
    "geo": """
        SELECT n_nationkey AS geo_nationkey, n_name AS nation_name, r_name AS region_name
        FROM b_nation LEFT JOIN b_region ON {geo_key} = r_regionkey""",
    "suppliers": """
        SELECT s_suppkey, s_name AS supplier_name, s_acctbal AS supplier_account_balance,
               nation_name AS manufacturing_country, region_name AS manufacturing_region
        FROM b_supplier LEFT JOIN geo ON s_nationkey = geo_nationkey""",
    "parts": """
        SELECT p_partkey AS part_key, p_name AS part_name, p_mfgr AS manufacturer,
               p_brand AS brand, p_type AS product_type, p_size AS size,
               p_container AS container_type, p_retailprice AS retail_price,
               round(p_retailprice * 0.8, 2)::double AS wholesale_price,
               p_type AS category, p_container AS packaging
        FROM b_part""",
    "customers": """
        SELECT c_custkey AS customer_key, c_name AS customer_name, c_address AS street_address,
               nation_name, region_name,
               concat_ws(', ', c_address, nation_name, region_name) AS full_address,
               c_phone AS phone_number, c_acctbal AS account_balance,
               c_mktsegment AS market_segment
        FROM b_customer LEFT JOIN geo ON c_nationkey = geo_nationkey""",
    "supplied_parts": """
        SELECT parts.*, ps_availqty, ps_supplycost, ps_comment, s_suppkey,
               ps_suppkey AS supplier_key, supplier_name, supplier_account_balance,
               manufacturing_country, manufacturing_region, ps_supplycost AS supply_cost,
               ps_availqty AS available_qty
        FROM parts LEFT JOIN b_partsupp ON part_key = ps_partkey
             LEFT JOIN suppliers ON ps_suppkey = s_suppkey""",
    "fct": """
        SELECT o_orderkey AS order_key, l_linenumber AS line_number, o_custkey AS customer_key,
               l_partkey AS part_key, l_suppkey AS supplier_key, o_orderdate AS order_date,
               l_shipdate AS ship_date, l_commitdate AS commit_date,
               l_receiptdate AS receipt_date, o_totalprice AS order_total_amount,
               o_orderpriority AS order_priority, o_orderstatus AS order_status,
               l_quantity AS quantity, l_extendedprice AS extended_price,
               l_discount AS discount_percentage, l_tax AS tax_percentage,
               round(l_extendedprice * (1 - l_discount)::decimal(6,2)
                     * (1 + l_tax)::decimal(6,2), 2) AS net_amount,
               round(l_extendedprice * l_discount::decimal(6,2), 2) AS discount_amount,
               round(l_extendedprice * (1 - l_discount)::decimal(6,2) * l_tax::decimal(6,2), 2)
                   AS tax_amount,
               l_shipmode AS ship_mode, l_returnflag AS return_flag,
               l_linestatus AS line_status,
               date_diff('day', o_orderdate, l_shipdate)::int AS shipping_delay_days,
               date_diff('day', l_shipdate, l_receiptdate)::int AS delivery_delay_days,
               coalesce(l_receiptdate > l_commitdate, false) AS is_late_delivery
        FROM b_lineitem JOIN b_orders ON l_orderkey = o_orderkey""",
    "wide": """
        SELECT fct.*, customer_name, street_address, nation_name, region_name, phone_number,
               account_balance, market_segment, part_name, manufacturer, brand, product_type,
               size, container_type, retail_price, wholesale_price, category, packaging,
               supply_cost, available_qty, supplier_name, supplier_account_balance,
               manufacturing_country, manufacturing_region
        FROM fct LEFT JOIN customers ON fct.customer_key = customers.customer_key
             LEFT JOIN supplied_parts ON fct.part_key = supplied_parts.part_key
             {supplier_match}""",
}

_FCT_MONEY = [
    "order_total_amount",
    "quantity",
    "extended_price",
    "discount_percentage",
    "tax_percentage",
    "net_amount",
    "discount_amount",
    "tax_amount",
]
_FCT_DATES = ["order_date", "ship_date", "commit_date", "receipt_date"]
_PART_MONEY = ["retail_price", "ps_supplycost", "supplier_account_balance", "supply_cost"]


def _query(body: str, *relations: str, geo_key: str = "n_regionkey", part_only: bool = False) -> str:
    """``body`` after the definitions of the named silver relations and all source tables."""
    match = "" if part_only else "AND fct.supplier_key = supplied_parts.supplier_key"
    parts = [f"b_{t} AS ({sql})" for t, sql in _BRONZE.items()]
    for name in relations:
        sql = _SILVER[name].format(geo_key=geo_key, supplier_match=match)
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts) + "\n" + body


def _finance(labels: dict[str, str] | None = None) -> str:
    measures = {
        "date": "strftime(order_date, '%Y-%m-%d')",
        "customer_nation": "nation_name",
        "customer_region": "region_name",
        "total_revenue": "sum(net_amount)::double",
        "total_tax": "sum(tax_amount)::double",
        "total_discounts": "sum(discount_amount)::double",
        "accounts_receivable":
            "sum(CASE WHEN order_status <> 'F' THEN net_amount ELSE 0 END)::double",
        "order_count": "count(order_key)",
        "average_order_value": _average_money("net_amount"),
        "estimated_margin":
            "round(sum(net_amount)::double - sum(extended_price)::double * 0.8, 2)",
        "margin_percentage":
            "round((sum(net_amount)::double - sum(extended_price)::double * 0.8)"
            " / nullif(sum(net_amount), 0)::double * 100, 2)",
        "avg_open_order_age":
            "round(avg(CASE WHEN order_status <> 'F' "
            f"THEN date_diff('day', order_date, DATE '{AS_OF}') END), 1)",
    }
    named = [f"{sql} AS {(labels or {}).get(name, name)}" for name, sql in measures.items()]
    return f"SELECT {', '.join(named)} FROM lines GROUP BY ALL"


# The measures need no part column, so the default mode reads fact and customer only.
_LINES = """, lines AS (
    SELECT fct.*, nation_name, region_name, market_segment
    FROM fct LEFT JOIN customers ON fct.customer_key = customers.customer_key)
"""

_FRENCH = {
    "customer_nation": "pays_client",
    "customer_region": "region_client",
    "total_revenue": "revenu_total",
    "total_tax": "taxes_totales",
    "total_discounts": "remises_totales",
    "accounts_receivable": "creances_clients",
    "estimated_margin": "marge_estimee",
    "margin_percentage": "taux_marge_pct",
    "order_count": "nombre_commandes",
    "average_order_value": "valeur_moyenne_commande",
    "avg_open_order_age": "age_moyen_commandes_jours",
}


def _sales() -> str:
    days = "sum({0})", "count({0})"
    shipping = [d.format("shipping_delay_days") for d in days]
    delivery = [d.format("delivery_delay_days") for d in days]
    return f"""
        SELECT strftime(order_date, '%Y-%m-%d') AS date, market_segment,
               region_name AS customer_region,
               sum(net_amount)::double AS total_sales,
               sum(discount_amount)::double AS total_discounts,
               {_average_money("net_amount")} AS average_order_value,
               count(DISTINCT order_key) AS number_of_orders,
               count(order_key) AS number_of_items,
               {_average(*shipping)} AS avg_shipping_delay,
               {_average(*delivery)} AS avg_delivery_delay,
               {_percent("is_late_delivery")} AS late_delivery_percentage,
               count(DISTINCT customer_key) AS unique_customers,
               count(DISTINCT part_key) AS unique_products,
               {_percent("order_status = 'F'")} AS fulfillment_rate
        FROM lines GROUP BY ALL"""


def _lines_query(body: str, **options) -> str:
    return _query(_LINES + body, "geo", "customers", "fct", **options).replace(")\n, lines", "),\nlines")


_FOREIGN = (
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("partsupp", "ps_partkey", "part", "p_partkey"),
    ("partsupp", "ps_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)


def _dq_orphans() -> str:
    pairs = "(SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem)"
    reports = []
    for table, column, parent, key in _FOREIGN:
        rows = pairs if table == "partsupp" else table
        lost = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"
        reports.append(
            f"""SELECT '{table}' AS "table", '{column}' AS "column", '{parent}' AS parent,
              count({column}) AS keyed_rows, count(*) FILTER (WHERE {lost}) AS orphan_rows,
              count(DISTINCT {column}) FILTER (WHERE {lost}) AS orphan_keys FROM {rows}"""
        )
    return " UNION ALL ".join(reports)


# Sixteen ranges by rows; one that begins within a key begins with the next one's rows.
_KEY_RANGES = """
WITH tiles AS (
  SELECT min(l_orderkey) AS low FROM (
    SELECT l_orderkey, ntile(16) OVER (ORDER BY l_orderkey) AS tile FROM lineitem)
  GROUP BY tile
), bounds AS (
  SELECT DISTINCT low FROM tiles
), ranges AS (
  SELECT row_number() OVER (ORDER BY low) AS r, low,
    lead(low) OVER (ORDER BY low) AS high FROM bounds
)
SELECT r::INTEGER AS range, count(*) AS n_rows, min(l_orderkey) AS low
FROM lineitem JOIN ranges ON l_orderkey >= ranges.low AND (high IS NULL OR l_orderkey < high)
GROUP BY r
"""


def _dq_not_null() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", '{k}' AS \"column\", count(*) AS row_count, "
        f"count(*) FILTER (WHERE {k} IS NULL) AS null_count, "
        f"count(*) FILTER (WHERE {k} IS NULL) = 0 AS success FROM b_{t}"
        for t, k in _KEY.items()
    )


def _dq_report() -> str:
    rows = []
    for t, k in _KEY.items():
        nulls = f"count(*) FILTER (WHERE {k} IS NULL)"
        rows.append(
            f"SELECT '{t}' AS \"table\", 'expect_table_columns_to_match_ordered_list' AS expectation,"
            f" NULL::varchar AS \"column\", true AS success, {_COLUMN_COUNT[t]} AS observed,"
            f" count(*) AS row_count FROM b_{t}"
        )
        rows.append(
            f"SELECT '{t}', 'expect_column_values_to_not_be_null', '{k}', {nulls} = 0, {nulls},"
            f" count(*) FROM b_{t}"
        )
    return "\nUNION ALL\n".join(rows)


def build() -> dict[str, str]:
    bronze = {
        t: _query(_portable(f"b_{t}", _MONEY.get(t, []), _DATES.get(t, []))) for t in _BRONZE
    }
    geo = "SELECT * FROM geo"
    customers = _portable("customers", ["account_balance"], [])
    finance = _lines_query(_finance())
    fanout = """
        SELECT strftime(order_date, '%Y-%m-%d') AS date, count(*) AS row_count,
               sum(net_amount)::double AS net_amount,
               sum(extended_price)::double AS extended_price
        FROM wide GROUP BY ALL"""
    sales_read = "SELECT * RENAME (customer_region AS region) FROM ({})".format(_sales())
    all_silver = ("geo", "suppliers", "parts", "customers", "supplied_parts", "fct", "wide")
    wide_read = """
        SELECT order_key, line_number, strftime(order_date, '%Y-%m-%d') AS order_date,
               order_status, order_priority, extended_price::double AS extended_price,
               net_amount::double AS net_amount, discount_amount::double AS discount_amount,
               tax_amount::double AS tax_amount, customer_name, market_segment,
               nation_name AS customer_nation, region_name AS customer_region, part_name,
               manufacturer, brand, product_type, manufacturing_country, manufacturing_region,
               shipping_delay_days, delivery_delay_days, is_late_delivery
        FROM wide"""
    sales_report = """
        SELECT date AS "Date", market_segment AS "Market Segment", customer_region AS "Region",
               total_sales AS "Total Revenue", average_order_value AS "Average Order Value",
               number_of_orders AS "Order Count", late_delivery_percentage AS "Late Delivery %",
               fulfillment_rate AS "Fulfillment Rate %"
        FROM ({})""".format(_sales())
    supply_chain = f"""
        SELECT strftime(order_date, '%Y-%m-%d') AS date,
               {_average("sum(shipping_delay_days)", "count(shipping_delay_days)")}
                   AS delai_moyen_expedition_jours,
               {_percent("is_late_delivery")} AS livraisons_tardives_pct,
               {_percent("order_status = 'F'")} AS taux_execution_commandes_pct
        FROM fct GROUP BY ALL"""
    supplier = f"""
        SELECT supplier_key, supplier_name, manufacturing_country, manufacturing_region,
               {_average("sum(delivery_delay_days)", "count(delivery_delay_days)")}
                   AS delai_moyen_livraison_jours,
               {_percent("is_late_delivery")} AS taux_retard_pct,
               {_percent("order_status = 'F'")} AS taux_execution_pct
        FROM fct LEFT JOIN suppliers ON supplier_key = s_suppkey GROUP BY ALL"""
    days = "date_diff('day', order_date, receipt_date)"
    inventory = f"""
        SELECT strftime(order_date, '%Y-%m-%d') AS date,
               sum(quantity)::double AS quantite_commandee,
               count(DISTINCT part_key) AS nombre_produits_distincts,
               {_average(f"sum({days})", f"count({days})")} AS temps_traitement_jours
        FROM fct GROUP BY ALL"""
    historical = _query(
        ", lines AS (SELECT * FROM wide)" + _finance(),
        *all_silver,
        geo_key="n_nationkey",
        part_only=True,
    ).replace(")\n, lines", "),\nlines")
    return {
        **{f"bronze_{t}": sql for t, sql in bronze.items()},
        "dq_not_null": _query(_dq_not_null()),
        "dq_report": _query(_dq_report()),
        "geo_nation_region": _query(geo, "geo"),
        "geo_nation_region_refkey": _query(geo, "geo", geo_key="n_nationkey"),
        "supplier_enriched": _query(
            _portable("suppliers", ["supplier_account_balance"], []), "geo", "suppliers"
        ),
        "part_enriched": _query(_portable("parts", ["retail_price"], []), "parts"),
        "dim_customer": _query(customers, "geo", "customers"),
        "dim_customer_refkey": _query(customers, "geo", "customers", geo_key="n_nationkey"),
        "dim_part": _query(
            _portable("supplied_parts", _PART_MONEY, []),
            "geo",
            "suppliers",
            "parts",
            "supplied_parts",
        ),
        "fct_orders": _query(_portable("fct", _FCT_MONEY, _FCT_DATES), "fct"),
        "fct_orders_bucketed": _query(_portable("fct", _FCT_MONEY, _FCT_DATES), "fct"),
        "wide_order_details": _query(
            _portable(
                "wide",
                [
                    *_FCT_MONEY,
                    "account_balance",
                    "retail_price",
                    "supply_cost",
                    "supplier_account_balance",
                ],
                _FCT_DATES,
            ),
            *all_silver,
        ),
        "wide_order_details_fanout": _query(fanout, *all_silver, part_only=True),
        "finance_metrics": finance,
        "finance_metrics_refcompat": historical,
        "finance_dashboard": _lines_query(_finance(_FRENCH)),
        "daily_sales_metrics": _lines_query(_sales()),
        "daily_sales_report": _lines_query(sales_report),
        "supply_chain_dashboard": _query(supply_chain, "fct"),
        "supplier_performance": _query(supplier, "geo", "suppliers", "fct"),
        "inventory_analysis": _query(inventory, "fct"),
        "snapshot_latest": bronze["orders"],
        "snapshot_by_partition": bronze["customer"],
        "snapshot_compacted": bronze["orders"],
        "snapshot_merged_schema": _query(
            _portable(
                "(SELECT * FROM b_customer UNION ALL"
                " SELECT * REPLACE (NULL::varchar AS c_comment) FROM b_customer)",
                ["c_acctbal"],
                [],
            )
        ),
        "snapshot_clustered": _query(
            _portable(
                "(SELECT * FROM fct WHERE order_date BETWEEN '1995-03-01' AND '1996-02-28'"
                " AND customer_key BETWEEN 100 AND 400)",
                _FCT_MONEY,
                _FCT_DATES,
            ),
            "fct",
        ),
        "tbl_orders": bronze["orders"],
        "tbl_lineitem": bronze["lineitem"],
        "dq_results_saved": _query(
            f"SELECT * EXCLUDE (observed) FROM ({_dq_report()})"
        ),
        "dq_watched": _query(_dq_report()),
        "jdbc_key_ranges": _KEY_RANGES,
        "dq_orphans": _dq_orphans(),
        "dq_orphans_found": """
            SELECT l_orderkey, l_linenumber FROM lineitem
            WHERE l_orderkey NOT IN (
              SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
              WHERE rtrim(c_mktsegment) = 'BUILDING')""",
        "tbl_rejects": """
            SELECT CASE WHEN o_orderkey % 13 = 0 THEN '2 fields, expected 9'
                        WHEN o_orderkey % 17 = 0 THEN 'o_custkey is not bigint'
                        ELSE 'read' END AS reason,
                   count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum
            FROM orders GROUP BY ALL""",
        "dim_customer_read": _query(
            _portable("(SELECT * EXCLUDE (full_address) FROM customers)", ["account_balance"], []),
            "geo",
            "customers",
        ),
        "dim_part_read": _query(
            _portable(
                "(SELECT * EXCLUDE (ps_availqty, ps_supplycost, ps_comment, s_suppkey)"
                " FROM supplied_parts)",
                [c for c in _PART_MONEY if c != "ps_supplycost"],
                [],
            ),
            "geo",
            "suppliers",
            "parts",
            "supplied_parts",
        ),
        "wide_order_details_read": _query(wide_read, *all_silver),
        "published_finance_dashboard": _lines_query(_finance(_FRENCH)),
        "published_sales_view": _lines_query(sales_report),
        "daily_sales_group_count": _lines_query(
            "SELECT count(*) AS group_count FROM"
            " (SELECT DISTINCT order_date, market_segment, region_name FROM lines)"
        ),
        "lazy_pipeline_finance": finance,
        "lazy_daily_sales_metrics": _lines_query(sales_read),
        "persisted_pipeline_finance": finance,
        "persisted_finance_historical": historical,
        "persisted_daily_sales_metrics": _lines_query(sales_read),
        "persisted_daily_sales_report": _lines_query(sales_report),
        "persisted_supply_chain_dashboard": _query(supply_chain, "fct"),
        "statistics_wealthy_orders": """
            SELECT c_nationkey AS nation_key, count(*) AS orders,
                   count(DISTINCT o_custkey) AS customers
            FROM orders JOIN customer ON o_custkey = c_custkey
            WHERE c_acctbal >= 9000
            GROUP BY c_nationkey""",
        "published_twice": _lines_query(_finance(_FRENCH)),
    }
