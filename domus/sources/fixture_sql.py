"""SQL text of the fixture views, for the DuckDB oracles.

Same rows as ``domus.sources.fixtures``; written in the SQL subset both
DuckDB and Spark accept (FIXTURES.md part B).
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "tx": """
SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS transaction_id,
       CAST(l_shipdate AS DATE) AS transaction_date,
       c_nationkey AS department,
       c_mktsegment AS city,
       CAST(c_nationkey * 100 + ascii(c_mktsegment) AS INT) AS city_id,
       l_extendedprice AS price,
       l_quantity AS living_area,
       l_linenumber AS num_rooms,
       CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INT) AS off_plan,
       p_type AS building_type,
       40.0E0 + c_nationkey * 0.5E0 + l_discount AS latitude,
       l_tax * 10.0E0 AS longitude,
       CASE WHEN l_partkey % 50 = 0 THEN '{"a":1}' ELSE '{}' END AS surface_terrains_nature,
       CASE WHEN l_partkey % 50 = 1 THEN '{"a":1}' ELSE '{}' END AS surface_terrains_sols,
       CASE WHEN l_partkey % 50 = 2 THEN '{"a":1}' ELSE '{}' END AS surface_terrains_agricoles,
       CASE WHEN l_partkey % 50 = 3 THEN '{"a":1}' ELSE '{}' END AS surface_locaux_industriels,
       CASE WHEN l_linenumber = 7 THEN '{"a":1}' ELSE '{}' END AS surface_dependances
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey""",
    "regions": """
SELECT CAST(n_nationkey AS STRING) AS department_code, n_name AS department_name,
       CAST(r_regionkey AS STRING) AS region_code, r_name AS region_name
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "debt_ratio": """
SELECT CAST(year(o_orderdate) AS INT) AS date, avg(o_totalprice) / 10000.0E0 AS debt_ratio
FROM orders GROUP BY CAST(year(o_orderdate) AS INT)""",
    "financial_assets": """
SELECT CAST(year(o_orderdate) AS INT) AS date,
       sum(o_totalprice) / count(DISTINCT o_custkey) AS euros_per_capita,
       avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0E0 ELSE 0.0E0 END) AS bank_deposit_share,
       avg(CASE WHEN o_orderpriority = '2-HIGH' THEN 1.0E0 ELSE 0.0E0 END) AS life_insurance_share
FROM orders GROUP BY CAST(year(o_orderdate) AS INT)""",
    "interest_rate": """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(l_discount) * 100.0E0 AS taux
FROM lineitem GROUP BY CAST(date_trunc('month', l_shipdate) AS DATE)""",
    "new_loans": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, count(*) AS loans_million_eur
FROM orders GROUP BY CAST(date_trunc('month', o_orderdate) AS DATE)""",
    "rent_reference_index": """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(l_tax) * 100.0E0 AS IRL
FROM lineitem WHERE month(l_shipdate) IN (1, 4, 7, 10)
GROUP BY CAST(date_trunc('month', l_shipdate) AS DATE)""",
    "tax_households": """
SELECT CAST(c_nationkey AS STRING) AS department, c_mktsegment AS city,
       CAST(c_nationkey * 100 + ascii(c_mktsegment) AS INT) AS city_id,
       count(*) AS n_foyers_fiscaux, avg(c_acctbal) AS revenu_fiscal_moyen
FROM customer GROUP BY c_nationkey, c_mktsegment""",
    "scored_regression": """
SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id,
       CAST(l_shipdate AS DATE) AS d, p_type AS category, l_quantity AS x,
       l_extendedprice AS y, p_retailprice * l_quantity AS prediction
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "scored_binary": """
SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey AS id,
       CAST(l_shipdate AS DATE) AS d, l_linestatus AS segment,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT) AS y,
       l_quantity / 50.0E0 AS score,
       CAST(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END AS INT) AS prediction
FROM lineitem""",
    "runs": """
SELECT user_id AS run_id, event_type AS experiment,
       CASE WHEN user_id % 5 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
       avg(value) / 500.0E0 AS average_test_f1, count(*) AS num_rows
FROM events GROUP BY user_id, event_type""",
}


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the named views (and any extra CTEs passed as
    ``name AS (...)`` strings)."""
    parts = []
    for n in names:
        if n in VIEWS:
            parts.append(f"{n} AS ({VIEWS[n]}\n)")
        else:
            parts.append(n)
    if not parts:
        return body
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        # the body brings its own CTEs: merge them into one WITH list
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body
