"""DuckDB oracle SQL, one string per query key.

Each string starts with CTEs deriving ``merchants``, ``customers`` and
``transactions`` from the driver's raw views (the same mapping as
``sources/fixtures.py``, written independently in SQL), followed by the
query. Money stays DECIMAL until the output, then DOUBLE, as in the Spark code.
"""
from __future__ import annotations

FIXTURE_CTES = """
merchants AS (
    SELECT
        CAST(s.s_suppkey AS BIGINT) AS merchant_id,
        CASE s.s_suppkey % 7 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Food & Beverage' WHEN 2 THEN 'Travel'
            WHEN 3 THEN 'Entertainment' WHEN 4 THEN 'SaaS' WHEN 5 THEN 'Gaming' ELSE 'Marketplace' END AS industry,
        r.r_name AS region,
        CASE WHEN s.s_acctbal < 2000 THEN 'small' WHEN s.s_acctbal < 7000 THEN 'medium' ELSE 'enterprise' END
            AS merchant_size,
        CASE s.s_suppkey % 3 WHEN 0 THEN 'direct' WHEN 1 THEN 'partner' ELSE 'online' END AS sales_channel,
        DATE '1995-01-01' + CAST((s.s_suppkey * 53) % 1500 AS INTEGER) AS signup_date
    FROM supplier s
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
customers AS (
    SELECT
        CAST(c.c_custkey AS BIGINT) AS customer_id,
        c.c_mktsegment AS segment,
        r.r_name AS region,
        DATE '1995-01-01' + CAST((c.c_custkey * 37) % 1500 AS INTEGER) AS join_date
    FROM customer c
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
),
transactions AS (
    SELECT
        CAST(l.l_orderkey * 10 + l.l_linenumber AS BIGINT) AS txn_id,
        CAST(l.l_shipdate AS TIMESTAMP) AS ts,
        CAST(l.l_shipdate AS DATE) AS txn_date,
        CAST(l.l_suppkey AS BIGINT) AS merchant_id,
        CAST(o.o_custkey AS BIGINT) AS customer_id,
        CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
        'USD' AS currency,
        l.l_returnflag <> 'R' AS approved,
        CASE o.o_orderstatus WHEN 'F' THEN 'card' WHEN 'O' THEN 'ach' WHEN 'P' THEN 'wallet' END AS payment_method,
        CASE WHEN l.l_returnflag <> 'R' THEN NULL
             ELSE CASE l.l_linenumber % 5 WHEN 0 THEN 'insufficient_funds' WHEN 1 THEN 'fraud_suspected'
                  WHEN 2 THEN 'network_error' WHEN 3 THEN 'limit_exceeded' ELSE 'regulatory_block' END
        END AS decline_reason,
        CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_tax AS DECIMAL(4,2)) * CAST(0.25 AS DECIMAL(3,2))
             AS DECIMAL(24,6)) AS fee,
        CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pos'
             WHEN o.o_orderpriority = '5-LOW' THEN 'inapp' ELSE 'ecom' END AS channel,
        CAST(year(l.l_shipdate) AS INTEGER) AS partition_year,
        CAST(month(l.l_shipdate) AS INTEGER) AS partition_month
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def with_fixtures(body: str) -> str:
    """Prefix a query with the fixture CTEs. ``body`` may start with further CTEs
    (``WITH a AS (...), b AS (...) SELECT ...``) or be a plain SELECT."""
    body = body.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + FIXTURE_CTES.strip() + ",\n" + body[4:].lstrip()
    return "WITH " + FIXTURE_CTES.strip() + "\n" + body


_SQL: dict[str, str] = {}


def register(key: str, body: str) -> None:
    _SQL[key] = with_fixtures(body)


def all_sql() -> dict[str, str]:
    from . import oracle_queries  # noqa: F401  (fills the registry)
    return dict(_SQL)
