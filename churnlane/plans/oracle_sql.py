"""DuckDB-side SQL fragments for the correctness oracle.

Each oracle query is ``WITH <ctes> SELECT ...`` over the pre-registered
tables.  The CTE chain mirrors the Spark plans:

* ``base``  – churn-shaped rows (FIXTURES §2.1)
* ``p``     – ``base`` with features cast to double (``try_cast``)
* ``z``     – ``p`` without incomplete rows
* ``train`` / ``test`` – the 80/20 md5 hash split of ``z`` on the key
"""

from __future__ import annotations

BASE = """
base AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS senior,
         CAST(date_diff('day', first_ts, timestamp '2000-07-01') AS INTEGER) AS tenure,
         CASE WHEN n_all > 0 THEN floor(CAST(s_all * 100 AS double) / n_all) / 100 END AS monthly,
         CASE WHEN coalesce(n_f, 0) = 0 THEN ' ' ELSE CAST(tot AS varchar) END AS total,
         CASE WHEN n_after > 0 THEN 'No' ELSE 'Yes' END AS churn
  FROM customer LEFT JOIN (
    SELECT o_custkey,
           min(CASE WHEN o_orderdate < timestamp '2000-07-01' THEN o_orderdate END) AS first_ts,
           sum(CASE WHEN o_orderdate < timestamp '2000-07-01' THEN CAST(o_totalprice AS decimal(18,2)) END) AS s_all,
           sum(CASE WHEN o_orderdate < timestamp '2000-07-01' THEN 1 ELSE 0 END) AS n_all,
           sum(CASE WHEN o_orderdate < timestamp '2000-07-01' AND o_orderstatus = 'F' THEN CAST(o_totalprice AS decimal(18,2)) END) AS tot,
           sum(CASE WHEN o_orderdate < timestamp '2000-07-01' AND o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_f,
           sum(CASE WHEN o_orderdate >= timestamp '2000-07-01' THEN 1 ELSE 0 END) AS n_after
    FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey
)"""

P = """
p AS (
  SELECT customer_id, CAST(senior AS double) AS senior, CAST(tenure AS double) AS tenure,
         monthly, TRY_CAST(total AS double) AS total, churn
  FROM base
)"""

Z = """
z AS (
  SELECT * FROM p
  WHERE senior IS NOT NULL AND tenure IS NOT NULL AND monthly IS NOT NULL
    AND total IS NOT NULL AND churn IS NOT NULL
    AND NOT isnan(senior) AND NOT isnan(tenure) AND NOT isnan(monthly) AND NOT isnan(total)
)"""


def bucket(expr: str, salt: str = "") -> str:
    """0..99 bucket from the first 8 hex digits of md5(salt || key)."""
    inner = f"CAST({expr} AS varchar)" if not salt else f"concat('{salt}', CAST({expr} AS varchar))"
    return f"(CAST(concat('0x', substr(md5({inner}), 1, 8)) AS BIGINT) % 100)"


SPLIT = f"""
train AS (SELECT * FROM z WHERE {bucket('customer_id')} < 80),
test AS (SELECT * FROM z WHERE {bucket('customer_id')} >= 80)"""


def tree_case(levels: dict | None = None, tenure_cut: float = 1800.0) -> str:
    """The fixed depth-3 tree of FIXTURES §2.3 as a CASE expression."""
    return (
        "CASE WHEN senior IS NULL OR tenure IS NULL OR monthly IS NULL OR total IS NULL THEN NULL "
        f"WHEN total <= 300000.0 THEN (CASE WHEN tenure <= {tenure_cut} THEN 'Yes' ELSE 'No' END) "
        "WHEN monthly <= 170000.0 THEN (CASE WHEN senior <= 0.5 THEN 'No' ELSE 'Yes' END) "
        "ELSE 'No' END")


def leaf_case() -> str:
    """Leaf index (0..4, left to right) of the fixed tree, NULL on NULL features."""
    return (
        "CASE WHEN senior IS NULL OR tenure IS NULL OR monthly IS NULL OR total IS NULL THEN NULL "
        "WHEN total <= 300000.0 THEN (CASE WHEN tenure <= 1800.0 THEN 0 ELSE 1 END) "
        "WHEN monthly <= 170000.0 THEN (CASE WHEN senior <= 0.5 THEN 2 ELSE 3 END) "
        "ELSE 4 END")


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BPZ = with_ctes(BASE, P, Z)
BPZS = with_ctes(BASE, P, Z, SPLIT)
