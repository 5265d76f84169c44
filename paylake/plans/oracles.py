"""Plain SQL over the given tables that says what the lake must hold. No JSON is involved."""

from __future__ import annotations

# The three normalised tables, straight from the base tables.
FK = """fk AS (
    SELECT 'faker' AS source, date_trunc('milliseconds', ts) AS received_at,
           'tx-' || event_id AS transaction_id, 'user_' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS user_id,
           value AS amount, 'eur' AS currency,
           CASE event_id % 3 WHEN 0 THEN 'debit' WHEN 1 THEN 'credit' ELSE 'refund' END AS transaction_type,
           TIMESTAMP '2024-01-01' + to_minutes(event_id % 2880) AS folded
    FROM events WHERE (event_id // 3) % 3 = 1)"""

ST = """st AS (
    SELECT 'stripe' AS source, TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 43200) AS received_at,
           'pi_' || o_orderkey AS payment_intent_id, 'cus_' || o_custkey AS customer_id,
           CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS amount, 'eur' AS currency,
           o_orderpriority AS payment_method,
           TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 2880) AS folded
    FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0)"""

RV = """rv AS (
    SELECT 'revolut' AS source,
           TIMESTAMP '2024-01-01' + to_minutes((l_orderkey * 7 + l_linenumber) % 43200) AS received_at,
           'rv_' || l_orderkey || '_' || l_linenumber AS transaction_id, 'acc_' || l_suppkey AS user_id,
           l_extendedprice AS amount, 'GBP' AS currency, lower(l_returnflag) AS transaction_type,
           TIMESTAMP '2024-01-01' + to_minutes((l_orderkey * 7 + l_linenumber) % 2880) AS folded
    FROM lineitem WHERE l_linestatus = 'F')"""

# One row per message: its source and time, as written and folded onto two days.
ENV = """env AS (
    SELECT 'faker' AS source, date_trunc('milliseconds', ts) AS seen,
           TIMESTAMP '2024-01-01' + to_minutes(event_id % 2880) AS folded, 'tx-' || event_id AS id, value AS amount
    FROM events
    UNION ALL
    SELECT 'stripe', TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 43200),
           TIMESTAMP '2024-01-01' + to_minutes(o_orderkey % 2880), 'pi_' || o_orderkey,
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE)
    FROM orders
    UNION ALL
    SELECT 'revolut', TIMESTAMP '2024-01-01' + to_minutes((l_orderkey * 7 + l_linenumber) % 43200),
           TIMESTAMP '2024-01-01' + to_minutes((l_orderkey * 7 + l_linenumber) % 2880),
           'rv_' || l_orderkey || '_' || l_linenumber, l_extendedprice
    FROM lineitem)"""


def money(expr: str) -> str:
    """An order-independent sum of money, the same text for both engines."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18, 2))) AS DOUBLE)"


def parts(ts: str, hour: bool = False) -> str:
    names = {"year": "%Y", "month": "%m", "day": "%d"} | ({"hr": "%H"} if hour else {})
    return ", ".join(f"strftime({ts}, '{form}') AS {name}" for name, form in names.items())


def with_tables(body: str, *tables: str) -> str:
    return f"WITH {', '.join(tables)}\n{body}"
