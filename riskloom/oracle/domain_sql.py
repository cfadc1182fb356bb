"""DuckDB text of the three derived domain tables and of the exact-rounding
helpers, used by the independent SQL oracle (``oracle_sql()``).

The Spark side builds the same tables with the DataFrame API
(``riskloom.sources.tables``); this module is the second, independent
implementation the correctness gate compares against.
"""

from __future__ import annotations


def _pad(prefix: str, key: str, width: int) -> str:
    s = f"CAST({key} AS VARCHAR)"
    return (f"CONCAT('{prefix}', CASE WHEN LENGTH({s}) >= {width} THEN {s} "
            f"ELSE LPAD({s}, {width}, '0') END)")


CUSTOMER_PROFILES_SQL = f"""
SELECT
  {_pad('CUST', 'c_custkey', 6)} AS customer_id,
  CAST(22 + (c_custkey * 7) % 43 AS INTEGER) AS age,
  n_name AS state,
  CASE WHEN (c_custkey * 37) % 100 < 50 THEN 'Salaried'
       WHEN (c_custkey * 37) % 100 < 70 THEN 'Self-Employed'
       WHEN (c_custkey * 37) % 100 < 85 THEN 'Business Owner'
       WHEN (c_custkey * 37) % 100 < 93 THEN 'Freelancer'
       ELSE 'Government' END AS employment_type,
  c_mktsegment AS segment,
  CAST(15000 + (c_custkey * 7919) % 235000 AS BIGINT) AS monthly_income,
  CAST(480 + FLOOR((c_acctbal + 1000) * 400 / 11000) AS INTEGER) AS credit_score,
  CAST((c_custkey * 13) % 20 AS INTEGER) AS years_with_bank,
  CAST((c_custkey * 11) % 5 AS INTEGER) AS existing_loans,
  CAST(2005 + (c_custkey * 17) % 19 AS INTEGER) AS onboarding_year
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

LOAN_APPLICATIONS_SQL = f"""
SELECT
  {_pad('LN', 'o_orderkey', 7)} AS loan_id,
  {_pad('CUST', 'o_custkey', 6)} AS customer_id,
  CASE WHEN (o_orderkey * 41) % 100 < 30 THEN 'Personal'
       WHEN (o_orderkey * 41) % 100 < 55 THEN 'Home'
       WHEN (o_orderkey * 41) % 100 < 70 THEN 'Vehicle'
       WHEN (o_orderkey * 41) % 100 < 85 THEN 'Business'
       WHEN (o_orderkey * 41) % 100 < 95 THEN 'Education'
       ELSE 'Credit Card' END AS loan_type,
  CAST(FLOOR(o_totalprice * 10) AS BIGINT) AS loan_amount,
  CAST(CASE o_orderkey % 9 WHEN 0 THEN 12 WHEN 1 THEN 24 WHEN 2 THEN 36 WHEN 3 THEN 48
       WHEN 4 THEN 60 WHEN 5 THEN 84 WHEN 6 THEN 120 WHEN 7 THEN 180 ELSE 240 END AS INTEGER)
       AS loan_tenure_months,
  CAST(750 + (o_orderkey * 29) % 1651 AS DOUBLE) / CAST(100 AS DOUBLE) AS interest_rate,
  CASE WHEN (o_orderkey * 7919) % 997 < 550 THEN 'Active'
       WHEN (o_orderkey * 7919) % 997 < 750 THEN 'Closed'
       WHEN (o_orderkey * 7919) % 997 < 870 THEN 'Default'
       WHEN (o_orderkey * 7919) % 997 < 920 THEN 'NPA'
       WHEN (o_orderkey * 7919) % 997 < 945 THEN 'Written-Off'
       ELSE 'Restructured' END AS loan_status,
  CAST(YEAR(o_orderdate) AS INTEGER) AS disbursement_year,
  CAST(MONTH(o_orderdate) AS INTEGER) AS disbursement_month,
  CAST(FLOOR(o_totalprice * 1000) AS DOUBLE)
    / CAST(100 * (12 + (o_orderkey * 31) % 229) AS DOUBLE) AS emi_amount,
  CAST(CASE WHEN (o_orderkey * 7919) % 997 >= 550 THEN 0
       WHEN (o_orderkey * 104729) % 991 < 694 THEN 0
       WHEN (o_orderkey * 104729) % 991 < 793 THEN 30
       WHEN (o_orderkey * 104729) % 991 < 872 THEN 60
       WHEN (o_orderkey * 104729) % 991 < 931 THEN 90
       WHEN (o_orderkey * 104729) % 991 < 961 THEN 120
       WHEN (o_orderkey * 104729) % 991 < 981 THEN 180
       ELSE 240 END AS INTEGER) AS dpd_days,
  CONCAT('NATION_', CAST((o_orderkey * 23) % 25 AS VARCHAR)) AS state,
  CONCAT('BR', LPAD(CAST(1 + (o_orderkey * 19) % 499 AS VARCHAR), 4, '0')) AS branch_code
FROM orders
"""

TRANSACTIONS_SQL = f"""
SELECT
  CONCAT('TXN', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), '-',
         CAST(l_partkey AS VARCHAR)) AS transaction_id,
  {_pad('LN', 'l_orderkey', 7)} AS loan_id,
  CASE WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 40 THEN 'Cash_Withdrawal'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 65 THEN 'EMI_Payment'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 80 THEN 'UPI_Transfer'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 87 THEN 'NEFT'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 91 THEN 'Card_Payment'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 94 THEN 'RTGS'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 96 THEN 'Loan_Disbursement'
       WHEN (l_partkey * 31 + l_suppkey * 7) % 100 < 98 THEN 'Interest_Credit'
       ELSE 'Reversal' END AS transaction_type,
  l_extendedprice * 5 AS amount,
  CASE l_suppkey % 6 WHEN 0 THEN 'Mobile_App' WHEN 1 THEN 'Net_Banking' WHEN 2 THEN 'ATM'
       WHEN 3 THEN 'Branch' WHEN 4 THEN 'POS' ELSE 'UPI' END AS channel,
  CAST(YEAR(l_shipdate) AS INTEGER) AS transaction_year,
  CAST(MONTH(l_shipdate) AS INTEGER) AS transaction_month,
  CAST((l_partkey * l_linenumber + l_suppkey) % 24 AS INTEGER) AS transaction_hour,
  CASE WHEN l_extendedprice > 40000 AND l_discount >= 0.05 THEN 1 ELSE 0 END AS is_suspicious_flag,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS reversal_flag,
  CONCAT('NATION_', CAST((l_suppkey * 23) % 25 AS VARCHAR)) AS state
FROM lineitem
"""

TIMED_SQL = TRANSACTIONS_SQL.rstrip().removesuffix("FROM lineitem").rstrip() + """,
  l_shipdate + to_hours(CAST((l_partkey * l_linenumber + l_suppkey) % 24 AS INTEGER)) AS txn_time
FROM lineitem
"""

DOMAIN_CTES = {
    "customer_profiles": CUSTOMER_PROFILES_SQL,
    "loan_applications": LOAN_APPLICATIONS_SQL,
    "transactions": TRANSACTIONS_SQL,
    "timed_transactions": TIMED_SQL,
}


def with_domain(body: str, tables: tuple[str, ...] = ("customer_profiles", "loan_applications",
                                                      "transactions")) -> str:
    """Prefix a report query with the CTEs of the domain tables it uses."""
    ctes = ",\n".join(f"{t} AS ({DOMAIN_CTES[t]})" for t in tables)
    own = body.lstrip()  # a report with CTEs of its own: they join the list
    return f"WITH {ctes},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- rounding --

def round_ratio_sql(num: str, den: str, scale: int = 2, mode: str = "half_up") -> str:
    """Exact ROUND(num / den, scale) of integer-valued expressions (HUGEINT math)."""
    p = 10 ** scale
    an = f"CAST(abs({num}) AS HUGEINT)"
    ad = f"CAST(abs({den}) AS HUGEINT)"
    if mode == "half_up":
        q = f"(({an} * {2 * p} + {ad}) // (2 * {ad}))"
    else:
        t = f"({an} * {p})"
        q0 = f"({t} // {ad})"
        r2 = f"(({t} - {q0} * {ad}) * 2)"
        q = (f"(CASE WHEN {r2} > {ad} THEN {q0} + 1 "
             f"WHEN {r2} = {ad} AND {q0} % 2 = 1 THEN {q0} + 1 ELSE {q0} END)")
    mag = f"(CAST({q} AS DOUBLE) / {p})"
    return (f"(CASE WHEN ({den}) = 0 THEN NULL "
            f"WHEN (({num}) < 0 AND ({den}) > 0) OR (({num}) > 0 AND ({den}) < 0) THEN -{mag} "
            f"ELSE {mag} END)")


def pct_sql(num: str, den: str, scale: int = 2, mode: str = "half_up") -> str:
    return round_ratio_sql(f"CAST({num} AS HUGEINT) * 100", den, scale, mode)


def money_sql(col: str, scale: int | None = None) -> str:
    """SUM of an amount column, added up as a decimal; rounded only if asked."""
    total = f"SUM(CAST({col} AS DECIMAL(38,6)))"
    return f"CAST({total if scale is None else f'ROUND({total}, {scale})'} AS DOUBLE)"


def money_avg_sql(col: str, scale: int = 2, mode: str = "half_up") -> str:
    """ROUND(AVG(amount)) from the sum of millionths."""
    return round_ratio_sql(f"SUM(CAST(ROUND({col} * 1000000) AS HUGEINT))", f"COUNT({col}) * 1000000", scale, mode)


def half_even_double_sql(x: str, scale: int) -> str:
    """numpy round on a double: rint(x * 10^s) / 10^s."""
    p = 10 ** scale
    return f"(round_even(({x}) * {p}, 0) / {p})"
