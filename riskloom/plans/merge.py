"""Loan-level view with the borrower's attributes attached (LEFT JOIN).

Loans without a known customer are kept with NULL customer columns.  The
column present on both sides, ``state``, is kept twice: ``state_x`` is the
loan's origination state, ``state_y`` the customer's home state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loan_customer_merge(loans: DataFrame, customers: DataFrame) -> DataFrame:
    shared = (set(loans.columns) & set(customers.columns)) - {"customer_id"}
    left = loans.select(*[F.col(c).alias(f"{c}_x") if c in shared else F.col(c) for c in loans.columns])
    right = customers.select(*[F.col(c).alias(f"{c}_y") if c in shared else F.col(c)
                               for c in customers.columns])
    return left.join(right, "customer_id", "left")
