"""Explicit schemas of the three domain tables.

Columns are listed in *file order* (the order in which the landing CSV files
hold them), so that a positional CSV read cannot shift values into the wrong
column.  Comments become ``StructField`` metadata.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment})


# The columns' names, types and comments are those of the tables' declarations, word for word,
# so that a table described from the catalog reads the same (the partition column has no comment there; this one is ours).
CUSTOMER_PROFILES = T.StructType([
    _f("customer_id", T.StringType(), "Unique customer identifier"),
    _f("age", T.IntegerType(), "Customer age in years"),
    _f("state", T.StringType(), "Home state"),
    _f("employment_type", T.StringType(), "Salaried / Self-Employed / Business / Freelancer / Government"),
    _f("segment", T.StringType(), "Risk segment: Retail / SME / Corporate / Premium / Mass"),
    _f("monthly_income", T.LongType(), "Monthly income in INR"),
    _f("credit_score", T.IntegerType(), "Bureau credit score 300–900"),
    _f("years_with_bank", T.IntegerType(), "Customer tenure in years"),
    _f("existing_loans", T.IntegerType(), "Number of live loans at onboarding"),
    _f("onboarding_year", T.IntegerType(), "Year customer joined the bank"),
])

# disbursement_year is the partition column of the analytic table, but the
# landing file holds it as its 8th column.
LOAN_APPLICATIONS = T.StructType([
    _f("loan_id", T.StringType(), "Unique loan identifier"),
    _f("customer_id", T.StringType(), "FK to customer_profiles"),
    _f("loan_type", T.StringType(), "Personal / Home / Vehicle / Business / Education / Credit Card"),
    _f("loan_amount", T.LongType(), "Sanctioned loan amount in INR"),
    _f("loan_tenure_months", T.IntegerType(), "Repayment tenure in months"),
    _f("interest_rate", T.DoubleType(), "Annual interest rate %"),
    _f("loan_status", T.StringType(), "Active / Closed / Default / NPA / Written-Off / Restructured"),
    _f("disbursement_year", T.IntegerType(), "Year of disbursement (partition)"),
    _f("disbursement_month", T.IntegerType(), "Month of loan disbursement"),
    _f("emi_amount", T.DoubleType(), "Monthly EMI in INR"),
    _f("dpd_days", T.IntegerType(), "Days Past Due — key default indicator"),
    _f("state", T.StringType(), "Loan origination state"),
    _f("branch_code", T.StringType(), "Originating branch"),
])

TRANSACTIONS = T.StructType([
    _f("transaction_id", T.StringType(), "Unique transaction identifier"),
    _f("loan_id", T.StringType(), "FK to loan_applications"),
    _f("transaction_type", T.StringType(), "EMI_Payment / Cash_Withdrawal / UPI_Transfer etc."),
    _f("amount", T.DoubleType(), "Transaction amount in INR"),
    _f("channel", T.StringType(), "Mobile_App / Net_Banking / ATM / Branch / POS / UPI"),
    _f("transaction_year", T.IntegerType(), "Year of transaction"),
    _f("transaction_month", T.IntegerType(), "Month of transaction"),
    _f("transaction_hour", T.IntegerType(), "Hour of day (0-23)"),
    _f("is_suspicious_flag", T.IntegerType(), "1 = flagged by rule engine, 0 = clean"),
    _f("reversal_flag", T.IntegerType(), "1 = reversed transaction"),
    _f("state", T.StringType(), "Transaction state"),
])

PARTITION_COLUMN = "disbursement_year"

SCHEMAS = {
    "customer_profiles": CUSTOMER_PROFILES,
    "loan_applications": LOAN_APPLICATIONS,
    "transactions": TRANSACTIONS,
}
