"""Portfolio overview and concentration reports.

Joins of loans with customers are written as *aggregate, then join*: loans
are first reduced to one row per join key (plus the loan-side grouping
columns) with map-side partial aggregation, and only that reduced frame meets
the customer table (itself reduced to one row per customer_id where only the
score is needed).  A customer holding a third of all loans therefore costs
one partial row per map task instead of a third of the join input, and the
results stay exact even when customer_id is duplicated in the dimension (each
customer copy multiplies the per-customer sums exactly as the row-level join
would).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import avg_round, flag, half_even_double, pct, stressed
from riskloom.operators.share import grand_total
from riskloom.operators.topk import sort_small
from riskloom.plans.common import customer_scores


def portfolio_by_loan_type(loans: DataFrame) -> DataFrame:
    """Exposure, average size and portfolio share per loan type."""
    agg = loans.groupBy("loan_type").agg(
        F.count("*").alias("total_loans"),
        F.sum("loan_amount").alias("total_exposure_inr"),
        F.count("loan_amount").alias("_n_amount"),
    )
    out = agg.select(
        "loan_type",
        "total_loans",
        "total_exposure_inr",
        avg_round("total_exposure_inr", "_n_amount", 2).alias("avg_loan_amount"),
        pct("total_exposure_inr", grand_total("total_exposure_inr"), 2).alias("portfolio_share_pct"),
    )
    return sort_small(out, [("total_exposure_inr", False)], ["loan_type"])


def portfolio_by_loan_type_int(loans: DataFrame) -> DataFrame:
    """The pandas flavour: column ``total_exposure``, average rounded half-even
    to an integer, share rounded half-even on the double ratio."""
    agg = loans.groupBy("loan_type").agg(
        F.count("loan_id").alias("total_loans"),
        F.sum("loan_amount").alias("total_exposure"),
        F.avg("loan_amount").alias("_avg"),
    )
    share = F.col("total_exposure").cast("double") / grand_total("total_exposure").cast("double") * 100
    out = agg.select(
        "loan_type",
        "total_loans",
        "total_exposure",
        F.bround("_avg", 0).cast("bigint").alias("avg_loan_amount"),
        half_even_double(share, 2).alias("portfolio_share_pct"),
    )
    return sort_small(out, [("total_exposure", False)], ["loan_type"])


def geographic_concentration(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Exposure by the loan's origination state, with borrower count and the
    loan-weighted average credit score of the borrowers."""
    per_customer = loans.groupBy("state", "customer_id").agg(
        F.count("loan_id").alias("n_loans"),
        F.count("*").alias("n_rows"),
        F.sum("loan_amount").alias("amount"),
    )
    # one row per customer_id on both sides: (state, customer) pairs are
    # distinct, so counting joined rows counts distinct borrowers per state
    joined = per_customer.join(customer_scores(customers), "customer_id", "inner")
    agg = joined.groupBy("state").agg(
        F.count("*").alias("unique_borrowers"),
        F.sum(F.col("n_loans") * F.col("n_copies")).alias("total_loans"),
        F.sum(F.col("amount") * F.col("n_copies")).alias("exposure_inr"),
        F.sum(F.col("n_rows") * F.col("score_sum")).alias("_score_sum"),
        F.sum(F.col("n_rows") * F.col("score_n")).alias("_score_n"),
    )
    out = agg.select(
        "state",
        "unique_borrowers",
        "total_loans",
        "exposure_inr",
        avg_round("_score_sum", "_score_n", 1).alias("avg_credit_score"),
        pct("exposure_inr", grand_total("exposure_inr"), 2).alias("exposure_share_pct"),
    )
    return sort_small(out, [("exposure_inr", False)], ["state"])


def segment_concentration(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Exposure and stress rate per (customer segment, employment type)."""
    per_customer = loans.groupBy("customer_id").agg(
        F.count("loan_id").alias("n_loans"),
        F.count("*").alias("n_rows"),
        F.sum("loan_amount").alias("amount"),
        F.sum(flag(stressed())).alias("n_stressed"),
    )
    dims = customers.select("customer_id", "segment", "employment_type",
                            F.col("credit_score").cast("bigint").alias("score"))
    joined = per_customer.join(dims, "customer_id", "inner")
    agg = joined.groupBy("segment", "employment_type").agg(
        F.sum("n_loans").alias("loan_count"),
        F.sum("amount").alias("total_exposure"),
        F.sum(F.col("n_rows") * F.col("score")).alias("_score_sum"),
        F.sum(F.when(F.col("score").isNotNull(), F.col("n_rows"))).alias("_score_n"),
        F.sum("n_stressed").alias("stressed_accounts"),
        F.sum("n_rows").alias("_rows"),
    )
    out = agg.select(
        "segment",
        "employment_type",
        "loan_count",
        "total_exposure",
        avg_round("_score_sum", "_score_n", 0).alias("avg_credit_score"),
        "stressed_accounts",
        pct("stressed_accounts", "_rows", 2).alias("stress_rate_pct"),
    )
    return sort_small(out, [("stress_rate_pct", False)], ["segment", "employment_type"])

