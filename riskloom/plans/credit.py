"""Default and NPA indicators: NPA rate, DPD buckets, vintage default rate,
high-risk micro-segments and the credit-score distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import avg_round, dpd_bucket, flag, half_even_double, pct, score_band, stressed
from riskloom.operators.share import total_as_scalar
from riskloom.operators.topk import sort_small, top_k


def gross_npa_rate(loans: DataFrame, mode: str = "half_up") -> DataFrame:
    """NPA exposure as a share of exposure, per loan type (by amount).  The
    pandas flavour rounds ``half_even``."""
    npa_amount = F.when(F.col("loan_status") == "NPA", F.col("loan_amount")).otherwise(F.lit(0))
    agg = loans.groupBy("loan_type").agg(
        F.count("*").alias("total_loans"),
        F.sum(npa_amount).alias("npa_amount"),
        F.sum("loan_amount").alias("total_amount"),
    )
    out = agg.withColumn("gross_npa_rate_pct", pct("npa_amount", "total_amount", 2, mode))
    return sort_small(out, [("gross_npa_rate_pct", False)], ["loan_type"])


def dpd_buckets(loans: DataFrame) -> DataFrame:
    """Active loans by days-past-due bucket."""
    agg = (loans.where(F.col("loan_status") == "Active")
           .withColumn("dpd_bucket", dpd_bucket("dpd_days"))
           .groupBy("dpd_bucket").agg(
               F.count("*").alias("accounts"),
               F.sum("loan_amount").alias("exposure_inr"),
               F.count("loan_amount").alias("_n")))
    out = agg.select("dpd_bucket", "accounts", "exposure_inr",
                     avg_round("exposure_inr", "_n", 0).alias("avg_exposure"))
    return sort_small(out, [("exposure_inr", False)], ["dpd_bucket"])


def dpd_buckets_pandas(loans: DataFrame) -> DataFrame:
    """The pandas flavour: no average column, first label without brackets."""
    agg = (loans.where(F.col("loan_status") == "Active")
           .withColumn("dpd_bucket", dpd_bucket("dpd_days", K.DPD_CURRENT_LABEL_PANDAS))
           .groupBy("dpd_bucket").agg(
               F.count("loan_id").alias("accounts"),
               F.sum("loan_amount").alias("exposure_inr")))
    return sort_small(agg, [("exposure_inr", False)], ["dpd_bucket"])


def for_years(loans: DataFrame, years: Sequence[int] | None) -> DataFrame:
    """Restrict loans to some disbursement years.  On the year-partitioned
    table this is a partition filter: other years' files are never listed."""
    return loans if years is None else loans.where(F.col("disbursement_year").isin(list(years)))


def vintage_default_rate(loans: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Stressed share per disbursement year (groups on the partition column)."""
    agg = for_years(loans, years).groupBy("disbursement_year").agg(
        F.count("*").alias("loans_disbursed"),
        F.sum(flag(stressed())).alias("stressed_accounts"),
        F.sum("loan_amount").alias("total_disbursed_inr"),
    )
    out = agg.select("disbursement_year", "loans_disbursed", "stressed_accounts",
                     pct("stressed_accounts", "loans_disbursed", 2).alias("default_rate_pct"),
                     "total_disbursed_inr")
    return sort_small(out, [("disbursement_year", True)])


def vintage_default_rate_pandas(loans: DataFrame) -> DataFrame:
    """The pandas flavour: column ``stressed``, rate rounded half-even on the double."""
    agg = loans.groupBy("disbursement_year").agg(
        F.count("*").alias("loans_disbursed"),
        F.count_if(stressed()).alias("stressed"),
        F.sum("loan_amount").alias("total_disbursed_inr"),
    )
    rate = F.col("stressed").cast("double") / F.col("loans_disbursed").cast("double") * 100
    out = agg.withColumn("default_rate_pct", half_even_double(rate, 2))
    return sort_small(out, [("disbursement_year", True)])


def high_risk_micro_segments(loans: DataFrame, customers: DataFrame,
                             max_score: int = K.HIGH_RISK_MAX_SCORE,
                             min_dpd: int = K.HIGH_RISK_MIN_DPD,
                             min_accounts: int = K.HIGH_RISK_MIN_ACCOUNTS,
                             limit: int | None = K.HIGH_RISK_LIMIT) -> DataFrame:
    """Active loans past ``min_dpd`` of customers scoring below ``max_score``,
    by (segment, employment type, customer state); groups of at least
    ``min_accounts`` loans, top ``limit`` by exposure.

    Both filters are pushed to their scans; the loan side is reduced to one
    row per customer before it meets the customer table.
    """
    per_customer = (loans.where((F.col("dpd_days") > min_dpd) & (F.col("loan_status") == "Active"))
                    .groupBy("customer_id").agg(
                        F.count("loan_id").alias("n_loans"),
                        F.count("*").alias("n_rows"),
                        F.sum("loan_amount").alias("amount"),
                        F.sum("dpd_days").alias("dpd_sum"),
                        F.count("dpd_days").alias("dpd_n")))
    risky = (customers.where(F.col("credit_score") < max_score)
             .select("customer_id", "segment", "employment_type", "state",
                     F.col("credit_score").cast("bigint").alias("score")))
    agg = per_customer.join(risky, "customer_id", "inner").groupBy(
        "segment", "employment_type", "state").agg(
        F.sum("n_loans").alias("high_risk_accounts"),
        F.sum("amount").alias("at_risk_exposure"),
        F.sum(F.col("n_rows") * F.col("score")).alias("_score_sum"),
        F.sum("n_rows").alias("_score_n"),
        F.sum("dpd_sum").alias("_dpd_sum"),
        F.sum("dpd_n").alias("_dpd_n"),
    )
    out = (agg.where(F.col("high_risk_accounts") >= min_accounts)
           .select("segment", "employment_type", "state", "high_risk_accounts", "at_risk_exposure",
                   avg_round("_score_sum", "_score_n", 0).alias("avg_credit_score"),
                   avg_round("_dpd_sum", "_dpd_n", 0).alias("avg_dpd")))
    return top_k(out, limit, [("at_risk_exposure", False)], ["segment", "employment_type", "state"])


def credit_score_bands(customers: DataFrame, mode: str = "half_up") -> DataFrame:
    """Customers per credit-score band and their share of all customers (the
    pandas flavour rounds ``half_even``).

    The denominator is an uncorrelated scalar subquery (run once, inlined).
    """
    total = total_as_scalar(customers, F.count("*"))
    agg = (customers.withColumn("score_band", score_band("credit_score"))
           .groupBy("score_band").agg(F.count("*").alias("customers")))
    out = agg.withColumn("pct_of_portfolio", pct("customers", total, 2, mode))
    return sort_small(out, [("customers", False)], ["score_band"])
