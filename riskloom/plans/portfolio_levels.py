"""Concentration at every level, exposure percentiles, and changes between two loads."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.quantiles import exact_percentiles
from riskloom.operators.snapshots import changes

LEVELS = ("state", "loan_type", "loan_status")
PERCENTS = (50, 90, 95, 99)


def concentration_cube(loans: DataFrame) -> DataFrame:
    """Loans, exposure and distinct borrowers for every combination of state, product and status, and
    for every total over some of them (``level``: the grouping id, a bit per column left out).

    Loans are first reduced to one row per borrower and full combination, so the expansion to the
    eight levels runs over those; a borrower is counted once per level by a second grouping.
    """
    reduced = loans.groupBy("customer_id", *LEVELS).agg(F.count(F.lit(1)).alias("n"), F.sum("loan_amount").alias("amount"))
    sets = [[*kept, F.col("customer_id")] for size in range(len(LEVELS) + 1) for kept in combinations(map(F.col, LEVELS), size)]
    levelled = reduced.groupingSets(sets, *LEVELS, "customer_id").agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount"), F.grouping_id().alias("g"))
    # customer_id, in every set, has the last bit
    per = levelled.withColumn("level", F.floor(F.col("g") / 2).cast("int"))
    return per.groupBy("level", *LEVELS).agg(
        F.sum("n").alias("total_loans"), F.sum("amount").cast("long").alias("exposure_inr"), F.count("customer_id").alias("borrowers"))


def exposure_percentiles(loans: DataFrame) -> DataFrame:
    """Loan amount percentiles per state, exact."""
    found = exact_percentiles(loans, ["state"], "loan_amount", PERCENTS)
    return found.select("state", F.col("n").alias("loans"), *[F.col(f"p{p}").alias(f"p{p}_amount") for p in PERCENTS])


def earlier_load(loans: DataFrame) -> DataFrame:
    """The portfolio as a load before the last year of disbursement would hold it: that year's loans are not there, defaults
    were still active, and loans written off since are there under a branch that was closed."""
    last = loans.agg(F.max("disbursement_year").alias("last")).scalar()  # a scalar subquery
    was = loans.where(F.col("disbursement_year") < last)
    status = F.when((F.col("loan_status") == "Default") & (F.col("dpd_days") <= 90), "Active").otherwise(F.col("loan_status"))
    branch = F.when(F.col("loan_status") == "Written-Off", "BR0000").otherwise(F.col("branch_code"))
    return was.withColumn("loan_status", status).withColumn("branch_code", branch).select(*loans.columns)


def portfolio_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Loans that came, went or changed between two loads, per loan."""
    return changes(old, new, ["loan_id"])
