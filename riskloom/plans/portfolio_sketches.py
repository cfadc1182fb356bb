"""Sketches of the portfolio, kept per partition and merged.

A sketch row stands for the loans of one year and state: their number, an HLL sketch of the borrowers and a
KLL sketch of the amounts, some 40 kB whatever the number of loans.  Any report over years or states merges those rows
instead of reading loans again; a year that is loaded anew has its own rows replaced and no others.  Loans are
reduced to sketches map-side, so a state with a third of all loans sends one sketch per map task.

Borrowers of merged sketches are off by ``HLL_ERROR`` (standard error), the rank of a quantile by ``KLL_ERROR`` in 99 of 100
cases; ``sketch_audit`` holds kept sketches against exact figures.  A null borrower or amount is in no sketch;
null years and states are groups of their own; no loans give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HLL_LG_K = 14
KLL_K = 800
HLL_ERROR = 1.04 / 2 ** (HLL_LG_K / 2)
KLL_ERROR = 2.296 / KLL_K ** 0.9021  # of a rank, as a share of all rows
KEPT = ("disbursement_year", "state")
SKETCHED = ("loans", "borrower_sketch", "amount_sketch")


def sketches(loans: DataFrame) -> DataFrame:
    """One row per year and state: loans, borrower_sketch, amount_sketch."""
    return loans.groupBy(*KEPT).agg(
        F.count(F.lit(1)).alias("loans"), F.hll_sketch_agg("customer_id", HLL_LG_K).alias("borrower_sketch"),
        F.kll_sketch_agg_bigint("loan_amount", KLL_K).alias("amount_sketch"))


def keep(loans: DataFrame, path: str) -> DataFrame:
    """Sketch ``loans`` into the table at ``path``: the years that occur in them are replaced, others stay.
    A run that is repeated, or a task that is, gives the same table."""
    made = sketches(loans).repartition("disbursement_year")
    made.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("disbursement_year").parquet(path)
    return loans.sparkSession.read.schema(made.schema).parquet(path).select(*KEPT, *SKETCHED)


def merge(kept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows per ``by``; can be merged further."""
    return kept.groupBy(*by).agg(F.sum("loans").alias("loans"), F.hll_union_agg("borrower_sketch").alias("borrower_sketch"),
                                 F.kll_merge_agg_bigint("amount_sketch").alias("amount_sketch"))


def estimates(merged: DataFrame, percents: Sequence[int] = (50, 95)) -> DataFrame:
    """The columns before the sketches, then borrowers and p<percent>_amount."""
    named = [c for c in merged.columns if c not in SKETCHED[1:]]
    some = F.kll_sketch_get_n_bigint("amount_sketch") > 0  # no quantile of nothing
    return merged.select(*named, F.hll_sketch_estimate("borrower_sketch").alias("borrowers"),
                         *[F.when(some, F.kll_sketch_get_quantile_bigint("amount_sketch", F.lit(p / 100))).alias(f"p{p}_amount") for p in percents])


def sketch_audit(loans: DataFrame, kept: DataFrame, percents: Sequence[int] = (50, 95)) -> DataFrame:
    """Per year the exact number of loans and borrowers, and whether the merged sketches tell the borrowers
    within four standard errors and each percentile within three times its error of rank."""
    told = estimates(merge(kept, ["disbursement_year"]), percents).withColumnsRenamed({"disbursement_year": "y", "loans": "told_loans", "borrowers": "told"})
    per = loans.groupBy("disbursement_year", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    exact = per.groupBy("disbursement_year").agg(F.sum("n").alias("loans"), F.count("customer_id").alias("borrowers"))
    # values below and up to each estimate; the estimates are one row per year
    year = F.col("disbursement_year").eqNullSafe(F.col("y"))
    sides = loans.join(told.select("y", *[f"p{p}_amount" for p in percents]), year).groupBy(F.col("y").alias("ry")).agg(
        F.count("loan_amount").alias("n"),
        *[F.count_if(F.col("loan_amount") < F.col(f"p{p}_amount")).alias(f"below{p}") for p in percents],
        *[F.count_if(F.col("loan_amount") <= F.col(f"p{p}_amount")).alias(f"upto{p}") for p in percents])
    met = exact.join(told.select("y", "told_loans", "told"), year).join(sides, F.col("y").eqNullSafe(F.col("ry")))
    slack = 3 * KLL_ERROR
    return met.select(
        "disbursement_year", "loans", "borrowers", (F.col("told_loans") == F.col("loans")).alias("loans_kept"),
        (F.abs(F.col("told") - F.col("borrowers")) <= 4 * HLL_ERROR * F.col("borrowers")).alias("borrowers_within"),
        *[((F.col("n") == 0) | (F.col(f"below{p}") <= (p / 100 + slack) * F.col("n")) & (F.col(f"upto{p}") >= (p / 100 - slack) * F.col("n"))).alias(f"p{p}_within")
          for p in percents])
