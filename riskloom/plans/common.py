"""Building blocks shared by several reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customer_scores(customers: DataFrame) -> DataFrame:
    """One row per customer_id: number of customer rows with that id, and the
    sum and count of their credit scores.

    Joining this instead of the raw customer rows keeps a join 1:1 while
    reproducing exactly what a row-level join does with duplicated ids (every
    copy multiplies the loan-side sums, averages run over all copies).
    """
    return customers.groupBy("customer_id").agg(
        F.count("*").alias("n_copies"),
        F.sum("credit_score").alias("score_sum"),
        F.count("credit_score").alias("score_n"),
    )
