"""Probability-of-default curve and the status mix it implies.

The PD curve (clamp((850 - score) / 1000, 0.02, 0.45), unknown borrower =>
score 650) and the status weights that depend on it are applied to the real
portfolio as column expressions: per borrower (``pd_by_customer``) and as
expected loans per status for each loan type (``expected_status_mix``).
Weights are integers in units of 1e-5 and each loan's normalised share is
fixed to 1e-9 units with integer rounding, so the sums are exact and engine
independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import pd_millis, pd_score, round_ratio, status_weights_e5
from riskloom.functions.rounding import _floor_div_small
from riskloom.operators.topk import sort_small

_SCALE = 10 ** 9


def pd_by_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "credit_score", pd_score("credit_score").alias("pd"))


def _status_col(status: str) -> str:
    return "expected_" + status.lower().replace("-", "_")


def expected_status_mix(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """Expected number of loans per status for each loan type, from each
    loan's PD (loans LEFT JOIN customers; unknown customers use the default
    score).

    Customers are reduced to one row per id and score, so a duplicated customer
    multiplies a loan's count as the row-level left join does.  The joined
    loans are counted per loan type and PD right away: the rows that carry
    weights are a few thousand at most, and their arithmetic is decimal.
    """
    scores = customers.groupBy("customer_id", "credit_score").agg(F.count("*").alias("copies"))
    joined = loans.select("customer_id", "loan_type").join(scores, "customer_id", "left")
    counted = joined.select("loan_type", pd_millis("credit_score").alias("pd_m"), "copies").groupBy("loan_type", "pd_m").agg(
        F.sum(F.coalesce("copies", F.lit(1)).cast("decimal(20,0)")).alias("n"))
    w = status_weights_e5(F.col("pd_m"))
    total = w[0] + w[1] + w[2] + w[3] + w[4] + w[5]
    # w < 2^17 and total < 2^18, so w * 2e9 + total < 2^52: the exact
    # double-division floor applies to a loan's share
    parts = [
        (_floor_div_small(wi.cast("long") * (2 * _SCALE) + total, total.cast("long") * 2).cast("decimal(10,0)")
         * F.col("n").cast("decimal(28,0)")).cast("decimal(38,0)").alias(f"_u{i}")
        for i, wi in enumerate(w)
    ]
    agg = counted.select("loan_type", "n", *parts).groupBy("loan_type").agg(
        F.sum("n").cast("long").alias("loans"),
        *[F.sum(f"_u{i}").alias(f"_s{i}") for i in range(len(w))],
    )
    return agg.select(
        "loan_type", "loans",
        *[round_ratio(f"_s{i}", _SCALE, 2).alias(_status_col(s))
          for i, s in enumerate(K.LOAN_STATUSES)],
    ).transform(lambda df: sort_small(df, [("loan_type", True)]))
