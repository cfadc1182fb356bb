"""Window analytics: rolling default trend, customer risk ranking, vintage YoY."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import flag, is_in, pct, round_ratio, stressed
from riskloom.operators.ranking import global_rank
from riskloom.operators.topk import order_exprs, sort_small, top_k
from riskloom.plans.common import customer_scores
from riskloom.plans.credit import for_years
from riskloom.session import materialize


def rolling_3m_defaults(loans: DataFrame, rows: int = K.ROLLING_ROWS,
                        years: Sequence[int] | None = None) -> DataFrame:
    """Per disbursement (year, month): new loans, defaults (Default/NPA), and
    the average of defaults over the current and ``rows - 1`` preceding
    *rows* (months without loans are not filled in).

    The window has no PARTITION BY, but it runs on the aggregated calendar
    (one row per year-month), never on loans.  ``years`` restricts the input
    (a partition filter on the year-partitioned table).
    """
    agg = for_years(loans, years).groupBy("disbursement_year", "disbursement_month").agg(
        F.count("*").alias("new_loans"),
        F.sum(flag(is_in("loan_status", K.DEFAULT_STATUSES))).alias("defaults"),
    )
    w = (Window.orderBy(F.col("disbursement_year").asc_nulls_first(),
                        F.col("disbursement_month").asc_nulls_first())
         .rowsBetween(-(rows - 1), Window.currentRow))
    out = agg.withColumn("rolling_3m_avg_defaults",
                         round_ratio(F.sum("defaults").over(w), F.count("defaults").over(w), 2))
    return sort_small(out, [("disbursement_year", True), ("disbursement_month", True)])


def vintage_yoy(loans: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Stressed rate per disbursement year against the previous year's row
    (the previous row among the selected ``years``, as LAG does)."""
    agg = for_years(loans, years).groupBy("disbursement_year").agg(
        pct(F.sum(flag(stressed())), F.count("*"), 2).alias("default_rate_pct"))
    w = Window.orderBy(F.col("disbursement_year").asc_nulls_first())
    # the rates are exact hundredths: difference them as integers
    hundredths = F.round(F.col("default_rate_pct") * 100).cast("long")
    out = agg.select(
        "disbursement_year",
        "default_rate_pct",
        F.lag("default_rate_pct", 1).over(w).alias("prev_year_rate"),
        ((hundredths - F.lag(hundredths, 1).over(w)).cast("double") / 100).alias("yoy_change_pp"),
    )
    return sort_small(out, [("disbursement_year", True)])


def customer_exposure(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per borrower: exposure, credit score, stressed loans, mean DPD.

    Both sides are reduced to one row per customer_id before the join, so the
    join is 1:1 and both reductions shuffle on the join key the join needs
    anyway.  The copies count of the customer side reproduces exactly what a
    row-level join does with a duplicated customer_id.
    """
    per_customer = loans.groupBy("customer_id").agg(
        F.sum("loan_amount").alias("amount"),
        F.sum(flag(stressed())).alias("n_stressed"),
        F.sum("dpd_days").alias("dpd_sum"),
        F.count("dpd_days").alias("dpd_n"),
    )
    joined = per_customer.join(customer_scores(customers), "customer_id", "inner")
    return joined.select(
        "customer_id",
        (F.col("amount") * F.col("n_copies")).alias("total_exposure"),
        (F.col("score_sum").cast("double") / F.col("score_n").cast("double")).alias("credit_score"),
        (F.col("n_stressed") * F.col("n_copies")).alias("default_count"),
        (F.col("dpd_sum").cast("double") / F.col("dpd_n").cast("double")).alias("dpd_avg"),
    )


def _risk_rank_of_head(head: DataFrame) -> DataFrame:
    """RANK by credit score over the lowest-score rows: every row with a
    strictly lower score than a selected row is itself selected, so the rank
    over the selection equals the rank over all rows."""
    w = Window.orderBy(*order_exprs([("credit_score", True)]))
    return head.withColumn("risk_rank", F.rank().over(w).cast("long"))


def customer_risk_ranking(loans: DataFrame, customers: DataFrame,
                          limit: int | None = K.RANKING_LIMIT, tiles: int = K.DECILES,
                          num_partitions: int | None = None) -> DataFrame:
    """Borrowers ranked by exposure (RANK, NTILE deciles) and by credit score
    (RANK, lowest score first); the ``limit`` lowest risk ranks.

    Exposure rank and decile are global: the distributed ``global_rank`` numbers
    all borrowers by exposure.  The risk rank of a report with a ``limit`` is
    taken on its rows (every borrower with a strictly lower score than a
    selected one is selected too, so the rank over the selection is the global
    rank); for every borrower (``limit=None``) a second ``global_rank`` gives
    it.  Ties are broken by customer_id (for the limit and for NTILE); no
    single-partition window runs over borrowers.
    """
    # the range exchange samples its input: written once, so that the join runs once
    per_customer = materialize(customer_exposure(loans, customers), "customer-exposure")
    ranked = global_rank(per_customer, [("total_exposure", False)], ["customer_id"],
                         rank_col="exposure_rank", ntile=tiles, ntile_col="exposure_decile",
                         num_partitions=num_partitions)
    if limit is None:
        ranked = global_rank(ranked, [("credit_score", True)], ["customer_id"],
                             rank_col="risk_rank", num_partitions=num_partitions)
    else:
        ranked = _risk_rank_of_head(top_k(ranked, limit, [("credit_score", True)], ["customer_id"]))
    out = ranked.select("customer_id", "total_exposure", "credit_score", "default_count", "dpd_avg",
                        "exposure_rank", "risk_rank", "exposure_decile")
    return top_k(out, None, [("risk_rank", True)], ["customer_id"])
