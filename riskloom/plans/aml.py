"""AML and fraud rules over transactions.

Transactions are the largest table, so every rule aggregates them with
map-side partial aggregation before anything else: a loan with a third of
all transactions becomes one partial row per map task.  Money sums are exact
decimals (``functions.rounding``), so they do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.functions import (avg_money, half_even_double, large_amount_flag, money_parts, money_total, off_hours, off_hours_list, pct,
                                sum_money)
from riskloom.operators.topk import sort_small, top_k
from riskloom.session import materialize


def _suspicious_cash(txns: DataFrame, min_amount: float) -> DataFrame:
    return txns.where((F.col("is_suspicious_flag") == 1)
                      & (F.col("transaction_type") == "Cash_Withdrawal")
                      & (F.col("amount") > min_amount))


def aml_structuring(txns: DataFrame, loans: DataFrame, customers: DataFrame,
                    min_amount: float = K.AML_MIN_AMOUNT, min_txns: int = K.AML_MIN_TXNS,
                    limit: int | None = K.AML_LIMIT) -> DataFrame:
    """Loans with at least ``min_txns`` flagged cash withdrawals above
    ``min_amount``, with the borrower's state and segment; top ``limit`` by
    flagged amount.

    Plan: filter (pushed into the scan) -> partial aggregate per
    (loan, month) -> join loans -> join customers -> final aggregate on the
    report key.  Only flagged rows, already reduced, ever reach a join, and the
    result equals the row-level three-way join for any key multiplicity.

    The flagged aggregate and its join with loans are normally tiny while loans
    and customers are the largest dimensions.  Both are written as intermediate
    tables, so the planner chooses each join by their real size on disk:
    a broadcast hash join under ``autoBroadcastJoinThreshold``, which streams the
    dimension without shuffling it, else a shuffle join with skew handling.
    """
    exact, plain, odd = money_parts("amount")
    per_month = materialize(_suspicious_cash(txns, min_amount).groupBy("loan_id", "transaction_month").agg(
        F.count("*").alias("n"), exact.alias("exact"), plain.alias("plain"), odd.alias("odd"),
        F.max("amount").alias("mx"),
    ), "flagged")
    with_loan = materialize(per_month.join(loans.select("loan_id", "customer_id"), "loan_id", "inner"), "flagged-loans")
    joined = with_loan.join(customers.select("customer_id", "state", "segment"), "customer_id", "inner")
    agg = joined.groupBy("loan_id", "customer_id", "state", "segment").agg(
        F.sum("n").alias("suspicious_txn_count"),
        money_total(F.sum("exact"), F.sum("plain"), F.bool_or("odd")).alias("total_suspicious_amount"),
        F.max("mx").alias("max_single_txn"),
        F.countDistinct("transaction_month").alias("months_active"),
    )
    out = agg.where(F.col("suspicious_txn_count") >= min_txns)
    return top_k(out, limit, [("total_suspicious_amount", False)],
                 ["loan_id", "customer_id", "state", "segment"])


def aml_structuring_txn_only(txns: DataFrame, min_amount: float = K.AML_MIN_AMOUNT,
                             min_txns: int = K.AML_MIN_TXNS,
                             limit: int | None = K.AML_TXN_ONLY_LIMIT) -> DataFrame:
    """The pandas flavour: no joins, so transactions of unknown loans stay in."""
    agg = _suspicious_cash(txns, min_amount).groupBy("loan_id").agg(
        F.count("transaction_id").alias("suspicious_txn_count"),
        sum_money("amount").alias("total_suspicious_amount"),
        F.max("amount").alias("max_single_txn"),
    )
    out = agg.where(F.col("suspicious_txn_count") >= min_txns)
    return top_k(out, limit, [("total_suspicious_amount", False)], ["loan_id"])


def _off_hours_report(txns: DataFrame, predicate) -> DataFrame:
    agg = txns.where(predicate).groupBy("transaction_hour").agg(
        F.count("*").alias("txn_count"),
        sum_money("amount", 2).alias("total_amount"),
        F.sum("is_suspicious_flag").alias("suspicious_count"),
    )
    out = agg.withColumn("suspicion_rate_pct", pct("suspicious_count", "txn_count", 2))
    return sort_small(out, [("suspicion_rate_pct", False)], ["transaction_hour"])


def aml_off_hours(txns: DataFrame, start: int = K.OFF_HOURS_START,
                  end: int = K.OFF_HOURS_END) -> DataFrame:
    """Activity per hour inside the off-hours window, filtered by the explicit
    hour list (pushed down to the scan as an IN filter)."""
    return _off_hours_report(txns, F.col("transaction_hour").isin(off_hours_list(start, end)))


def aml_off_hours_window(txns: DataFrame, start: int = K.OFF_HOURS_START,
                         end: int = K.OFF_HOURS_END) -> DataFrame:
    """The same report with the window as a wrap-around range predicate
    (hour >= start OR hour <= end) instead of a list."""
    return _off_hours_report(txns, off_hours("transaction_hour", start, end))


def aml_reversals(txns: DataFrame, min_rate: float = K.REVERSAL_MIN_RATE,
                  min_txns: int = K.REVERSAL_MIN_TXNS, limit: int | None = K.REVERSAL_LIMIT) -> DataFrame:
    """Loans whose (rounded) reversal rate exceeds ``min_rate`` % over at least
    ``min_txns`` transactions; top ``limit`` by rate."""
    agg = txns.groupBy("loan_id").agg(
        F.count("*").alias("total_txns"),
        F.sum("reversal_flag").alias("reversal_count"),
        sum_money("amount").alias("gross_volume"),
    )
    out = (agg.withColumn("reversal_rate_pct", pct("reversal_count", "total_txns", 2))
           .where((F.col("reversal_rate_pct") > min_rate) & (F.col("total_txns") >= min_txns))
           .select("loan_id", "total_txns", "reversal_count", "reversal_rate_pct", "gross_volume"))
    return top_k(out, limit, [("reversal_rate_pct", False)], ["loan_id"])


def _amounts() -> list[Column]:
    exact, plain, odd = money_parts("amount")
    return [exact.alias("_exact"), plain.alias("_plain"), odd.alias("_odd"), F.count("amount").alias("_n")]


def channel_risk(txns: DataFrame) -> DataFrame:
    """Suspicious share and average amount per channel."""
    agg = txns.groupBy("channel").agg(
        F.count("*").alias("total_transactions"),
        F.sum("is_suspicious_flag").alias("suspicious_transactions"),
        *_amounts(),
    )
    out = agg.select("channel", "total_transactions", "suspicious_transactions",
                     avg_money("_exact", "_plain", "_odd", "_n", 2).alias("avg_txn_amount"),
                     pct("suspicious_transactions", "total_transactions", 2).alias("suspicion_rate_pct"))
    return sort_small(out, [("suspicion_rate_pct", False)], ["channel"])


def channel_risk_pandas(txns: DataFrame) -> DataFrame:
    """The pandas flavour: columns total_txns / suspicious / avg_amount, half-even rounding."""
    agg = txns.groupBy("channel").agg(
        F.count("transaction_id").alias("total_txns"),
        F.sum("is_suspicious_flag").alias("suspicious"),
        *_amounts(),
    )
    out = agg.select("channel", "total_txns", "suspicious",
                     avg_money("_exact", "_plain", "_odd", "_n", 2, "half_even").alias("avg_amount"),
                     half_even_double(F.col("suspicious").cast("double")
                                      / F.col("total_txns").cast("double") * 100, 2)
                     .alias("suspicion_rate_pct"))
    return sort_small(out, [("suspicion_rate_pct", False)], ["channel"])


def large_amount_by_channel(txns: DataFrame, limit: float = K.LARGE_AMOUNT) -> DataFrame:
    """Transactions over ``limit`` per channel, and how many of those are flagged
    as suspicious."""
    large = large_amount_flag("amount", limit)
    agg = txns.groupBy("channel").agg(
        F.count("*").alias("total_txns"), F.sum(large).alias("large_txns"),
        F.sum(large * F.col("is_suspicious_flag")).alias("large_suspicious"))
    out = agg.withColumn("large_share_pct", pct("large_txns", "total_txns", 2))
    return sort_small(out, [("large_share_pct", False)], ["channel"])
