"""Event-time reports over transactions with ``txn_time`` (see ``operators.temporal``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import constants as K
from riskloom.operators.temporal import asof_join, interval_join, sessions

DAY = 86_400


def withdrawals(txns: DataFrame) -> DataFrame:
    return txns.where(F.col("transaction_type") == "Cash_Withdrawal")


def _seconds(later: Column, earlier: Column) -> Column:
    return F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))


def withdrawal_loan_state(txns: DataFrame, slice_rows: int = 1_000_000) -> DataFrame:
    """Every cash withdrawal with the last event of its loan up to then (as-of join)
    and the whole hours since."""
    events = txns.where(F.col("transaction_type").isin(list(K.STATE_EVENTS))).select(
        "loan_id", "transaction_id", "transaction_type", F.col("txn_time").alias("event_time"))
    found = asof_join(withdrawals(txns).select("transaction_id", "loan_id", "txn_time", "amount"), events, ["loan_id"], "txn_time", "event_time",
                      {"transaction_type": "last_event", "event_time": "event_time"}, tie=["transaction_id"], slice_rows=slice_rows)
    return found.select("transaction_id", "loan_id", "amount", "last_event",
                        F.floor(_seconds(F.col("txn_time"), F.col("event_time")) / 3600).alias("hours_since"))


def early_flagged_withdrawals(loans: DataFrame, txns: DataFrame, days: int = K.EARLY_WITHDRAWAL_DAYS) -> DataFrame:
    """Flagged cash withdrawals within ``days`` days of the month in which the loan
    was disbursed (interval join)."""
    drawn = loans.select("loan_id", "loan_type", F.make_date("disbursement_year", "disbursement_month", F.lit(1)).cast("timestamp_ntz").alias("drawn"))
    flagged = withdrawals(txns).where("is_suspicious_flag = 1")
    found = interval_join(drawn, flagged, ["loan_id"], "drawn", "txn_time", 0, days * DAY,
                          {"transaction_id": "transaction_id", "amount": "amount", "txn_time": "txn_time"})
    return found.select("loan_id", "loan_type", "transaction_id", "amount",
                        F.floor(_seconds(F.col("txn_time"), F.col("drawn")) / DAY).alias("days_after"))


def withdrawal_bursts(txns: DataFrame, gap_days: int = K.BURST_GAP_DAYS, min_txns: int = K.BURST_MIN_TXNS) -> DataFrame:
    """Sessions of cash withdrawals per loan with no gap over ``gap_days`` days."""
    found = sessions(withdrawals(txns), ["loan_id"], "txn_time", gap_days * DAY, {"total": F.col("amount").cast("decimal(32,6)")})
    return found.where(F.col("events") >= min_txns).select(
        "loan_id", F.to_date("session_start").alias("first_day"), F.to_date("session_end").alias("last_day"),
        F.col("events").alias("txns"), F.col("total").cast("double").alias("total_amount"))


def _windows(txns: DataFrame, window_days: int, step_days: int, min_txns: int) -> DataFrame:
    windows = F.window("txn_time", f"{window_days} days", f"{step_days} days")
    counted = withdrawals(txns).groupBy("loan_id", windows.alias("w")).agg(
        F.count(F.lit(1)).alias("txns"), F.sum(F.col("amount").cast("decimal(32,6)")).alias("total"))
    return counted.where(F.col("txns") >= min_txns).select(
        "loan_id", F.to_date("w.start").alias("window_start"), "txns", F.col("total").cast("double").alias("total_amount"))


def structuring_windows(txns: DataFrame, window_days: int = K.WINDOW_DAYS, step_days: int = K.WINDOW_STEP_DAYS,
                        min_txns: int = K.WINDOW_MIN_TXNS) -> DataFrame:
    """Loans with at least ``min_txns`` cash withdrawals within a sliding window."""
    return _windows(txns, window_days, step_days, min_txns)


def structuring_windows_running(txns: DataFrame, delay: str = "2 days", window_days: int = K.WINDOW_DAYS,
                                step_days: int = K.WINDOW_STEP_DAYS, min_txns: int = K.WINDOW_MIN_TXNS) -> DataFrame:
    """``structuring_windows`` of a stream.  A window's row comes out once, when the latest time seen is more
    than ``delay`` past its end; its state is then dropped.  A row that comes later still counts in
    the windows that are open, and is left out of those that are not."""
    return _windows(txns.withWatermark("txn_time", delay), window_days, step_days, min_txns)


def withdrawal_bursts_running(txns: DataFrame, delay: str = "2 days", gap_days: int = K.BURST_GAP_DAYS,
                              min_txns: int = K.BURST_MIN_TXNS) -> DataFrame:
    """``withdrawal_bursts`` of a stream: a session's row comes out once, when the latest time seen
    is more than the gap and ``delay`` past its last event; later rows begin anew."""
    # a session window ends before last event + gap; one microsecond more keeps an exact gap inside
    window = F.session_window("txn_time", f"{gap_days} days 1 microsecond")
    counted = withdrawals(txns.withWatermark("txn_time", delay)).groupBy("loan_id", window.alias("w")).agg(
        F.max("txn_time").alias("last"), F.count(F.lit(1)).alias("txns"), F.sum(F.col("amount").cast("decimal(32,6)")).alias("total"))
    return counted.where(F.col("txns") >= min_txns).select(
        "loan_id", F.to_date("w.start").alias("first_day"), F.to_date("last").alias("last_day"), "txns", F.col("total").cast("double").alias("total_amount"))
