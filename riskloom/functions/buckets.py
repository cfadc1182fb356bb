"""Column expressions for the risk vocabulary (bucketing, flags, PD curve).

Everything is a built-in Catalyst expression (CASE WHEN chains, IN lists), so
it stays inside whole-stage codegen; nothing here is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_in(c: Column | str, values: Sequence[str]) -> Column:
    return _col(c).isin(list(values))


def stressed(status: Column | str = "loan_status",
             statuses: Sequence[str] = K.STRESSED_STATUSES) -> Column:
    """Boolean: the loan is in one of the stressed statuses."""
    return is_in(status, statuses)


def flag(cond: Column) -> Column:
    """1/0 integer of a boolean condition (NULL counts as 0, like CASE WHEN)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def dpd_bucket(dpd: Column | str = "dpd_days", current_label: str = K.DPD_CURRENT_LABEL) -> Column:
    """Days-past-due bucket; dpd = 0 is current, NULL falls through to the last bucket."""
    d = _col(dpd)
    expr = F.when(d == 0, F.lit(current_label))
    for bound, label in K.DPD_BUCKETS:
        expr = expr.when(d <= bound, F.lit(label))
    return expr.otherwise(F.lit(K.DPD_OVERFLOW_LABEL))


def score_band(score: Column | str = "credit_score") -> Column:
    """Credit-score band; NULL scores fall to the lowest band."""
    s = _col(score)
    expr = None
    for bound, label in K.SCORE_BANDS:
        expr = F.when(s >= bound, F.lit(label)) if expr is None else expr.when(s >= bound, F.lit(label))
    return expr.otherwise(F.lit(K.SCORE_FLOOR_LABEL))


def off_hours(hour: Column | str = "transaction_hour",
              start: int = K.OFF_HOURS_START, end: int = K.OFF_HOURS_END) -> Column:
    """Wrap-around hour window [start, 24) U [0, end] (start > end), inclusive."""
    h = _col(hour)
    if start > end:
        return (h >= start) | ((h >= 0) & (h <= end))
    return h.between(start, end)


def off_hours_list(start: int = K.OFF_HOURS_START, end: int = K.OFF_HOURS_END) -> list[int]:
    """The same window as an explicit IN list of hours (what the report filters on)."""
    if start > end:
        return list(range(start, 24)) + list(range(0, end + 1))
    return list(range(start, end + 1))


def large_amount_flag(amount: Column | str = "amount", threshold: float = K.LARGE_AMOUNT) -> Column:
    """1 when a transaction is above the large-amount threshold, else 0
    (the deterministic part of the suspicious-transaction rule)."""
    return flag(_col(amount) > threshold)


def pd_millis(score: Column | str = "credit_score") -> Column:
    """Probability of default in thousandths: clamp(anchor - score, 20, 450).

    An unknown (NULL) score is taken as the fixed default score.
    """
    s = F.coalesce(_col(score), F.lit(K.PD_UNKNOWN_SCORE))
    lo, hi = round(K.PD_FLOOR * 1000), round(K.PD_CAP * 1000)
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.lit(K.PD_SCORE_ANCHOR) - s)).cast("int")


def pd_score(score: Column | str = "credit_score") -> Column:
    """Probability of default as a double: clamp((850 - score) / 1000, 0.02, 0.45)."""
    return pd_millis(score).cast("double") / 1000


def status_weights_e5(pd_m: Column) -> list[Column]:
    """Un-normalised status weights for a PD in thousandths, in units of 1e-5.

    Order follows ``LOAN_STATUSES``: 0.50, 0.25, 0.6p, 0.25p, 0.1p,
    max(0.01, 0.05 - 0.05p).  Integer arithmetic keeps them exact.
    """
    return [
        F.lit(50000),
        F.lit(25000),
        pd_m * 60,
        pd_m * 25,
        pd_m * 10,
        F.greatest(F.lit(1000), F.lit(5000) - pd_m * 5),
    ]
