"""Scalar column expressions (bucketing, exact rounding, formatting)."""

from riskloom.functions.buckets import (  # noqa: F401
    dpd_bucket, flag, is_in, large_amount_flag, off_hours, off_hours_list, pd_millis, pd_score,
    score_band, status_weights_e5, stressed,
)
from riskloom.functions.rounding import (  # noqa: F401
    avg_money, avg_round, half_even_double, money_parts, money_total, pct, round_ratio, sum_money,
)
