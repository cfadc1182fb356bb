"""Exact rounding of ratios and averages.

SQL ``ROUND(num * 100.0 / den, 2)`` evaluated in floating point rounds
differently across engines at half-cent ties (e.g. 46/8000 -> 0.575).  The
helpers here evaluate the rounding on the *exact* ratio of two integer-valued
columns — with BIGINT/double arithmetic while all intermediates stay below
2^51 (exact, see ``_floor_div_small``), with decimal(38,0) beyond — so the
result is engine independent, and only the final k / 10^scale step is
floating point (correctly rounded).

All helpers return NULL when the divisor is zero or NULL (the reports must not
fail under ANSI mode on an empty group).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor_div(a: Column, b: Column) -> Column:
    """floor(a / b) for exact non-negative a and positive b, in decimal(38,0).

    ``a - a % b`` is an exact multiple of ``b``, so the decimal division has no
    rounding error at all.
    """
    return ((a - a % b) / b).cast(_DEC)


def _floor_div_small(a: Column, b: Column) -> Column:
    """floor(a / b) for integers 0 <= a < 2^52, 0 < b, via one double division.

    a and b are exact doubles and the quotient is correctly rounded.  If
    a = q*b + r with 0 < r < b, the gap to q + 1 is (b - r)/b >= 1/b, while the
    rounding error is at most (a/b) * 2^-53 < 1/b because a < 2^53; so the
    rounded quotient never reaches q + 1 and floor gives q exactly.
    """
    return F.floor(a.cast("double") / b.cast("double"))


# Integral inputs below these bounds take the BIGINT/double path; anything
# larger falls back to exact decimal(38,0).
_SMALL = 2 ** 50


def _rounded(an: Column, ad: Column, factor: int, mode: str, floor_div) -> Column:
    """round(an * factor / ad) for non-negative an and positive ad."""
    a = an * (2 * factor) + ad
    b = ad * 2
    q_up = floor_div(a, b)  # half-up
    if mode == "half_up":
        return q_up
    if mode == "half_even":
        # a tie is an exact division of a by b; then step back to the even neighbour
        tie_odd = (a % b == 0) & (q_up % 2 == 1)
        return q_up - F.when(tie_odd, F.lit(1)).otherwise(F.lit(0))
    raise ValueError(f"unknown rounding mode {mode!r}")


def round_ratio(num: Column | str, den: Column | str | int, scale: int = 2,
                mode: str = "half_up", mult: int = 1) -> Column:
    """ROUND(num * mult / den, scale) on the exact rational value, as a double.

    ``num`` and ``den`` must be integer valued (counts, sums of BIGINT, money
    units).  ``mode`` is ``half_up`` (SQL ROUND: ties away from zero) or
    ``half_even`` (banker's rounding).  NULL when ``den`` is 0 or NULL.
    """
    return _round_ratio(_col(num), F.lit(den) if isinstance(den, int) else _col(den), scale, mode, mult)


def _round_ratio(num: Column, den: Column, scale: int, mode: str, mult: int) -> Column:
    factor = mult * 10 ** scale
    abs_num, abs_den = F.abs(num), F.abs(den)
    small = (abs_num <= _SMALL // (2 * factor)) & (abs_den <= _SMALL)
    fast = _rounded(abs_num.cast("long"), abs_den.cast("long"), factor, mode, _floor_div_small)
    exact = _rounded(abs_num.cast(_DEC), abs_den.cast(_DEC), factor, mode, _floor_div)
    q = F.when(small, fast.cast("double")).otherwise(exact.cast("double"))
    sign = F.when(((num < 0) & (den > 0)) | ((num > 0) & (den < 0)), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(den != 0, q / 10 ** scale * sign)


def pct(num: Column | str, den: Column | str, scale: int = 2,
        mode: str = "half_up") -> Column:
    """ROUND(num * 100 / den, scale) exactly (percentage of two integer columns)."""
    return round_ratio(num, den, scale, mode, mult=100)


def avg_round(total: Column | str, count: Column | str, scale: int = 0,
              mode: str = "half_up") -> Column:
    """ROUND(AVG(x), scale) from an exact SUM(x) and COUNT(x)."""
    return round_ratio(total, count, scale, mode)


# --- sums of money -------------------------------------------------------------
# Amounts are doubles.  They are summed as decimals of a millionth, in any row
# order the same; finer digits of a double (0.1 * 3) are noise of its binary form.
# The sum has 32 digits before the point.
_MONEY = "decimal(28,6)"
_UNIT = 10 ** 6


def money_parts(amount: Column | str) -> tuple[Column, Column, Column]:
    """Three aggregates of an amount: the exact sum, the sum of doubles, and
    whether an amount has no such decimal (NaN, infinite, beyond 1e22).  Partial
    results add up: sum, sum, and or."""
    x = _col(amount)
    exact = x.try_cast(_MONEY)
    return F.sum(exact), F.sum(x), F.bool_or(x.isNotNull() & exact.isNull())


def money_total(exact: Column, plain: Column, odd: Column, scale: int | None = None) -> Column:
    """SUM(amount) as a double, rounded half-up to ``scale`` if given; where an
    amount has no decimal, what a sum of doubles gives."""
    rounded = exact if scale is None else F.round(exact, scale)
    return F.when(odd, plain).otherwise(rounded.cast("double"))


def sum_money(amount: Column | str, scale: int | None = None) -> Column:
    """``money_total`` in one aggregation."""
    return money_total(*money_parts(amount), scale)


def avg_money(exact: Column | str, plain: Column | str, odd: Column | str, count: Column | str, scale: int = 2,
              mode: str = "half_up") -> Column:
    """ROUND(AVG(amount), scale) from columns of ``money_parts`` and COUNT(amount)."""
    units = (_col(exact) * F.lit(_UNIT)).cast(_DEC)
    exact_avg = round_ratio(units, _col(count).cast(_DEC) * F.lit(_UNIT), scale, mode)
    return F.when(_col(odd), _col(plain) / _col(count)).otherwise(exact_avg)


def half_even_double(x: Column | str, scale: int) -> Column:
    """pandas/numpy ``Series.round(scale)`` on a double: rint(x * 10^s) / 10^s."""
    p = 10 ** scale
    return F.bround(_col(x) * p, 0) / p
