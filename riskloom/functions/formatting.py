"""Display formatting of report values (KRI feed).

The inputs are exact: amounts in whole units or values that hold exact
hundredths (see ``rounding``), so formatting never has to round again.
NULL stays NULL (Java's formatter would print a truncated "null").
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom import constants as K


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed2(x: Column | str) -> Column:
    """A number with exactly two decimals, e.g. 4.9 -> '4.90'."""
    c = _col(x)
    return F.when(c.isNotNull(), F.format_string("%.2f", c))


def percent2(x: Column | str) -> Column:
    """'4.94%'."""
    return F.concat(fixed2(x), F.lit("%"))


def rupees_billions(x_billions: Column | str) -> Column:
    """An amount already expressed in billions: '₹126.33B'."""
    return F.concat(F.lit(K.RUPEE), fixed2(x_billions), F.lit("B"))


def rupees_grouped(x: Column | str) -> Column:
    """A whole amount with thousands separators: '₹2,526,512'."""
    return F.concat(F.lit(K.RUPEE), F.format_number(_col(x), 0))
