"""Share-of-total over grouped results.

Two forms, matching the two SQL constructs of the reports:

* ``share_of_total_window``: ``SUM(SUM(x)) OVER ()`` on an *already
  aggregated* frame.  The window has no PARTITION BY, so Spark moves the
  aggregated rows to one partition; that is only acceptable because the input
  holds one row per category of a bounded vocabulary (loan types, states,
  bands).  Never use it on a fact table.
* ``total_as_scalar``: an uncorrelated scalar subquery (``DataFrame.scalar``).
  Spark runs it once as its own job and inlines the single value, so nothing
  is joined, crossed or moved to one partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grand_total(col: str) -> Column:
    """SUM(col) OVER () — for frames with a bounded number of rows only."""
    return F.sum(col).over(Window.partitionBy())


def total_as_scalar(df: DataFrame, agg: Column) -> Column:
    """One aggregate over ``df`` as a scalar-subquery column."""
    return df.agg(agg).scalar()
