"""Deterministic top-k.

``ORDER BY x DESC LIMIT k`` is ambiguous when x ties at the k-th row; the
reports add key columns as tie-breakers so every engine returns the same rows.
``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition keeps
its own k best rows and only those k x partitions rows meet in the final
merge, so the cost does not grow with the number of groups beyond one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_exprs(order: Sequence[tuple[str, bool]], tiebreak: Sequence[str] = ()) -> list[Column]:
    """Sort expressions with SQL's default null placement (ASC nulls first,
    DESC nulls last), followed by ascending tie-breakers."""
    out = []
    for name, ascending in order:
        out.append(F.col(name).asc_nulls_first() if ascending else F.col(name).desc_nulls_last())
    out.extend(F.col(t).asc_nulls_first() for t in tiebreak)
    return out


def top_k(df: DataFrame, k: int | None, order: Sequence[tuple[str, bool]],
          tiebreak: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows of ``df`` in ``order`` (all rows, sorted, if k is None)."""
    ordered = df.orderBy(*order_exprs(order, tiebreak))
    return ordered if k is None else ordered.limit(k)


def sort_small(df: DataFrame, order: Sequence[tuple[str, bool]],
               tiebreak: Sequence[str] = ()) -> DataFrame:
    """Total order of a result with a *bounded* number of rows (one row per
    category of a fixed vocabulary: loan types, states, hours, years).

    A global ``orderBy`` plans a range exchange, which first runs a sampling
    job over its input; for a few dozen aggregated rows gathering them into one
    partition and sorting there is cheaper.  Not for unbounded results.
    """
    return df.repartition(1).sortWithinPartitions(*order_exprs(order, tiebreak))
