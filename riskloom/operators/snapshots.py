"""What changed between two loads of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiset_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of either load that the other lacks, with ``copies``: how many more
    ``new`` (positive) or ``old`` (negative) has.  Null equals null; rows that repeat count each.

    One pass: both loads are counted together, map-side first, so equal rows shrink before
    the shuffle, and no side is broadcast or sorted against the other.
    """
    both = new.select(*old.columns).withColumn("copies", F.lit(1).cast("long")).union(old.withColumn("copies", F.lit(-1).cast("long")))
    return both.groupBy(*[F.col(f"`{c}`") for c in old.columns]).agg(F.sum("copies").alias("copies")).filter("copies <> 0")


def changes(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per ``key`` whose rows differ: key, change ('insert', 'delete' or 'update'), rows_before and
    rows_after (differing rows of the old and new load, repeats counted), changed (names of the columns
    whose values differ, sorted; for an update of one row each).

    A key that stands on both sides of the difference is an update, even if the number of its rows changed.
    """
    diff = multiset_difference(old, new)
    rest = [c for c in old.columns if c not in key]
    before, after = F.col("copies") < 0, F.col("copies") > 0
    agg = diff.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(before, -F.col("copies"))), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.when(after, F.col("copies"))), F.lit(0)).alias("rows_after"),
        F.max(F.when(before, F.struct(*rest))).alias("was"), F.max(F.when(after, F.struct(*rest))).alias("is"))
    one = (F.col("rows_before") == 1) & (F.col("rows_after") == 1)
    names = [F.when(~F.col(f"was.{c}").eqNullSafe(F.col(f"is.{c}")), F.lit(c)) for c in sorted(rest)]
    kind = F.when(F.col("rows_before") == 0, "insert").when(F.col("rows_after") == 0, "delete").otherwise("update")
    return agg.select(*key, kind.alias("change"), "rows_before", "rows_after",
                      F.when(one, F.array_join(F.array_compact(F.array(*names)), ",")).alias("changed"))
