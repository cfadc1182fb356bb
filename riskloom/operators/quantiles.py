"""Exact percentiles of whole numbers per group, by counting ranges.

No group is sorted or held in a task: each round cuts the range that still holds a percentile into at most ``BINS`` parts,
counts the group's rows per part (map-side partial sums) and keeps the part with the wanted rank.
A range of 2^63 values takes seven rounds at most, whatever the number of rows; between rounds
there is one row per group and percentile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import drop_scratch, save_scratch

BINS = 1024


def exact_percentiles(df: DataFrame, by: Sequence[str], value: str, percents: Sequence[int]) -> DataFrame:
    """(by..., n, p<percent>...): for each group the number of its values and, for each percent, the least value
    with at least that share of the values at or below it (SQL's percentile_disc).  Null values do not count; a
    group without values has nulls; null keys are one group."""
    spark = df.sparkSession
    keys = [f"_k{i}" for i in range(len(by) + 1)]  # the last is constant: no ``by`` is one group
    rows = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.lit(0).alias(keys[-1]), F.col(value).cast("long").alias("_v"))
    size = rows.groupBy(*keys).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    size, size_path = save_scratch(size, "percentile-groups")
    # the wanted rank within [lo, hi]: n * percent / 100, rounded up, the first at least
    need = F.greatest(F.lit(1), F.ceil(F.col("n").cast("decimal(25,0)") * F.col("p") / 100)).cast("long")
    state = size.filter("n > 0").select(*keys, F.explode(F.array(*[F.lit(p) for p in percents])).alias("p"), "n", "lo", "hi").withColumn("rank", need).drop("n")
    state, path = save_scratch(state, "percentile-ranges")
    while not state.filter("lo < hi").isEmpty():
        # decimal: hi - lo may exceed a long
        width = F.expr(f"(CAST(hi AS DECIMAL(20,0)) - CAST(lo AS DECIMAL(20,0)) + {BINS}) DIV {BINS}")
        open_ = state.filter("lo < hi").withColumn("width", width)
        same = [F.col(k).eqNullSafe(F.col(f"r{k}")) for k in keys]
        inside = rows.filter("_v is not null").select(*[F.col(k).alias(f"r{k}") for k in keys], "_v")
        # the ranges are a written table of known size: the rows are not shuffled while it is small
        met = inside.join(open_, [*same, F.col("_v").between(F.col("lo"), F.col("hi"))])
        part = F.expr("(CAST(_v AS DECIMAL(20,0)) - CAST(lo AS DECIMAL(20,0))) DIV CAST(width AS DECIMAL(20,0))")
        counted = met.groupBy(*keys, "p", "lo", "hi", "rank", "width", part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
        upto = Window.partitionBy(*keys, "p").orderBy("part")
        found = counted.withColumn("upto", F.sum("c").over(upto)).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
        begin = F.col("lo").cast("decimal(25,0)") + F.col("part").cast("decimal(5,0)") * F.col("width").cast("decimal(20,0)")
        end = F.least(F.col("hi").cast("decimal(25,0)"), begin + F.col("width") - 1).cast("long")
        narrowed = found.select(*keys, "p", begin.cast("long").alias("lo"), end.alias("hi"), (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"))
        new, new_path = save_scratch(state.filter("lo = hi").select(*keys, "p", "lo", "hi", "rank").union(narrowed), "percentile-ranges")
        drop_scratch(spark, path)
        state, path = new, new_path
    wide = state.groupBy(*[F.col(k).alias(f"s{k}") for k in keys]).agg(*[F.max(F.when(F.col("p") == p, F.col("lo"))).alias(f"p{p}") for p in percents])
    met = size.join(wide, [F.col(k).eqNullSafe(F.col(f"s{k}")) for k in keys], "left")
    return met.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], "n", *[f"p{p}" for p in percents])
