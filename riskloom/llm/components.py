"""Connected components of an edge list, by alternating star contraction.

Every round hangs each node's larger neighbours, then its smaller ones, on
the smallest node around it; the forest flattens to stars in about log(n)
rounds.  A round is joins and partial aggregates over edges only, its result
is a written table (no growing lineage), and nothing but two numbers per round
goes to the driver.  The minimum around each node is a written table before its edges meet it, so the join has a
plain shuffle on both sides and adaptive execution splits the edges of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import drop_scratch, save_scratch


def _minimum(edges: DataFrame) -> tuple[DataFrame, str]:
    """(n, m): the least of a node and its neighbours; a written table."""
    return save_scratch(edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.least("u", "m").alias("m")), "star-centres")


def _large_star(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least, least_path = _minimum(both)
    hung = both.join(least, F.col("u") == F.col("n")).filter("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    out, path = save_scratch(hung, "large-stars")  # read twice below
    return out, [least_path, path]


def _small_star(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least, least_path = _minimum(down)
    joined = down.join(least, F.col("u") == F.col("n"))
    return (joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct()), [least_path]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); the component is
    the smallest node reachable.  Self-loops and repeated edges are allowed."""
    spark = edges.sparkSession
    now, path = save_scratch(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        large, used = _large_star(now)
        small, more = _small_star(large)
        new, new_path = save_scratch(small, "stars")
        state = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        drop_scratch(spark, path, *used, *more)
        now, path = new, new_path
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v"), F.col("v")).distinct())
        seen = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
