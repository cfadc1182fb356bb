"""Exact top-k by inner product, term at a time.

Rows are sparse integer vectors.  Queries and candidates are cut into blocks of
bounded size; every pair of a query block and a candidate block is one group.
In a group, each dimension ("term") has a posting list of the candidates that
are not zero there; the queries scatter their weight times the postings into a
dense array of scores, one term after the other.  The k best of the block are selected
from that array, and a window over the blocks' winners merges them.

Defined cases: rows with a null id, and vectors that are null or hold a null or non-finite component,
take no part; vectors of different length meet in the dimensions they share;
an empty vector scores 0 with all; equal scores go to the smaller id; a row
is not compared with rows of its own id; rows that repeat an id are
candidates each, and such queries give the first of their vectors (in array
order); products are exact 64-bit integers as long as they fit.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize, shuffle_partitions

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 16384
_CELLS = 1 << 21  # scores held at a time


def usable(vec: Column) -> Column:
    return vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def scaled(vec: Column, factor: int = 256) -> Column:
    return F.transform(vec, lambda x: F.floor(x.cast("double") * factor))


def _matrix(vectors: pd.Series) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of every query (rows) with every candidate (columns)."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights, values = queries[:, term], candidates[:, term]
        asking, posting = np.flatnonzero(weights), np.flatnonzero(values)
        if not len(asking) or not len(posting):
            continue
        if len(asking) == len(weights) and len(posting) == len(values):
            scores += weights[:, None] * values[None, :]
        else:
            scores[np.ix_(asking, posting)] += weights[asking, None] * values[None, posting]
    return scores


def select(scores: np.ndarray, ids: np.ndarray, own, k: int) -> np.ndarray:
    """Positions of the k best in a row of scores, ties to the smaller id."""
    left = np.flatnonzero(ids != own)
    if len(left) > k:
        found = scores[left]
        left = left[found >= np.partition(found, len(found) - k)[len(found) - k]]
    return left[np.lexsort((ids[left], -scores[left]))][:k]


def top_k(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          vector: Column | None = None, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``table`` where ``is_query``
    holds, against all rows.  ``vector`` (default: 256 times ``vec_col``, floored)
    is the array of integers to compare."""
    spark = table.sparkSession
    vec = F.col(vec_col)
    vectors = materialize(table.filter(F.col(id_col).isNotNull() & usable(vec)).select(
        F.col(id_col).cast("long").alias("id"), (scaled(vec) if vector is None else vector).alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks")), "topk-vectors")
    queries = vectors.filter("asks").groupBy("id").agg(F.min("vec").alias("vec"))
    n = vectors.agg(F.count(F.lit(1)).alias("all"), F.count_if("asks").alias("asking")).first()
    # at least a block per task, more when blocks would outgrow the bound
    blocks = max(shuffle_partitions(spark), -(-n["all"] // candidate_block))
    asking = max(1, -(-n["asking"] // query_block))
    place = F.xxhash64("id", "vec")
    cands = vectors.select("id", "vec", F.pmod(place, F.lit(blocks)).cast("int").alias("cb"),
                           F.explode(F.sequence(F.lit(0), F.lit(asking - 1))).alias("qb"))
    asks = queries.select("id", "vec", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"),
                          F.pmod(F.xxhash64("id"), F.lit(asking)).cast("int").alias("qb"))

    def block(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(q) and len(c):
            ids, qm, cm = c["id"].to_numpy(np.int64), _matrix(q["vec"]), _matrix(c["vec"])
            own = q["id"].to_numpy(np.int64)
            step = max(1, _CELLS // len(ids))
            for i in range(0, len(own), step):
                for j, scores in enumerate(accumulate(qm[i:i + step], cm), i):
                    best = select(scores, ids, own[j], k)
                    out["query_id"].append(np.full(len(best), own[j]))
                    out["vec_id"].append(ids[best])
                    out["score"].append(scores[best])
        return pd.DataFrame({n: np.concatenate(v) if v else np.empty(0, np.int64) for n, v in out.items()})

    winners = asks.groupBy("cb", "qb").cogroup(cands.groupBy("cb", "qb")).applyInPandas(
        block, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (winners.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
