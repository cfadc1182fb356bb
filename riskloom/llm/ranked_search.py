r"""Ranked lexical search with range-maximum tables over posting lists.

Scores are BM25 in whole numbers: a term found in ``df`` of the ``N`` documents with terms weighs
w = floor(1000 ln((2N + 2) / (2 df + 1))); ``tf`` places of it in a document of ``n`` terms have
the impact (10^9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L, where L counts the terms of all
documents.  A document's score is the sum of w times impact over the item's terms, repeats included.

The items are the stated query set.  They are cut into blocks of bounded text, whose terms are
the dictionary of one pass over the documents: a task keeps, per document, its
length and the (term, tf) pairs of dictionary terms, as a written table.  Its rows are dealt out
to shards of a bounded number of postings.  A shard builds one posting list per term, in document order
(shorter documents first, so that neighbours have like impacts), and over each list a sparse table: row k holds, for
every place, where the largest impact of the 2^k postings from there on stands.  Two
look-ups then answer the largest impact of a term between any two documents.

An item's search keeps intervals of documents.  The sum over its terms of weight times
largest impact bounds every score in the interval, and is the score itself for one document.  The
intervals with the highest bounds are opened first: each is split at the document that holds the largest
single term of its bound, which gets its score, and the two parts their own bounds.  The search ends when no bound left can
enter the k best.  Shards return k documents per item at most, and a window merges them.

Defined cases: a null or empty text has no terms, such a document is in no list and not in N; an item
without terms has no result; rows that repeat an item id ask once, with the least of their texts, and a null id is an id
like any other; equal documents are listed each; equal scores go to the smaller document id, null ids last; terms of
any length count, and very long texts are read whole; empty tables give an empty result.  Only
the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize

BLOCK_BYTES = 8 << 20  # item text in a dictionary
SHARD_POSTINGS = 1 << 19
_OPENED = 64  # intervals opened at a time
# bytes of terms: digits, letters (A-Z lower-cased) and all beyond ASCII; the others part them
_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_FOUND = "item long, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


class Postings:
    """Posting lists of a shard.  ``docs`` of term t, ascending, stand at
    ``start[t]`` to ``start[t + 1]``; ``impact`` goes with them."""

    def __init__(self, n_docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((doc, term))
        self.n_docs = n_docs
        self.docs, self.impact = doc[order].astype(np.int32), impact[order].astype(np.int32)
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        # one array per level over all lists; an answer reads only places inside one list
        longest = int(np.diff(self.start).max(initial=0))
        places = np.arange(len(order), dtype=np.int32)
        self.best = [places]
        for k in range(1, max(1, longest).bit_length()):
            below, half = self.best[-1], 1 << (k - 1)
            right = np.append(below[half:], np.repeat(below[-1:], min(half, len(below))))
            self.best.append(np.where(self.impact[right] > self.impact[below], right, below))

    def maxima(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For lists ``at`` and places ``lo`` to ``hi`` in them: the largest impact
        (0 if there is none) and its place."""
        size = hi - lo
        level = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        out = np.zeros(size.shape, np.int64)
        where = np.zeros(size.shape, np.int64)
        for k in np.unique(level[size > 0]):
            mine = (level == k) & (size > 0)
            a = self.best[k][at[mine] + lo[mine]]
            b = self.best[k][at[mine] + hi[mine] - (1 << int(k))]
            x, y = self.impact[a], self.impact[b]
            out[mine], where[mine] = np.maximum(x, y), np.where(y > x, b, a)
        return out, where


def search(shard: Postings, wanted: list[tuple[int, int]], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``k`` best with a score above 0 for ``wanted`` (term,
    weight); ``ids`` (ascending ranks of the document ids) settle ties."""
    wanted = [(t, w) for t, w in wanted if w > 0 and shard.start[t] < shard.start[t + 1]]
    if not wanted:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.array([shard.start[t] for t, _ in wanted])[:, None]
    weight = np.array([w for _, w in wanted], np.int64)[:, None]
    before = np.zeros((len(wanted), shard.n_docs + 1), np.int32)  # postings before a document
    for row, (t, _) in zip(before, wanted):
        row[shard.docs[shard.start[t]:shard.start[t + 1]] + 1] = 1
    np.cumsum(before, axis=1, out=before)

    def bound(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the intervals and the documents to split them at."""
        impact, place = shard.maxima(np.broadcast_to(at, (len(at), len(lo))), before[:, lo], before[:, hi])
        part = impact * weight
        top = part.argmax(axis=0)
        return part.sum(axis=0), shard.docs[place[top, np.arange(len(lo))]].astype(np.int64)

    lo, hi = np.array([0]), np.array([shard.n_docs])
    high, split = bound(lo, hi)
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    while len(lo):
        # the best intervals, and those that stay
        if len(lo) > _OPENED:
            open_ = np.argpartition(-high, _OPENED)[:_OPENED]
            rest = np.ones(len(lo), bool)
            rest[open_] = False
        else:
            open_, rest = np.arange(len(lo)), np.zeros(len(lo), bool)
        a, b, d = lo[open_], hi[open_], split[open_]
        n = len(d)
        new_lo, new_hi = np.concatenate((d, a, d + 1)), np.concatenate((d + 1, d, b))
        some = new_lo < new_hi
        new_high, new_split = np.zeros(3 * n, np.int64), np.zeros(3 * n, np.int64)
        new_high[some], new_split[some] = bound(new_lo[some], new_hi[some])
        docs, scores = np.concatenate((docs, d)), np.concatenate((scores, new_high[:n]))
        best = np.lexsort((ids[docs], -scores))[:k]
        docs, scores = docs[best], scores[best]
        least = scores[-1] if len(scores) == k else 1
        lo, hi = np.concatenate((lo[rest], new_lo[n:])), np.concatenate((hi[rest], new_hi[n:]))
        high, split = np.concatenate((high[rest], new_high[n:])), np.concatenate((split[rest], new_split[n:]))
        # an equal bound may hide an equal score with a smaller id
        left = (high >= max(least, 1)) & (lo < hi)
        lo, hi, high, split = lo[left], hi[left], high[left], split[left]
    return docs[scores > 0], scores[scores > 0]


def _lists(docs: DataFrame, dictionary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, none, n, t, f) per document with a term: its id and whether it has none, its length, its
    dictionary terms and how often each stands in it."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            kept, lengths, found, counts = [], [], [], []
            for i, text in enumerate(part["text"]):
                words = terms(text)
                if not words:
                    continue
                own = Counter(filter(dictionary.__contains__, words))
                kept.append(i)
                lengths.append(len(words))
                found.append(np.fromiter((dictionary[w] for w in own), np.int32, len(own)))
                counts.append(np.fromiter(own.values(), np.int32, len(own)))
            own = part.iloc[kept]
            yield pd.DataFrame({"id": own["id"].array, "none": own["none"].array, "n": lengths,
                                "t": pd.Series(found, dtype=object), "f": pd.Series(counts, dtype=object)})

    # a null id in pandas would make the others doubles
    i = F.col(id_col).cast("long")
    return docs.select(F.coalesce(i, F.lit(0)).alias("id"), i.isNull().alias("none"), F.col(text_col).alias("text")) \
        .mapInPandas(run, "id long, none boolean, n long, t array<int>, f array<int>")


def _block(docs: DataFrame, asked: list, k: int, id_col: str, text_col: str, shard_postings: int) -> DataFrame | None:
    """(item, doc_id, score): the shards' best for a block of items (item, terms)."""
    asked = [(row.item, terms(row.text)) for row in asked]
    dictionary = {w: i for i, w in enumerate(sorted({w for _, words in asked for w in words}))}
    if not dictionary:
        return None
    lists = materialize(_lists(docs, dictionary, id_col, text_col).withColumn("place", F.monotonically_increasing_id()), "search-lists")
    all_ = lists.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("terms"), F.sum(F.size("t")).alias("postings")).first()
    if not all_["n"] or not all_["postings"]:
        return None
    weight = F.floor(1000 * F.log((2.0 * all_["n"] + 2) / (2 * F.col("df") + 1))).alias("w")
    # one number per dictionary term
    weights = np.zeros(len(dictionary), np.int64)
    for row in lists.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).select("t", weight).collect():
        weights[row.t] = row.w
    items = []
    for item, words in asked:
        often = Counter(dictionary[w] for w in words)
        items.append((item, [(t, int(weights[t]) * c) for t, c in often.items()]))
    n_all, n_terms = all_["n"], all_["terms"]
    shards = -(-all_["postings"] // shard_postings)

    def shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n", "place"], ignore_index=True)
        sizes = part["t"].map(len).to_numpy()
        doc = np.repeat(np.arange(len(part)), sizes)
        tf = np.concatenate(list(part["f"])).astype(np.int64)
        # 75 n N div L without leaving 64 bits, whatever the lengths
        m = np.array([25 + 75 * int(n) * n_all // n_terms for n in part["n"]], np.int64)
        postings = Postings(len(part), np.concatenate(list(part["t"])), doc, 1_000_000_000 * tf // (1000 * tf + 8 * m[doc]), len(weights))
        last, ids = part["none"].to_numpy(bool), part["id"].to_numpy(np.int64)
        ranks = np.empty(len(part), np.int64)
        ranks[np.lexsort((ids, last))] = np.arange(len(part))
        best = [(item, *search(postings, wanted, ranks, k)) for item, wanted in items]
        found = np.concatenate([docs for _, docs, _ in best])
        return pd.DataFrame({"item": np.repeat([item for item, _, _ in best], [len(docs) for _, docs, _ in best]),
                             "doc_id": pd.arrays.IntegerArray(ids[found], last[found]),
                             "score": np.concatenate([scores for _, _, scores in best])})

    rows = lists.filter(F.size("t") > 0).withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(shards)))
    return rows.groupBy("shard").applyInPandas(shard, _FOUND)


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
         shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest
    scores above 0 for every item."""
    spark = docs.sparkSession
    asked = items.groupBy(F.col(item_id).cast("long").alias("item_id")).agg(F.min(item_text).alias("text")) \
        .select("item_id", "text", F.octet_length("text").alias("bytes")).filter("bytes > 0")
    asked = materialize(asked.withColumn("item", F.monotonically_increasing_id()), "search-items")
    blocks = max(1, -(-(asked.agg(F.sum("bytes")).first()[0] or 0) // block_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    found = []
    for b in range(blocks):  # each holds about block_bytes of item text
        part = asked.filter(F.col("block") == b).select("item", "text").collect()
        found.append(_block(docs, part, k, id_col, text_col, shard_postings) if part else None)
    found = [f for f in found if f is not None]
    best = reduce(DataFrame.union, found) if found else spark.createDataFrame([], _FOUND)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
