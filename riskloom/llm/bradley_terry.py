"""Quality scores by Bradley-Terry pairwise ranking.

A labelled sample gives preference pairs (a document labelled 1 is preferred
to one labelled 0).  The model's utility is linear in text features, and the
probability that ``a`` is preferred to ``b`` is the logistic function of their
utility difference; the weights minimise the logistic loss on feature
differences.  The rejected share is taken from the labels: the utility at that quantile
of the training documents becomes the decision point, where the score equals
``cut``.

Only the fit sees a sample: ``max_labelled`` labelled documents (those with
the smallest hash of their id) and ``pairs_per_doc`` pairs for each.  Every document
is scored from its whole text, in one pass without a shuffle.

Defined cases: a null text is empty; an empty text has all features 0 and a
score like any other; labels that are null count for nothing, several labels
of one document are averaged (half and half: 1); with no labels of one of the two
kinds there is nothing to prefer and every score is 0.5; repeated rows are learned once and scored
alike; texts of any length are read whole; no documents give no scores.  Labels, language,
source and id are no inputs of a score.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ("upper letters", "letters", "digits", "marks", "marks at word ends", "words without letters",
            "words like the one before", "distinct words", "mean word length", "log words", "distinct lines",
            "long words", "characters of the commonest mark")
_LETTER, _UPPER, _DIGIT, _MARK = 1, 2, 4, 8


def _classes(limit: int = 0x3000) -> np.ndarray:
    table = np.zeros(limit + 1, np.uint8)
    for c in range(limit):
        kind = unicodedata.category(chr(c))
        table[c] = ((_LETTER if kind[0] == "L" else 0) | (_UPPER if kind == "Lu" else 0)
                    | (_DIGIT if kind[0] == "N" else 0) | (_MARK if kind[0] in "PS" else 0))
    table[limit] = _LETTER  # beyond: mostly ideographs
    return table


_TABLE = _classes()


def features(text: str | None) -> np.ndarray:
    """The feature vector of a whole text; all within a few units of 0 to 1."""
    out = np.zeros(len(FEATURES))
    words = text.split() if text else []
    if not words:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _TABLE[np.minimum(codes, len(_TABLE) - 1)]
    letters, n, k = int((kinds & _LETTER > 0).sum()), len(codes), len(words)
    marks = kinds & _MARK > 0
    lines = [x for x in text.split("\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, k)
    common = np.bincount(np.minimum(codes[marks], 0x2FF)).max() if marks.any() else 0
    # a mark before white space or the end
    blank = np.append(codes[1:] <= 32, True)
    ends = marks & blank
    begins = np.append(True, codes[:-1] <= 32)
    out[:] = (
        (kinds & _UPPER > 0).sum() / max(1, letters), letters / n, (kinds & _DIGIT > 0).sum() / n, marks.sum() / n,
        ends.sum() / k, (ends & begins).sum() / k, sum(map(str.__eq__, words[1:], words)) / k, len(set(words)) / k,
        min(3.0, lengths.mean() / 10), math.log1p(k) / 10, len(set(lines)) / max(1, len(lines)),
        (lengths > 25).mean(), common / n)
    return out


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts], dtype=object)

    return run(text)


@dataclass
class Ranking:
    """Weights on standardised features, and the utility at the decision point."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut_utility: float
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        utility = ((x - self.mean) / self.scale) @ self.weights
        z = np.clip(utility - self.cut_utility + math.log(self.cut / (1 - self.cut)), -700, 700)
        return 1 / (1 + np.exp(-z))


def fit_pairs(better: np.ndarray, worse: np.ndarray, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights that minimise the mean of log(1 + exp(-w.(a - b))) + l2 |w|^2 / 2
    over pairs, by Newton steps."""
    d = better - worse
    w = np.zeros(d.shape[1])
    loss = lambda w: np.logaddexp(0, -d @ w).mean() + l2 * w @ w / 2
    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -700, 700)))
        grad = -(d * p[:, None]).mean(axis=0) + l2 * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + l2 * np.eye(len(w))
        step, size = np.linalg.solve(hess, grad), 1.0
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        before, now = now, loss(w)
        if before - now < 1e-10:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, cut: float = 0.3, pairs_per_doc: int = 8, seed: int = 5) -> Ranking:
    """The ranking from feature rows ``x`` and their labels."""
    k = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not len(x) or good.all() or not good.any():
        return Ranking(np.zeros(k), np.ones(k), np.zeros(k), math.log(cut / (1 - cut)), cut)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    upper, lower = np.flatnonzero(good), np.flatnonzero(~good)
    # each document meets pairs_per_doc of the other kind
    a = np.concatenate((np.repeat(upper, pairs_per_doc), rng.choice(upper, len(lower) * pairs_per_doc)))
    b = np.concatenate((rng.choice(lower, len(upper) * pairs_per_doc), np.repeat(lower, pairs_per_doc)))
    w = fit_pairs(z[a], z[b])
    utility = np.sort(z @ w)
    rejected = len(lower)  # the quantile: as many as the labels reject
    point = (utility[rejected - 1] + utility[rejected]) / 2
    return Ranking(mean, scale, w, float(point), cut)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality", cut: float = 0.3, max_labelled: int = 10_000,
          **options) -> Ranking:
    """Fit on at most ``max_labelled`` documents of ``labels`` (one vote per
    document), chosen by a hash of the id."""
    votes = (labels.filter(F.col(label_id).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(label_id).alias("_id")).agg((F.avg(label_col) >= 0.5).alias("_good")))
    sample = votes.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    # at most max_labelled narrow rows: a proven bound
    known = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text")).join(
        F.broadcast(sample), F.col("_doc") == F.col("_id"))
    # a document that repeats counts once, so the sample stays bounded
    rows = known.select("_id", "_good", feature_column(F.col("_text")).alias("x")).groupBy("_id").agg(
        F.first("_good").alias("good"), F.min("x").alias("x")).orderBy("_id").collect()
    return fit(np.array([r.x for r in rows]).reshape(len(rows), -1) if rows else np.zeros((0, len(FEATURES))),
               np.array([r.good for r in rows], bool), cut, **options)


def score_column(ranking: Ranking, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts]).reshape(len(texts), -1)
        return pd.Series(ranking.score(x) if len(texts) else [], dtype="float64")

    return run(text)


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """True for the part of the ids that training leaves alone."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))
