"""Toxicity scores by a convolutional text classifier, trained in Spark tasks.

A word (a run of letters, digits and characters beyond ASCII, lower-cased) has the sum of two rows of
two embedding tables, chosen by two halves of its hash: words share a row at times, hardly ever
both.  Filters one, two and three words wide slide over the whole text; each keeps
its largest answer (max pooling, at least 0), and a logistic unit weighs these.  Gradients flow
to the words that gave the largest answers only.

All labelled documents are learned, from their whole texts; four fifths fit the network, the last fifth
calibrates thresholds: the decision point of a language is where the calibration documents of
that language are told apart best.  The language is read from the text itself, by
counting function words; nothing but the text enters a score.  Scores are shifted by the decision point, so
``cut`` is the score at the decision point in every language.

The fit runs in Spark: the documents lie in slices of about ``slice_docs`` documents, chosen by a hash of the id.  In each of
``ROUNDS`` rounds a task goes through a slice, a piece in memory at a time, from the network of the round before;
what the slices changed is averaged (a word's row over the slices that changed it) and makes the next network.
A single slice is plain gradient steps.  Only the network, whose size is fixed, comes to the driver and goes to the tasks.  Decision
points are exact, by prefix counts over ranges of the logits.

Every document is scored from its whole text, in pieces of bounded size
(a piece reads on into the next one, so no window is lost), in one pass without a shuffle.

Defined cases: a null text is empty; an empty text has no answers and the score of
the bare bias; labels that are null count for nothing, several labels of one document are
averaged (half and half: 1); rows that repeat an id count once in the fit, with the least of their texts' words; rows of a null
id are no training rows; with no labels of one of the two kinds every score is 0; an empty table gives an
empty result.  Only the named columns are read.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import drop_scratch, save_scratch, scratch_path, shuffle_partitions

BUCKETS = 1 << 17
WIDTH = 8  # of an embedding
FILTERS = 8  # of each width
WINDOWS = (1, 2, 3)
PIECE = 1 << 17  # words scored at a time
ROUNDS = 4  # of the fit
CHUNK = 1 << 22  # words of training documents a task holds, at least those of one document
BLOCK = 1 << 13  # rows of a table that travel together
FAN = 64  # slices added up at a time
SIEVE = 1 << 26  # bits of the sieve of labelled ids
_PAD = max(WINDOWS) - 1
_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
LANGUAGES = {  # function words
    "en": "the of and to in is that it was for with",
    "de": "der die das und ist nicht ein eine den mit auf",
    "fr": "le les et des une est que pour du dans au",
    "es": "el los y las por una del con para se su",
}
_FUNCTION = {w.encode(): i for i, words in enumerate(LANGUAGES.values(), 1) for w in words.split()}


class _Hashes(dict):
    """Word -> 61 bits of its hash, then 3 bits of language (0: no function word)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        h = self[word] = (xxhash.xxh64_intdigest(word) >> 4 << 3) | _FUNCTION.get(word, 0)
        return h


_HASHES = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    if not text:
        return np.empty(0, np.int64)
    words = text.lower().encode("utf-8", "surrogatepass").translate(_BYTES).split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words))


def language(hashes: np.ndarray) -> int:
    """1 to 4 by most function words (ties: the first), 0 with none."""
    counts = np.bincount(hashes & 7, minlength=8)[1:]
    return int(counts.argmax()) + 1 if counts.any() else 0


def pack(hashes: np.ndarray) -> bytes:
    """What the network and ``language`` read of the hashes, five bytes a word."""
    first, second = _rows(hashes)
    return (hashes & 7 | first << 3 | second << 20).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    """Hashes with the same rows and function words."""
    words = np.zeros((len(packed) // 5, 8), np.uint8)
    words[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    k = words.view("<i8").ravel()
    return k & (1 << 20) - 1 | k >> 20 << 32


def _rows(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> 3) % BUCKETS, (hashes >> 32) % BUCKETS


@dataclass
class Network:
    """``tables``: two of BUCKETS + 1 rows, the last is that of the blank
    between documents and stays 0.  ``filters[w][j]``: weights of a window's word j."""

    tables: list[np.ndarray]
    filters: list[np.ndarray]
    shift: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def new(cls, seed: int) -> "Network":
        rng = np.random.default_rng(seed)
        tables = [(rng.standard_normal((BUCKETS + 1, WIDTH)) * 0.05).astype(np.float32) for _ in range(2)]
        for t in tables:
            t[BUCKETS] = 0
        filters = [(rng.standard_normal((w, WIDTH, FILTERS)) / math.sqrt(WIDTH)).astype(np.float32) for w in WINDOWS]
        n = len(WINDOWS) * FILTERS
        return cls(tables, filters, np.zeros(n, np.float32), (rng.standard_normal(n) * 0.1).astype(np.float32), 0.0)

    def answers(self, rows: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(embeddings, answers of every filter to the window that begins at each
        word); words past the end count as blanks."""
        x = self.tables[0][rows[0]] + self.tables[1][rows[1]]
        y = x @ np.concatenate([f for w in self.filters for f in w], axis=1)
        out = np.empty((len(x), len(WINDOWS) * FILTERS), np.float32)
        col = 0
        for i, w in enumerate(WINDOWS):
            mine = out[:, i * FILTERS:(i + 1) * FILTERS]
            mine[:] = y[:, col * FILTERS:(col + 1) * FILTERS]
            for j in range(1, w):
                mine[:-j] += y[j:, (col + j) * FILTERS:(col + j + 1) * FILTERS]
            col += w
        return x, out

    def pooled(self, docs: list[np.ndarray]) -> np.ndarray:
        """Largest answers per document (rows) before shift and floor; a document without
        words has the lowest value, which the floor lifts."""
        best = np.full((len(docs), len(WINDOWS) * FILTERS), -1e30, np.float32)
        pieces: list[np.ndarray] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if not pieces:
                return
            lengths = np.array([len(p) for p in pieces])
            starts = np.concatenate(([0], np.cumsum(lengths + _PAD)[:-1]))
            rows = (np.full(size, BUCKETS), np.full(size, BUCKETS))
            for at, p in zip(starts, pieces):
                for r, own in zip(rows, _rows(p)):
                    r[at:at + len(p)] = own
            found = self.answers(rows)[1]
            # windows that begin in the blanks, or in the next piece, do not count
            ends = np.stack((starts, starts + np.minimum(lengths, PIECE)), axis=1).ravel()
            top = np.maximum.reduceat(found, ends, axis=0)[::2]
            np.maximum.at(best, owners, top)
            pieces.clear()
            owners.clear()
            size = 0

        for i, d in enumerate(docs):
            for a in range(0, len(d), PIECE):
                p = d[a:a + PIECE + _PAD]
                pieces.append(p)
                owners.append(i)
                size += len(p) + _PAD
                if size >= PIECE:
                    flush()
        flush()
        return best

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        return np.maximum(self.pooled(docs) + self.shift, 0) @ self.weights + self.bias


def _windows() -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(len(WINDOWS) * FILTERS)
    return n // FILTERS, n % FILTERS


def best_windows(net: Network, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest answers per document and filter, and the rows of both tables of the
    words of the window that gave them.  Documents have words."""
    n, wide = len(WINDOWS) * FILTERS, max(WINDOWS)
    top = np.full((len(docs), n), -np.inf, np.float32)
    spots = tuple(np.full((len(docs), n, wide), BUCKETS) for _ in range(2))
    held: list[tuple[int, np.ndarray, int]] = []  # document, words, windows that count
    size = 0

    def flush() -> None:
        nonlocal size
        rows = tuple(np.full(size, BUCKETS) for _ in range(2))
        at, starts = 0, []
        for _, p, _ in held:
            for r, own in zip(rows, _rows(p)):
                r[at:at + len(p)] = own
            starts.append(at)
            at += len(p) + _PAD
        found = net.answers(rows)[1]
        for (i, _, count), start in zip(held, starts):
            mine = found[start:start + count]
            place = mine.argmax(axis=0)
            value = mine[place, np.arange(n)]
            new = value > top[i]
            top[i, new] = value[new]
            where = (start + place[new])[:, None] + np.arange(wide)
            for spot, r in zip(spots, rows):
                spot[i, new] = r[where]
        held.clear()
        size = 0

    for i, d in enumerate(docs):
        for a in range(0, len(d), PIECE):
            p = d[a:a + PIECE + _PAD]
            if held and size + len(p) > PIECE:
                flush()
            held.append((i, p, min(len(p), PIECE)))
            size += len(p) + _PAD
    flush()
    return top, *spots


def _slopes(net: Network, dlogit: np.ndarray, top: np.ndarray, first: np.ndarray, second: np.ndarray):
    """Gradients from what ``best_windows`` tells."""
    x = net.tables[0][first] + net.tables[1][second]
    pooled = np.maximum(top + net.shift, 0)
    dpool = dlogit[:, None] * net.weights * (pooled > 0)
    gweights = (dlogit[:, None] * pooled).sum(axis=0)
    gfilters = [np.zeros_like(f) for f in net.filters]
    spots, dx = ([], []), []
    for c, (kind, col) in enumerate(zip(*_windows())):
        w = WINDOWS[kind]
        for j in range(w):
            gfilters[kind][j, :, col] = dpool[:, c] @ x[:, c, j]
            for spot, rows in zip(spots, (first, second)):
                spot.append(rows[:, c, j])
            dx.append(dpool[:, c:c + 1] * net.filters[kind][j, :, col])
    return gfilters, dpool.sum(axis=0), gweights, float(dlogit.sum()), *map(np.concatenate, spots), np.concatenate(dx)


def gradients(net: Network, docs: list[np.ndarray], dlogit: np.ndarray, x: np.ndarray, rows, found: np.ndarray, starts: np.ndarray):
    """Gradients of the sum of dlogit times logit: (filters, shift, weights, bias,
    embedding rows of the first table, of the second, their gradients).  Documents have words."""
    place = np.stack([found[s:s + len(d)].argmax(axis=0) + s for s, d in zip(starts, docs)])
    words = place[:, :, None] + np.arange(max(WINDOWS))
    return _slopes(net, dlogit, np.take_along_axis(found, place, axis=0), rows[0][words], rows[1][words])


class _Step:
    """Adagrad: steps shrink with the gradients a weight has had."""

    def __init__(self, rate: float):
        self.rate, self.seen = rate, {}

    def dense(self, key, value: np.ndarray, g: np.ndarray) -> None:
        seen = self.seen.setdefault(key, np.full_like(value, 1e-4))
        seen += g * g
        value -= self.rate * g / np.sqrt(seen)

    def sparse(self, key, table: np.ndarray, rows: np.ndarray, g: np.ndarray) -> None:
        seen = self.seen.setdefault(key, np.full(len(table), 1e-4, np.float32))
        own, back = np.unique(rows, return_inverse=True)
        total = np.zeros((len(own), g.shape[1]), np.float32)
        np.add.at(total, back, g)
        total[own == BUCKETS] = 0
        seen[own] += (total * total).mean(axis=1)
        table[own] -= self.rate * total / np.sqrt(seen[own])[:, None]


def steps(net: Network, step: _Step, docs: list[np.ndarray], toxic: np.ndarray, heavy: float, rng, batch: int = 64) -> None:
    """One pass over documents that have words, a gradient step a batch; a toxic one weighs ``heavy``."""
    order = rng.permutation(len(docs))
    for begin in range(0, len(docs), batch):
        own = order[begin:begin + batch]
        top, first, second = best_windows(net, [docs[i] for i in own])
        logit = np.maximum(top + net.shift, 0) @ net.weights + net.bias
        y = toxic[own]
        d = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - y) * np.where(y, heavy, 1.0) / len(own)
        gf, gs, gw, gb, r1, r2, dx = _slopes(net, d.astype(np.float32), top, first, second)
        for i, g in enumerate(gf):
            step.dense(("filter", i), net.filters[i], g)
        step.dense("shift", net.shift, gs)
        step.dense("weights", net.weights, gw)
        bias = np.array([net.bias], np.float32)
        step.dense("bias", bias, np.array([gb], np.float32))
        net.bias = float(bias[0])
        step.sparse("first", net.tables[0], r1, dx)
        step.sparse("second", net.tables[1], r2, dx)


def _dense(net: Network, step: _Step) -> np.ndarray:
    """All weights but the tables, and the gradients they have had, as one row."""
    keys = [("filter", i) for i in range(len(net.filters))] + ["shift", "weights", "bias"]
    values = [*net.filters, net.shift, net.weights, np.array([net.bias], np.float32)]
    seen = [step.seen.get(k, np.full_like(v, 1e-4)) for k, v in zip(keys, values)]
    return np.concatenate([v.ravel() for v in values + seen])


def _set_dense(net: Network, step: _Step, row: np.ndarray) -> None:
    keys = [("filter", i) for i in range(len(net.filters))] + ["shift", "weights", "bias"]
    values = [*net.filters, net.shift, net.weights, np.zeros(1, np.float32)]
    parts = np.split(row.astype(np.float32), np.cumsum([v.size for v in values + values])[:-1])
    for i, (key, v) in enumerate(zip(keys, values)):
        v[...] = parts[i].reshape(v.shape)
        step.seen[key] = parts[len(keys) + i].reshape(v.shape).copy()
    net.bias = float(values[-1][0])


def _table(net: Network, step: _Step, kind: int) -> np.ndarray:
    """A table and the gradients its rows have had, side by side."""
    t = net.tables[kind]
    seen = step.seen.get(("first", "second")[kind])
    return np.concatenate((t, np.full((len(t), 1), 1e-4, np.float32) if seen is None else seen[:, None]), axis=1)


UPDATE = "block int, slice long, at binary, slices binary, change binary"  # row numbers in the block, slices that changed a row, summed changes


def _update(block: int, own: int, at: np.ndarray, slices: np.ndarray, change: np.ndarray) -> tuple:
    return block, own, at.astype(np.int32).tobytes(), slices.astype(np.int32).tobytes(), change.astype(np.float32).tobytes()


def _changes(net: Network, step: _Step, old: tuple[Network, _Step], own: int) -> Iterator[tuple]:
    """What a slice changed: block 0 is that of all weights but the tables."""
    yield _update(0, own, np.zeros(1), np.ones(1), (_dense(net, step) - _dense(*old))[None])
    blocks = -(-(BUCKETS + 1) // BLOCK)
    for kind in range(2):
        was, now = _table(*old, kind), _table(net, step, kind)
        changed = now[:, -1] != was[:, -1]
        for b in range(blocks):
            at = np.flatnonzero(changed[b * BLOCK:(b + 1) * BLOCK])
            if len(at):
                rows = at + b * BLOCK
                yield _update(1 + kind * blocks + b, own, at, np.ones(len(at)), now[rows] - was[rows])


def _read_update(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, slices = np.frombuffer(r.at, np.int32), np.frombuffer(r.slices, np.int32)
    return at, slices, np.frombuffer(r.change, np.float32).reshape(len(at), -1)


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sum of a block's updates."""
    total = slices = None
    for r in pdf.sort_values("slice", kind="stable").itertuples():
        at, n, change = _read_update(r)
        if total is None:
            total, slices = np.zeros((BLOCK, change.shape[1])), np.zeros(BLOCK, np.int32)
        total[at] += change
        slices[at] += n
    at = np.flatnonzero(slices)
    return pd.DataFrame([_update(int(pdf["block"].iloc[0]), int(pdf["slice"].min()) // FAN, at, slices[at], total[at])],
                        columns=["block", "slice", "at", "slices", "change"])


def fit(known: DataFrame, slices: int, words_in: int, heavy: float, epochs: int | None = None, batch: int = 64, rate: float = 0.2,
        seed: int = 13) -> Network:
    """A network that minimises the logistic loss over ``known`` (slice, toxic, h), of which ``words_in`` have words; a toxic one
    weighs ``heavy``.  Few documents are gone through more often (``epochs``)."""
    spark = known.sparkSession
    net, step = Network.new(seed), _Step(rate)
    passes = -(-(epochs or min(40, max(ROUNDS, -(-40_000 // max(1, words_in))))) // ROUNDS)
    blocks = -(-(BUCKETS + 1) // BLOCK)
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast((net, step))

        def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, mine, docs, toxic, held = None, None, [], [], 0

            def learn() -> None:
                for _ in range(passes):
                    steps(*mine[:2], docs, np.array(toxic, bool), heavy, mine[2], batch)
                docs.clear()
                toxic.clear()

            def told() -> pd.DataFrame:
                return pd.DataFrame(list(_changes(*mine[:2], shared.value, own)), columns=["block", "slice", "at", "slices", "change"])

            for pdf in frames:
                for s, y, h in zip(pdf["slice"], pdf["toxic"], pdf["h"]):
                    if s != own:
                        if own is not None:
                            learn()
                            yield told()
                        own, held = int(s), 0
                        mine = (*copy.deepcopy(shared.value), np.random.default_rng((seed, number, own)))
                    if len(h):
                        docs.append(unpack(h))
                        toxic.append(y)
                        held += len(docs[-1])
                    if held >= CHUNK:
                        learn()
                        held = 0
            if own is not None:
                learn()
                yield told()

        changed, left = known.mapInPandas(visit, UPDATE), slices
        while True:  # trees of FAN branches
            changed = changed.groupBy("block", F.floor(F.col("slice") / FAN)).applyInPandas(_add, UPDATE)
            left = -(-left // FAN)
            if left <= 1:
                break
        net, step = copy.deepcopy((net, step))
        tables = [_table(net, step, kind) for kind in range(2)]
        for r in changed.collect():  # one row a block: the size of the network
            at, n, change = _read_update(r)
            mean = change / n[:, None]
            if r.block == 0:
                _set_dense(net, step, _dense(net, step) + mean[0])
            else:
                kind, b = divmod(r.block - 1, blocks)
                tables[kind][at + b * BLOCK] += mean
        for kind, key in enumerate(("first", "second")):
            net.tables[kind], step.seen[key] = tables[kind][:, :-1].copy(), tables[kind][:, -1].copy()
        shared.destroy()
    return net


def decision_point(logits: np.ndarray, toxic: np.ndarray, clean_weight: float = 1.0) -> float:
    """The middle of the gap at which fewest documents fall on the wrong side,
    a clean one counting ``clean_weight``."""
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], toxic[order]
    # the first i are called clean
    wrong = np.concatenate(([0], np.cumsum(y))) + clean_weight * np.concatenate((np.cumsum(~y[::-1])[::-1], [0]))
    wide = np.concatenate(([0.0], np.diff(x), [0.0]))
    wrong = np.where((wide > 0) | (np.arange(len(wide)) % len(x) == 0), wrong, np.inf)  # equal logits stay together
    best = max(np.flatnonzero(wrong == wrong.min()), key=lambda i: wide[i])
    if best == 0 or best == len(x):
        return float(x[0] - 1) if best == 0 else float(x[-1] + 1)
    return float((x[best - 1] + x[best]) / 2)


@dataclass
class Classifier:
    """A network and the decision point of each language (0: none found)."""

    net: Network | None
    points: list[float]
    cut: float

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        if self.net is None or not docs:
            return np.zeros(len(docs))
        point = np.array([self.points[language(d)] for d in docs])
        z = self.net.logits(docs).astype(np.float64) - point + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def decision_points(logits: DataFrame, clean_weight: float, least: int) -> list[float]:
    """``decision_point`` per language of a table (lang, logit, toxic); a language with fewer than ``least`` documents of
    either kind has the point of all languages together, as has one without documents."""
    spark, everything = logits.sparkSession, -1
    counts = (logits.select(F.explode(F.array("lang", F.lit(everything))).alias("own"), "logit", "toxic").groupBy("own", "logit")
              .agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c")))
    ranged, path = save_scratch(counts.repartitionByRange(shuffle_partitions(spark), "own", "logit")
                                .withColumn("part", F.spark_partition_id()), "toxic-logits")
    parts = Window.partitionBy("own").orderBy("part")
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    all_parts = Window.partitionBy("own")
    # a row per range and language
    offsets = ranged.groupBy("own", "part").agg(F.sum("t").alias("pt"), F.sum("c").alias("pc"), F.max("logit").alias("last")).select(
        "own", "part", F.coalesce(F.sum("pt").over(before), F.lit(0)).alias("bt"), F.coalesce(F.sum("pc").over(before), F.lit(0)).alias("bc"),
        F.lag("last").over(parts).alias("was"), F.sum("pt").over(all_parts).alias("all_t"), F.sum("pc").over(all_parts).alias("all_c"),
        F.max("last").over(all_parts).alias("top"))
    here = Window.partitionBy("own", "part").orderBy("logit")
    upto = here.rowsBetween(Window.unboundedPreceding, -1)
    toxic_below = F.col("bt") + F.coalesce(F.sum("t").over(upto), F.lit(0))
    clean_below = F.col("bc") + F.coalesce(F.sum("c").over(upto), F.lit(0))
    cuts = ranged.join(offsets, ["own", "part"]).select(
        "own", "all_t", "all_c", "top", "logit", (toxic_below + F.lit(float(clean_weight)) * (F.col("all_c") - clean_below)).alias("wrong"),
        F.coalesce(F.lag("logit").over(here), F.col("was")).alias("prior"))
    wide = F.coalesce(F.col("logit") - F.col("prior"), F.lit(0.0))
    point = F.coalesce((F.col("prior") + F.col("logit")) / 2, F.col("logit") - 1)
    found = cuts.groupBy("own").agg(F.min(F.struct("wrong", -wide, "logit", point.alias("point"))).alias("best"), F.first("all_t").alias("t"),
                                    F.first("all_c").alias("c"), F.first("top").alias("top")).collect()
    drop_scratch(spark, path)
    points = {r.own: r.top + 1 if r.t < r.best.wrong else r.best.point for r in found if r.own == everything or min(r.t, r.c) >= least}
    return [float(points.get(code, points.get(everything, 0.0))) for code in range(len(LANGUAGES) + 1)]


def calibrate(net: Network, known: DataFrame, cut: float, clean_weight: float = 1.0, least: int = 10) -> Classifier:
    """Decision points per language from ``known`` (toxic, h)."""
    shared = known.sparkSession.sparkContext.broadcast(net)

    @F.pandas_udf("lang int, logit double")
    def run(h: pd.Series) -> pd.DataFrame:
        docs = [unpack(b) for b in h]
        return pd.DataFrame({"lang": np.array([language(d) for d in docs], np.int32), "logit": shared.value.logits(docs).astype(np.float64)})

    points = decision_points(known.select("toxic", run("h").alias("r")).select("r.lang", "r.logit", "toxic"), clean_weight, least)
    shared.destroy()
    return Classifier(net, points, cut)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "toxic", cut: float = 0.3, slice_docs: int = 8_192, **options) -> Classifier:
    """Fit and calibrate on the whole texts of all documents of ``labels`` (one vote per document)."""
    spark = docs.sparkSession
    votes = (labels.filter(F.col(label_id).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(label_id).alias("_id")).agg((F.avg(label_col) >= 0.5).alias("_toxic")))
    whole = {r._toxic: r.n for r in votes.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = max(1, -(-sum(whole.values()) // slice_docs))

    @F.pandas_udf("binary")
    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series([pack(word_hashes(t)) for t in texts], dtype=object)

    # texts of ids without a label stay where they are; a sieve of fixed size knows the others, and some more
    sieve = F.pmod(F.xxhash64("_id"), F.lit(SIEVE))
    marks = votes.groupBy(F.bitmap_bucket_number(sieve).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(sieve)).alias("marks"))
    bit = F.bitmap_bit_position(sieve)
    byte = F.conv(F.hex(F.substring("marks", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_id is not null").join(
        F.broadcast(marks), F.bitmap_bucket_number(sieve) == F.col("bucket")).filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
    both = texts.select("_id", F.lit(None).cast("boolean").alias("_toxic"), hashes("_text").alias("h")).union(
        votes.select("_id", "_toxic", F.lit(None).cast("binary")))
    rows = both.select(F.pmod(F.xxhash64("_id"), F.lit(slices)).alias("slice"), F.xxhash64(F.lit("order"), "_id").alias("place"), "*").repartition(
        slices, "slice").groupBy("slice", "place", "_id").agg(F.max("_toxic").alias("toxic"), F.min("h").alias("h")).filter(
        "toxic is not null and h is not null").sortWithinPartitions("slice", "place", "_id")
    path = scratch_path(spark, "toxic-known")
    rows.select("slice", "toxic", "h", (F.pmod(F.xxhash64(F.lit("apart"), "_id"), F.lit(5)) == 0).alias("apart")).write.partitionBy(
        "apart", "slice").option("compression", "zstd").parquet(path)
    known = spark.read.schema("toxic boolean, h binary, apart boolean, slice long").parquet(path)
    try:
        return _learn(known, whole, slices, cut, **options)
    finally:
        drop_scratch(spark, path)


def _learn(known: DataFrame, whole: dict[bool, int], slices: int, cut: float, **options) -> Classifier:
    kinds = {r.apart: r for r in known.groupBy("apart").agg(
        F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean"), F.count_if(F.length("h") > 0).alias("worded"),
        F.count_if(F.col("toxic") & (F.length("h") > 0)).alias("worded_toxic")).collect()}
    toxic, clean = (sum(r[k] for r in kinds.values()) for k in ("toxic", "clean"))
    if not toxic or not clean:
        return Classifier(None, [], cut)
    worded, hit = (kinds[False].worded, kinds[False].worded_toxic) if False in kinds else (0, 0)
    share = float(np.clip(hit / worded, 1e-6, 1 - 1e-6)) if worded else 0.5
    net = fit(known.filter(~F.col("apart")), slices, worded, float(np.clip(math.sqrt((1 - share) / share), 0.1, 10)), **options)
    check, n = known, (toxic, clean)
    if True in kinds and kinds[True].toxic and kinds[True].clean:
        check, n = known.filter("apart"), (kinds[True].toxic, kinds[True].clean)
    # clean documents weigh as often as they stand among all labelled ones
    return calibrate(net, check, cut, (whole[False] / whole[True]) * (n[0] / n[1]))


def score_column(classifier: Classifier, text: Column) -> Column:
    """Scores of whole texts.  The model goes to a task once, as a broadcast of fixed size."""
    from pyspark import SparkContext

    shared = SparkContext.getOrCreate().broadcast(classifier)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        scores, docs, held = [], [], 0
        for t in texts:
            docs.append(word_hashes(t))
            held += len(docs[-1])
            if held >= PIECE:
                scores.append(shared.value.score(docs))
                docs, held = [], 0
        scores.append(shared.value.score(docs))
        return pd.Series(np.concatenate(scores), dtype="float64")

    return run(text)


def held_out(doc_id: Column, parts: int = 4, rest: int = 2) -> Column:
    """True for the part of the ids that training leaves alone."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == rest, F.lit(False))
