import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import bradley_terry as bt


def corpus(rng, prose, n=240):
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(20, 120)).split()
        kind = rng.choice(["good"] * 4 + ["caps", "junk", "repeat"])
        if kind == "caps":
            words = [w.upper() + "!!" for w in words]
        elif kind == "junk":
            words = [w + rng.choice(["###", "%%%", "$$$"]) for w in words]
        elif kind == "repeat":
            words = [words[0]] * len(words)
        rows.append((i, " ".join(words), kind == "good"))
    return rows


@pytest.fixture
def labelled(rng):
    from tests.llm.conftest import prose

    return corpus(rng, prose)


def test_features_are_finite(odd_rows):
    for _, t, _ in odd_rows:
        x = bt.features(t)
        assert x.shape == (len(bt.FEATURES),) and np.isfinite(x).all()
    assert not bt.features(None).any() and not bt.features("").any()


def test_fit_is_the_pairwise_optimum(rng):
    r = np.random.default_rng(3)
    a, b = r.normal(0.5, 1, (300, 3)), r.normal(0, 1, (300, 3))
    w = bt.fit_pairs(a, b, l2=0.1)
    loss = lambda w: np.logaddexp(0, -(a - b) @ w).mean() + 0.05 * w @ w
    for step in np.vstack((np.eye(3), -np.eye(3))) * 1e-3:
        assert loss(w) <= loss(w + step)


def test_held_out_accuracy(spark, make_docs, labelled):
    docs = make_docs([(i, t, "s") for i, t, _ in labelled], extra=True)
    labels = spark.createDataFrame([(i, int(g)) for i, _, g in labelled], "doc_id long, quality int")
    ranking = bt.train(docs, labels.filter(~bt.held_out(F.col("doc_id"))))
    out = {r.doc_id: r for r in docs.select("doc_id", bt.held_out(F.col("doc_id")).alias("held"),
                                            bt.score_column(ranking, F.col("text")).alias("p")).collect()}
    held = [(out[i].p >= 0.3) == g for i, _, g in labelled if out[i].held]
    assert len(held) > 30 and np.mean(held) > 0.95
    assert all(out[i].held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in labelled)
    assert all(0 <= r.p <= 1 for r in out.values())


def test_same_texts_same_scores_whatever_the_rest(spark, make_docs, labelled):
    docs = make_docs([(i, t, "s") for i, t, _ in labelled])
    labels = spark.createDataFrame([(i, int(g)) for i, _, g in labelled], "doc_id long, quality int")
    a, b = (bt.train(d, labels) for d in (docs, docs.orderBy(F.desc("doc_id"))))
    assert np.allclose(a.weights, b.weights) and a.cut_utility == pytest.approx(b.cut_utility)


def test_odd_labels(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, extra=True)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1), (3, 1), (99, 0)], "doc_id long, quality int")
    ranking = bt.train(docs, labels)  # nothing of the kind 0 in the corpus
    scores = [r.p for r in docs.select(bt.score_column(ranking, F.col("text")).alias("p")).collect()]
    assert scores == [pytest.approx(0.5)] * len(odd_rows)
    ranking = bt.train(docs, spark.createDataFrame([(1, 1), (7, 0), (5, 0)], "doc_id long, quality int"))
    scores = [r.p for r in docs.select(bt.score_column(ranking, F.col("text")).alias("p")).collect()]
    assert len(scores) == len(odd_rows) and all(0 <= s <= 1 for s in scores)
    assert scores[2] == scores[3]
    empty = make_docs([])
    assert empty.select(bt.score_column(bt.train(empty, labels), F.col("text"))).collect() == []


def test_sample_is_bounded(spark, make_docs, labelled):
    docs = make_docs([(i, t, "s") for i, t, _ in labelled])
    labels = spark.createDataFrame([(i, int(g)) for i, _, g in labelled], "doc_id long, quality int")
    seen = []
    real = bt.fit
    bt.fit = lambda x, good, *a, **k: seen.append(len(x)) or real(x, good, *a, **k)
    try:
        bt.train(docs, labels, max_labelled=50)
    finally:
        bt.fit = real
    assert seen == [50]


def plain_features(text):
    """The thirteen features, counted character by character and word by word."""
    from collections import Counter
    from unicodedata import category

    words = (text or "").split()
    if not words:
        return [0.0] * 13
    kind = lambda c: category(c) if ord(c) < 0x3000 else "Lo"
    marks = [i for i, c in enumerate(text) if kind(c)[0] in "PS"]
    ends = [i for i in marks if i + 1 == len(text) or text[i + 1] <= " "]
    alone = [i for i in ends if i == 0 or text[i - 1] <= " "]
    commonest = Counter(min(ord(text[i]), 0x2FF) for i in marks).most_common(1)
    letters = [c for c in text if kind(c)[0] == "L"]
    lines = [x for x in text.split("\n") if x]
    n, k = len(text), len(words)
    return [sum(kind(c) == "Lu" for c in letters) / max(1, len(letters)), len(letters) / n,
            sum(kind(c)[0] == "N" for c in text) / n, len(marks) / n, len(ends) / k, len(alone) / k,
            sum(a == b for a, b in zip(words, words[1:])) / k, len(set(words)) / k,
            min(3.0, sum(map(len, words)) / k / 10), np.log1p(k) / 10, len(set(lines)) / max(1, len(lines)),
            sum(len(w) > 25 for w in words) / k, commonest[0][1] / n if commonest else 0.0]


def plain_scores(rows, good, cut=0.3, per_doc=8, l2=1e-3):
    """Utilities by plain gradient steps on the same pairs, the decision point between the
    rejected and the kept, and the scores."""
    x = np.array(rows)
    spread = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(spread > 1e-9, spread, 1.0)
    draw = np.random.default_rng(5)
    upper, lower = [i for i, g in enumerate(good) if g], [i for i, g in enumerate(good) if not g]
    rivals = draw.choice(upper, len(lower) * per_doc)
    pairs = list(zip([u for u in upper for _ in range(per_doc)], draw.choice(lower, len(upper) * per_doc)))
    pairs += list(zip(rivals, [v for v in lower for _ in range(per_doc)]))
    d = np.array([z[a] - z[b] for a, b in pairs])
    w, pace = np.zeros(z.shape[1]), 1 / (np.linalg.eigvalsh(d.T @ d / len(d))[-1] / 4 + l2)
    ahead, last = w, w
    for step in range(30_000):  # gradient steps with momentum
        ahead = w + step / (step + 3) * (w - last)
        odds = 1 / (1 + np.exp(np.clip(d @ ahead, -700, 700)))
        last, w = w, ahead + pace * ((d * odds[:, None]).mean(axis=0) - l2 * ahead)
    utility = z @ w
    order = sorted(utility)
    point = (order[len(lower) - 1] + order[len(lower)]) / 2
    return [1 / (1 + (1 - cut) / cut * np.exp(-min(max(u - point, -600), 600))) for u in utility]


def test_features_as_counted_one_by_one(odd_rows, labelled):
    texts = [t for _, t, _ in odd_rows] + [t for _, t, _ in labelled[:60]]
    texts += ["Ab, c. - !! ###\nAb, c. - !! ###\n\nx", "\u4e2d\u6587 \u3002x ?", " . ", "\u00c9t\u00e9 12 " + "z" * 30, "a\u00a0b!"]
    for t in texts:
        assert np.allclose(bt.features(t), plain_features(t), rtol=1e-12, atol=1e-12)


def test_scores_as_by_plain_pairs(spark, make_docs, labelled):
    rows = labelled[:120]
    docs = make_docs([(i, t, "s") for i, t, _ in rows], extra=True)
    ranking = bt.train(docs, spark.createDataFrame([(i, int(g)) for i, _, g in rows], "doc_id long, quality int"))
    got = [r.p for r in docs.orderBy("doc_id").select(bt.score_column(ranking, F.col("text")).alias("p")).collect()]
    want = plain_scores([plain_features(t) for _, t, _ in rows], [g for _, _, g in rows])
    assert np.allclose(got, want, atol=1e-3)
    assert [g >= 0.3 for g in got] == [w >= 0.3 for w in want]
