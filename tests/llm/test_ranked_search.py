import math
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import ranked_search
from tests.conftest import SF001


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def want(docs, items, k=10):
    """Scores of every document for every item, sorted."""
    own = [(i, Counter(split(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_all, length = len(own), sum(sum(c.values()) for _, c in own)
    df = Counter(w for _, c in own for w in c)
    asked = {}
    for i, t in items:
        if t is not None:
            asked[i] = min(asked.get(i, t), t)
    out = []
    for i, text in asked.items():
        scored = []
        for d, c in own:
            m = 25 + 75 * sum(c.values()) * n_all // length
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 8 * m))
                    for w in split(text) if w in c)
            if s > 0:
                scored.append((-s, d is None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(i, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:k])]
    return sorted(out, key=str)


def got(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 7, 1, "w") for i, t in docs], "doc_id long, text string, score int, rank int, words string")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    return sorted(map(tuple, ranked_search.rank(d, b, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 100, "shard_postings": 50}, {"k": 3}])
def test_against_brute_force(spark, rng, options):
    words = [f"w{i}" for i in range(60)] + ["été", "漢字", "A1", "a1"]
    text = lambda n: " ".join(words[min(int(rng.expovariate(0.12)), len(words) - 1)] for _ in range(n))
    docs = [(i, text(rng.randint(1, 40))) for i in range(300)]
    docs += [(300 + i, docs[5][1]) for i in range(40)]  # ties
    items = [(i, text(rng.randint(1, 12))) for i in range(25)] + [(99, docs[5][1]), (98, "nowhere")]
    assert got(spark, docs, items, **options) == want(docs, items, options.get("k", 10))


def test_odd_rows(spark, odd_rows):
    docs = [(i, t) for i, t, _ in odd_rows]
    items = [(1, "alpha BETA beta"), (1, "gamma"), (None, "kappa x"), (2, None), (3, ""), (4, "漢字 end end"), (5, docs[0][1]), (6, docs[8][1])]
    assert got(spark, docs, items) == want(docs, items)
    assert got(spark, [], items) == [] and got(spark, docs, []) == []
    assert got(spark, [(1, None), (2, "")], items) == []


def test_given_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()
    assert got(spark, docs, items) == want(docs, items)


def test_maxima_by_scanning(rng):
    term = np.array([rng.randrange(5) for _ in range(400)])
    doc = np.array([rng.randrange(100) for _ in range(400)])
    keep = np.unique(term * 100 + doc)
    term, doc = keep // 100, keep % 100
    impact = np.array([rng.randrange(1, 50) for _ in keep])
    p = ranked_search.Postings(100, term, doc, impact, 6)
    for t in range(6):
        a, b = p.start[t], p.start[t + 1]
        assert list(p.docs[a:b]) == sorted(doc[term == t])
        for lo in range(b - a):
            for hi in range(lo + 1, b - a + 1):
                best, place = p.maxima(np.array([a]), np.array([lo]), np.array([hi]))
                assert best[0] == p.impact[a + lo:a + hi].max() == p.impact[place[0]] and a + lo <= place[0] < a + hi


def test_search_opens_few_documents(rng, monkeypatch):
    """One document has the rare term: the bounds shut out nearly all others."""
    n = 5000
    doc = np.concatenate((np.arange(n), [1234]))
    term = np.concatenate((np.zeros(n, int), [1]))
    impact = np.concatenate((np.array([rng.randrange(10, 20) for _ in range(n)]), [900]))
    shard = ranked_search.Postings(n, term, doc, impact, 2)
    asked = []
    real = shard.maxima
    monkeypatch.setattr(shard, "maxima", lambda at, lo, hi: asked.append(lo.shape[1]) or real(at, lo, hi))
    docs, scores = ranked_search.search(shard, [(0, 1), (1, 50)], np.arange(n), 1)
    assert list(docs) == [1234] and scores[0] == impact[1234] + 50 * 900
    assert sum(asked) < 20
