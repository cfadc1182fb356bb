import re

import numpy as np
import pytest
import xxhash

from riskloom.llm import simhash
from riskloom.llm.components import components


def plain(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(ids, fps, r=2):
    """Smallest id reachable, by hand."""
    out = list(range(len(fps)))
    find = lambda i: i if out[i] == i else find(out[i])
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= r:
                out[find(i)] = find(j)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(ids[i])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(fps))]


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "A B c", "É à Ü\tx y z  z", "a " * 500, "\x1c b c \x85 d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) % 2**64 == plain(text)


def test_fingerprint_over_pieces(rng, monkeypatch):
    monkeypatch.setattr(simhash, "_PIECE", 7)
    text = " ".join(rng.choice("abcdefgh") for _ in range(200))
    assert simhash.fingerprint(text) % 2**64 == plain(text)


def near_points(rng, n):
    base = [rng.getrandbits(64) for _ in range(n // 4)]
    out = list(base)
    while len(out) < n:
        x = rng.choice(out)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


@pytest.mark.parametrize("block", [1 << 15, 16])
def test_search_finds_all_links(spark, rng, block):
    fps = near_points(rng, 400)
    fps += [fps[0] ^ (1 << i) ^ (1 << j) for i in range(0, 64, 5) for j in range(0, 64, 5)]  # one dense group
    ids = list(range(len(fps)))
    rng.shuffle(ids)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.cluster(df, 2, shard_points=32, block=block).collect()}
    assert got == dict(zip(ids, closure(ids, fps)))


def test_tree_routes_partners_together(rng):
    fps = np.array(near_points(rng, 300), np.uint64)
    tree = simhash.VantageTree(fps[:50], 4)
    shard, who, home = tree.route(fps, 2)
    assert sorted(who[home]) == list(range(len(fps)))
    own = {(int(s), int(w)) for s, w, h in zip(shard, who, home) if h}
    seen = {(int(s), int(w)) for s, w in zip(shard, who)}
    lives = {w: s for s, w in own}
    for i in range(len(fps)):
        for j in range(i):
            if int(fps[i] ^ fps[j]).bit_count() <= 2:
                assert (lives[i], j) in seen or (lives[j], i) in seen


def test_odd_rows(make_docs, odd_rows):
    got = simhash.near_duplicates(make_docs(odd_rows, extra=True)).collect()
    fps = [plain(t) for _, t, _ in odd_rows]
    want = list(zip([r[0] for r in odd_rows], fps, closure([r[0] for r in odd_rows], fps)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(make_docs([])).collect() == []


def test_representatives(make_docs, odd_rows):
    docs = make_docs(odd_rows, extra=True)
    out = simhash.representatives(docs, simhash.near_duplicates(docs))
    assert out.columns == docs.columns
    fps = [plain(t) for _, t, _ in odd_rows]
    want = set(closure([r[0] for r in odd_rows], fps))
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted(want)


def test_components(spark, rng):
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert out == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_representatives_of_rows_that_share_an_id(make_docs, rng):
    from tests.llm.conftest import prose

    a, b, c, d = (prose(rng, 80) for _ in range(4))
    # id 1 has two texts; b is also 2's; c and d have no id, c twice; a has a copy without an id
    rows = [(1, a, "s"), (1, b, "s"), (2, b, "s"), (None, c, "s"), (None, c, "s"), (None, d, "s"), (None, a, "s"), (3, None, "s"), (None, "", "s")]
    for order in (rows, rows[::-1]):
        docs = make_docs(order)
        out = simhash.representatives(docs, simhash.near_duplicates(docs))
        assert out.columns == docs.columns
        got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
        assert got == sorted([(1, a), (1, b), (None, c), (None, d), (3, None)], key=str)


def test_edges_of_a_hub_are_split(spark):
    """A node with most edges: its join with the minimum has a plain shuffle on either side, and is dealt anew."""
    from riskloom.llm import components

    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")}
    for k, v in zip(keep, ("-1", "16k", "16k")):
        spark.conf.set(k, v)
    try:
        hub = spark.range(200_000).selectExpr("0L AS u", "id + 1 AS v").union(spark.range(2_000).selectExpr("id + 300000 AS u", "id + 400000 AS v"))
        both = hub.union(hub.selectExpr("v AS u", "u AS v"))
        least, _ = components._minimum(both)
        joined = both.join(least, both.u == least.n).select("v", "m")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        found = {r.node: r.component for r in components.components(hub).collect()}
        assert set(found.values()) == {0} | set(range(300_000, 302_000)) and len(found) == 204_001
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_depth_follows_the_points(spark, rng, monkeypatch):
    """A tree much deeper than points need still brings all partners together; depth and sample grow with the table."""
    fps = near_points(rng, 500)
    made, real = [], simhash.VantageTree

    class Watched(real):
        def __init__(self, sample, depth):
            made.append((len(sample), depth))
            super().__init__(sample, depth)

    monkeypatch.setattr(simhash, "VantageTree", Watched)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    for shard_points, depth in ((1, 9), (64, 3)):
        got = {r.doc_id: r.component_id for r in simhash.cluster(df, 2, shard_points=shard_points, sample_points=8).collect()}
        assert got == dict(enumerate(closure(range(len(fps)), fps)))
        assert made.pop() == (min(len(set(fps)), max(8, 4 << depth)), depth)
