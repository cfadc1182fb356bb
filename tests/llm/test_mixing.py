import re
from collections import defaultdict

from pyspark.sql import functions as F

from riskloom.llm import mixing

SIZE = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def expected_targets(sizes):
    """Fill and reshare until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] for s in capped} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 3 * sizes[s]]
        if not over:
            return target
        capped.update(over)


def check(rows, out):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += SIZE(t)
    target = expected_targets(sizes)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6
        assert r["taken"] in (r["size"] * k for k in range(4))
        full = int(target[r["source"]] // sizes[r["source"]]) if sizes[r["source"]] else 0
        assert r["copies"] in (full, full + 1)
        taken[r["source"]] += r["taken"]
    assert sorted((SIZE(t), s or "") for _, t, s in rows) == sorted((r["size"], r["source"] or "") for r in out)
    return target, taken


def test_targets_and_copies(spark, make_docs, rng):
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "c", "d", None])) for i in range(400)]
    out = mixing.mix(make_docs(rows)).collect()
    target, taken = check(rows, out)
    for s, t in target.items():
        assert 0.99 * t <= taken[s] <= t + 1e-6
    again = mixing.mix(make_docs(rows[::-1])).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)


def test_smaller_keys_first(spark, make_docs):
    rows = [(i, "w w w", s) for i in range(300) for s in ("a",)] + [(1000 + i, "w " * 40, "b") for i in range(100)]
    out = [r for r in mixing.mix(make_docs(rows)).collect() if r.source == "b"]
    full = min(r.copies for r in out)
    more = [r.key for r in out if r.copies > full]
    assert not more or max(more) < min([r.key for r in out if r.copies == full], default=9e9)


def test_quality_weighs(spark, make_docs):
    rows = [(i, "w w w w w", "a") for i in range(600)] + [(2000 + i, "w w w w w", "b") for i in range(600)]
    good = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.05)
    out = [r for r in mixing.mix(make_docs(rows), quality=good).collect() if r.source == "b" and r.copies]
    assert sum(r.doc_id % 2 == 0 for r in out) > 0.8 * len(out)


def test_odd_rows(make_docs, odd_rows):
    out = mixing.mix(make_docs(odd_rows, extra=True)).collect()
    check(odd_rows, out)
    assert mixing.mix(make_docs([])).collect() == []


def test_take_repeats_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows, extra=True)
    mixed = mixing.mix(docs)
    out = mixing.take(docs, mixed)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixed.groupBy("doc_id").agg(F.max("copies").alias("copies")).collect()}
    rows = defaultdict(int)
    for i, _, _ in odd_rows:
        rows[i] += 1
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert got == {i: k * copies[i] for i, k in rows.items() if copies[i]}


def test_take_keeps_to_the_budget_of_rows_that_share_an_id(make_docs, rng):
    rows = [(None, " ".join(["w"] * rng.randint(1, 60)), rng.choice(["a", "b"])) for _ in range(300)]
    rows += [(7, "same text here", "b")] * 120 + [(8, "w " * 12_000, "a")]
    docs = make_docs(rows)
    mixed = mixing.mix(docs)
    want, got, decided = defaultdict(int), defaultdict(int), defaultdict(set)
    for r in mixed.collect():
        want[r.source] += r.taken
        decided[r.doc_id].add(r.copies)
    assert len(decided[None]) > 1 and len(decided[7]) > 1  # some of these rows are taken more often than others
    times = defaultdict(int)
    for r in mixing.take(docs, mixed).collect():
        got[r.source] += SIZE(r.text)
        times[r.doc_id, r.source, r.text] += 1
    assert got == want
    per_row = defaultdict(int)
    for r in mixed.collect():
        per_row[r.doc_id, r.source, r.size] += r.copies
    taken = defaultdict(int)
    for (i, s, t), n in times.items():
        taken[i, s, SIZE(t)] += n
    assert taken == {k: n for k, n in per_row.items() if n}


def test_filling_ends_only_when_nothing_fits(make_docs):
    from hashlib import md5

    # in key order one word, then a document just too long for what is left, and so on: a round takes one word
    sizes = [n for j in range(8) for n in (1, 100 - j)]
    order = sorted(range(16), key=lambda i: md5(f"17:{i}".encode()).hexdigest()[:13], reverse=True)
    rows = [(i, "w " * n, "b") for i, n in zip(order, sizes)] + [(100, "w " * 1000, "a")]
    share = 100.5 * 7 / 2 / (1000 + sum(sizes))  # "b" gets 100.5 words
    out = [r for r in mixing.mix(make_docs(rows), share=share).collect() if r.source == "b"]
    assert sorted(r.size for r in out if r.copies) == [1] * 8 and max(r.copies for r in out) == 1


def first_fit(out):
    """Copies by one scan per source in key order."""
    left, copies = {}, []
    for r in sorted(out, key=lambda r: (r.source or "", r.source is None, r.key)):
        full = int(r.target // r.source_size) if r.source_size else 0
        rest = left.setdefault(r.source, r.target - full * r.source_size)
        left[r.source] -= r.size if r.size <= rest else 0
        copies.append((r.doc_id, full + (r.size <= rest)))
    return copies


def test_filling_is_one_scan_in_key_order(make_docs, rng):
    for most in (3, 40, 700):
        rows = [(i, "w " * int(most ** rng.random()), rng.choice(["a", "b", "c", "d", None])) for i in range(500)]
        out = mixing.mix(make_docs(rows)).collect()
        assert sorted((r.doc_id, r.copies) for r in out) == sorted(first_fit(out))


def test_thousands_of_blocked_documents_take_few_rounds(make_docs, monkeypatch):
    from hashlib import md5

    # each one-word document is followed by one that is a word too long for what is left
    pairs = 1500
    sizes = [n for j in range(pairs) for n in (1, pairs - j)]
    order = sorted(range(2 * pairs), key=lambda i: md5(f"17:{i}".encode()).hexdigest()[:13], reverse=True)
    rows = [(i, "w " * n, "b") for i, n in zip(order, sizes)] + [(9999, "w " * 4_000_000, "a")]
    share = (pairs + 0.5) * 7 / 2 / (4_000_000 + sum(sizes))
    written = []
    monkeypatch.setattr(mixing, "save_scratch", lambda df, name, save=mixing.save_scratch: written.append(name) or save(df, name))
    out = mixing.mix(make_docs(rows), share=share).collect()
    assert sorted((r.doc_id, r.copies) for r in out) == sorted(first_fit(out))
    assert sorted(r.size for r in out if r.source == "b" and r.copies) == [1] * pairs
    assert written.count("mix-round") <= 2 + (pairs + 1).bit_length()
