import re

import pytest

from riskloom.llm import line_dedup


def want(rows, min_words):
    """Longest earlier match of every line sequence position, by comparison."""
    docs = sorted({(i is not None, i or 0, t) for i, t, _ in rows if t is not None})
    size = lambda s: len(re.findall(r"[^\x20\x09-\x0D]+", s))
    seqs = []
    for known, i, t in docs:
        seqs.append([(n, s) for n, s in enumerate(t.split("\n")) if size(s)])
    order = [(d, p) for d, s in enumerate(seqs) for p in range(len(s))]
    gone = [set() for _ in seqs]
    for x, (d, p) in enumerate(order):
        best = 0
        for e, q in order[:x]:
            n = 0
            while p + n < len(seqs[d]) and q + n < len(seqs[e]) and seqs[d][p + n][1] == seqs[e][q + n][1]:
                n += 1
            best = max(best, n)
        if sum(size(s) for _, s in seqs[d][p:p + best]) >= min_words:
            gone[d].update(n for n, _ in seqs[d][p:p + best])
    left = {k: "\n".join(s for n, s in enumerate(k[2].split("\n")) if n not in g) for k, g in zip(docs, gone)}
    removed = {k: len(g) for k, g in zip(docs, gone)}
    out = []
    for i, t, _ in rows:
        k = (i is not None, i or 0, t)
        out.append((i, 0, 0, None) if t is None else (i, len(t.split("\n")), removed[k], left[k]))
    return sorted(out, key=str)


def got(docs, min_words):
    return sorted((tuple(r) for r in line_dedup.dedup(docs, min_words=min_words).collect()), key=str)


@pytest.mark.parametrize("min_words", [1, 6, 17])
def test_against_comparison(make_docs, rng, min_words):
    lines = ["a b c", "d e", "f", "g h i j", "", "k l", " ", "one two three four five six seven"]
    passages = [[rng.choice(lines) for _ in range(rng.randint(2, 12))] for _ in range(4)]
    rows = []
    for i in range(24):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(lines) + str(rng.randint(0, 40))]
        rows.append((i, "\n".join(parts), "s"))
    rows.append((50, "f\n" * 30, "s"))  # a run that overlaps its copy
    assert got(make_docs(rows, extra=True), min_words) == want(rows, min_words)


def test_long_passage_across_documents(make_docs, rng):
    from tests.llm.conftest import prose

    passage = "\n".join(prose(rng, 13) for _ in range(4)) + "\nlast"
    single = prose(rng, 60)
    rows = [(i, f"start {i}\n{passage}\nend {i}", "s") for i in (3, 4, 9)] + [(20, single, "s"), (21, f"x\n{single}\nshort", "s"),
                                                                            (22, "y\nshort", "s")]
    out = {r[0]: (r[2], r[3]) for r in got(make_docs(rows), 50)}
    assert out[3][0] == 0 and out[4] == (5, "start 4\nend 4") and out[9] == (5, "start 9\nend 9")
    assert out[20][0] == 0 and out[21] == (1, "x\nshort") and out[22][0] == 0


def test_odd_rows(make_docs, odd_rows):
    assert got(make_docs(odd_rows, extra=True), 50) == want(odd_rows, 50)
    assert got(make_docs([]), 50) == []


def test_no_python_in_the_plan(make_docs, odd_rows):
    plan = line_dedup.dedup(make_docs(odd_rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_registered_query_deletes_every_later_copy(spark):
    from riskloom.llm import queries
    from tests.conftest import SF001

    rows = queries.table(spark, SF001, "documents").select("doc_id", "text", "source").collect()
    seen, left = set(), []
    for i, text, _ in sorted(rows):
        lines = text.split("\n")
        kept = []
        for s in lines:
            if s not in seen or not re.search(r"[^\x20\x09-\x0D]", s):
                kept.append(s)
            seen.add(s)
        left.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    short = sum(n for _, _, n, _ in left)
    assert short > sum(r[2] for r in want(rows, 50))  # runs of under 50 words are there
    found = queries.op1_line_dedup(spark, SF001)
    assert sorted(map(tuple, found.select("doc_id", "n_lines", "n_removed", "text").collect())) == left


def told(rows, min_words):
    """(document, text): maximal runs, the longest one's lines, and where it stands first."""
    size = lambda s: len(re.findall(r"[^\x20\x09-\x0D]+", s))
    docs = sorted({(i is not None, i or 0, t) for i, t, _ in rows if t is not None})
    seqs = [[(n, s) for n, s in enumerate(t.split("\n")) if size(s)] for *_, t in docs]
    order = [(d, p) for d, s in enumerate(seqs) for p in range(len(s))]
    out = {}
    for d, seq in enumerate(seqs):
        best, runs, last = (0, None), 0, -1
        for p in range(len(seq)):
            most, first = 0, None
            for e, q in order[:order.index((d, p))]:
                n = 0
                while p + n < len(seq) and q + n < len(seqs[e]) and seq[p + n][1] == seqs[e][q + n][1]:
                    n += 1
                if n > most:
                    most, first = n, (docs[e][1] if docs[e][0] else None, seqs[e][q][0])
            if most and p + most > last and sum(size(s) for _, s in seq[p:p + most]) >= min_words:
                runs += 1
                if most > best[0]:
                    best = (most, first)
            last = max(last, p + most)
        out[docs[d]] = (runs, best[0], *(best[1] or (None, None)))
    return out


@pytest.mark.parametrize("min_words", [1, 9])
def test_runs_against_comparison(make_docs, rng, odd_rows, min_words):
    lines = ["a b c", "d e", "f", "g h i j", "", "k l"]
    passages = [[rng.choice(lines) for _ in range(rng.randint(2, 40))] for _ in range(3)]
    rows = [(i, "\n".join(sum((rng.choice(passages)[rng.randint(0, 3):] if rng.random() < 0.7 else [f"own {rng.randint(0, 9)}"]
                               for _ in range(rng.randint(0, 4))), [])), "s") for i in range(14)]
    rows += [(50, "f\n" * 21, "s"), *odd_rows]
    want_ = told(rows, min_words)
    got_ = line_dedup.dedup(make_docs(rows, extra=True), min_words=min_words, runs=True).collect()
    text = {(r[0], r[3]) for r in want(rows, min_words)}
    assert {(r.doc_id, r.text) for r in got_} == text
    before = sorted(((i, t) for i, t, _ in rows), key=str)
    keyed = {}
    for (known, i, t), v in want_.items():
        keyed.setdefault(i if known else None, []).append(v)
    for r in got_:
        if r.n_lines:
            assert (r.n_runs, r.longest_run, r.first_doc, r.first_line) in keyed[r.doc_id]
        else:
            assert (r.n_runs, r.longest_run, r.first_doc) == (0, 0, None)
    assert len(got_) == len(before) and max(r.longest_run for r in got_) > 10


def test_doubles_until_no_pair_repeats(make_docs, monkeypatch):
    text = "\n".join(f"line {i}" for i in range(40))
    written, real = [], line_dedup.save_scratch
    monkeypatch.setattr(line_dedup, "save_scratch", lambda df, name: written.append(name) or real(df, name))
    out = line_dedup.dedup(make_docs([(1, text, "s"), (2, text, "s")]), min_words=1, runs=True).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_runs, r.longest_run, r.first_doc, r.first_line) for r in out) == [
        (1, 0, 0, 0, None, None), (2, 40, 1, 40, 1, 0)]
    assert written.count("suffix-ranks") == 5 and written.count("runs") == 6  # 2^5 <= 40 lines
