import re

import pytest

from riskloom.llm import licenses
from riskloom.llm.queries import PHRASES

TEMPLATES = {"one": ("alpha beta gamma delta kappa lambda1 mu",), "two": ("theta iota zeta x1 x2 x3 x4 x5", "q1 q2 q3")}


def tokens(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


def want(text, templates, threshold, span):
    w = tokens(text)
    places, base = [], set()
    for p, label in PHRASES.items():
        p = p.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    found = {}
    for i in range(0, max(1, len(w) - span), span):
        block = set(w[i:i + 2 * span])
        for label, texts in templates.items():
            for t in texts:
                t = set(tokens(t))
                share = len(t & block) / len(t)
                if share >= threshold - 1e-12:
                    found[label] = max(share, found.get(label, 0))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(found))), 1.0 if base else max(found.values(), default=0.0))


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_join_is_exact(spark, make_docs, rng, threshold):
    pool = tokens(" ".join(t for x in TEMPLATES.values() for t in x)) + ["noise", "more", "filler"] * 4
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 120))), "s") for i in range(150)]
    rows += [(900, "Under the MIT license, under the mit-license; CC BY-NC!", "s"), (901, "Apache License (Version 2.0)", "s")]
    got = {r[0]: tuple(r)[1:] for r in licenses.scan(make_docs(rows, extra=True), PHRASES, TEMPLATES, threshold, span=16).collect()}
    assert got == {i: want(t, TEMPLATES, threshold, 16) for i, t, _ in rows}


def test_notices_in_prose(make_docs, rng):
    from tests.llm.conftest import prose

    mit = licenses.TEMPLATES["mit"][0].replace("copies", "COPIES,\n").replace(" the ", "\n* the ")
    cut = " ".join(licenses.TEMPLATES["apache-2"][0].split()[:8])
    rows = [(1, prose(rng, 700) + "\n" + mit + "\n" + prose(rng, 300), "s"), (2, prose(rng, 300) + cut, "s"), (3, prose(rng, 3000), "s")]
    got = {r.doc_id: r.labels for r in licenses.scan(make_docs(rows), {}).collect()}
    assert got == {1: "mit", 2: "", 3: ""}


def test_odd_rows(make_docs, odd_rows):
    got = licenses.scan(make_docs(odd_rows, extra=True), PHRASES).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *want(t, licenses.TEMPLATES, 0.8, 128)) for i, t, _ in odd_rows), key=key)
    assert licenses.scan(make_docs([]), PHRASES).collect() == []


def test_whole_notices_of_any_length(make_docs, rng):
    """Templates of 8 to some 900 words, whole, cut in two and with words left out, in long and short texts."""
    from tests.llm.conftest import prose

    notice = {n: " ".join(f"n{n}w{i % (n * 3 // 4)}" for i in range(n)) for n in (8, 130, 250, 900)}
    templates = {"short": (notice[8],), "long": (notice[130], notice[900]), "other": (notice[250],), "none": ("", "!?")}
    assert {size: sorted(of) for size, of in licenses.spans(templates, 128).items()} == {128: ["short"], 256: ["long", "other"], 1024: ["long"]}
    rows = []
    for n, text in notice.items():
        w = text.split()
        rows += [(n * 10, text, "s"), (n * 10 + 1, prose(rng, 700) + "\n" + "\n".join(w) + " " + prose(rng, 900), "s"),
                 (n * 10 + 2, " ".join(w[: n // 2]), "s"), (n * 10 + 3, " ".join(x for i, x in enumerate(w) if i % 9), "s")]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(make_docs(rows), PHRASES, templates).collect()}
    for i, text, _ in rows:
        found = {}
        for size, of in licenses.spans(templates, 128).items():
            part = want(text, of, 0.8, size)
            found |= {label: max(part[6], found.get(label, 0)) for label in part[5].split(",") if label}
        assert (got[i][5], got[i][6]) == (",".join(sorted(found)), pytest.approx(max(found.values(), default=0.0)))
    assert {i: got[i][5] for i in got if i % 10 == 1} == {81: "short", 1301: "long", 2501: "other", 9001: "long"}
    assert all(got[i][5] == "" for i in (82, 1302, 2502, 9002))


def test_the_positional_filter_rejects():
    """A block that shares a notice's rare word but has too few known words after it is not counted."""
    of = licenses.Notices({"a": ("r1 r2 r3 c1 c2",), "b": ("q1 q2 q3",)}, dict.fromkeys([b"c1", b"c2"], 9), 0.6)
    counted = []
    of.items = [(label, type("Counted", (frozenset,), {"intersection": lambda self, other: counted.append(1) or frozenset.intersection(self, other)})(n), need)
                for label, n, need in of.items]
    assert of.best({b"r3", b"c2", b"z1", b"z2", b"z3"}) == {} and not counted
    assert of.best({b"r3", b"c1", b"c2"}) == {"a": 0.6} and counted


def test_every_shipped_notice_is_found(make_docs, rng):
    from tests.llm.conftest import prose

    rows = [(i, prose(rng, 900) + "\n" + t + "\n" + prose(rng, 40), label) for i, (label, t) in
            enumerate((label, t) for label, texts in licenses.TEMPLATES.items() for t in texts)]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(make_docs(rows), PHRASES).collect()}
    assert got == {i: (label, 1.0) for i, _, label in rows}


def test_many_places_are_counted_in_one_pass():
    text = "CC BY NC filler " * 40_000
    assert licenses.scan_text(text, PHRASES, {})[:4] == (160_000, 40_000, 0, 159_996)
