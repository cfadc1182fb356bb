import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import text_cnn
from tests.llm.conftest import prose

BAD = ["vile", "grim", "garstig"]


def naive_logit(net, hashes):
    """One window after the other."""
    rows = [net.tables[0][(h >> 3) % text_cnn.BUCKETS] + net.tables[1][(h >> 32) % text_cnn.BUCKETS] for h in map(int, hashes)]
    blank = np.zeros(text_cnn.WIDTH)
    out, at = net.bias, 0
    for w, weights in zip(text_cnn.WINDOWS, net.filters):
        for f in range(text_cnn.FILTERS):
            best = max((sum((rows[i + j] if i + j < len(rows) else blank) @ weights[j, :, f] for j in range(w))
                        for i in range(len(rows))), default=-math.inf)
            out += max(0.0, best + net.shift[at]) * net.weights[at]
            at += 1
    return out


@pytest.mark.parametrize("piece", [None, 7])
def test_whole_texts_against_single_windows(rng, monkeypatch, piece):
    if piece:
        monkeypatch.setattr(text_cnn, "PIECE", piece)
    net = text_cnn.Network.new(1)
    net.shift += np.linspace(-0.2, 0.2, len(net.shift), dtype=np.float32)
    docs = [text_cnn.word_hashes(t) for t in ("", "one", "one two", "a b c", prose(rng, 50), prose(rng, 8), prose(rng, 7), "x " * 30, "")]
    assert np.allclose(net.logits(docs), [naive_logit(net, d) for d in docs], atol=1e-4)


def test_words(rng):
    text = "Ein Ärger, don't_stop 漢字!\nA-1"
    want = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower())
    assert len(text_cnn.word_hashes(text)) == len(want) == 8
    assert text_cnn.language(text_cnn.word_hashes("der Hund und die Katze of")) == 2
    assert text_cnn.language(text_cnn.word_hashes("")) == 0 == text_cnn.language(text_cnn.word_hashes("xyz"))


def test_gradients_by_differences(rng):
    net = text_cnn.Network.new(2)
    net.tables = [t.astype(np.float64) for t in net.tables]
    net.filters = [f.astype(np.float64) for f in net.filters]
    net.weights, net.shift = net.weights.astype(np.float64), net.shift.astype(np.float64)
    doc = text_cnn.word_hashes(prose(rng, 12))

    def run():
        rows = tuple(np.append(r, [text_cnn.BUCKETS] * text_cnn._PAD) for r in text_cnn._rows(doc))
        x = net.tables[0][rows[0]] + net.tables[1][rows[1]]
        y = x @ np.concatenate([f for w in net.filters for f in w], axis=1)
        n = text_cnn.FILTERS
        found = np.zeros((len(x), 3 * n))
        col = 0
        for i, w in enumerate(text_cnn.WINDOWS):
            for j in range(w):
                found[:len(x) - j, i * n:(i + 1) * n] += y[j:, (col + j) * n:(col + j + 1) * n]
            col += w
        logit = np.maximum(found[:len(doc)].max(axis=0) + net.shift, 0) @ net.weights + net.bias
        return logit, (x, rows, found, np.array([0]))

    _, state = run()
    gf, gs, gw, gb, r1, r2, dx = text_cnn.gradients(net, [doc], np.ones(1), *state)
    table = np.zeros_like(net.tables[0])
    np.add.at(table, r1, dx)
    row = int(r1[0])
    for array, spot, g in [(net.filters[0], (0, 1, 2), gf[0]), (net.filters[2], (2, 3, 1), gf[2]), (net.shift, (4,), gs),
                           (net.weights, (9,), gw), (net.tables[0], (row, 0), table), (net.tables[0], (row, 5), table)]:
        old = array[spot]
        array[spot] = old + 1e-6
        up = run()[0]
        array[spot] = old - 1e-6
        down = run()[0]
        array[spot] = old
        assert math.isclose((up - down) / 2e-6, g[spot], rel_tol=1e-3, abs_tol=1e-6)
    assert gb == 1


def test_decision_point_is_the_best_cut(rng):
    for _ in range(50):
        x = np.array([rng.choice([0.0, 1.0, 2.0, 3.0, 4.0]) for _ in range(12)])
        y = np.array([rng.random() < 0.4 for _ in x])
        weight = rng.choice([1.0, 5.0])
        wrong = lambda t: (y & (x < t)).sum() + weight * (~y & (x >= t)).sum()
        t = text_cnn.decision_point(x, y, weight)
        assert wrong(t) == min(wrong(c) for c in (-1, 0.5, 1.5, 2.5, 3.5, 5))


def _corpus(rng, n):
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(rng, rng.randint(5, 60)).split()
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_documents_are_told_apart(spark, rng):
    rows = _corpus(rng, 1500)
    docs = spark.createDataFrame([(i, t, 1.5, "x") for i, t, _ in rows], "doc_id long, text string, score double, toxic string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    out = text_cnn.held_out(F.col("doc_id"))
    c = text_cnn.train(docs, labels.filter(~out))
    got = docs.select("doc_id", out.alias("o"), text_cnn.score_column(c, F.col("text")).alias("s")).collect()
    want = {i: y for i, _, y in rows}
    assert all(r.o == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [(r.s >= 0.3) == want[r.doc_id] for r in got if r.o]
    assert len(held) > 300 and sum(held) / len(held) > 0.97
    assert all(0 <= r.s <= 1 for r in got)


def test_odd_documents(spark, make_docs, odd_rows, rng):
    docs = make_docs(odd_rows, extra=True)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 0), (4, 0), (5, 0), (None, 1), (7, 1), (99, 0)], "doc_id long, toxic int")
    c = text_cnn.train(docs, labels)
    scored = docs.select("doc_id", "text", text_cnn.score_column(c, F.col("text")).alias("s")).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r.s <= 1 for r in scored)
    assert len({r.s for r in scored if not (r.text or "").strip()}) == 1  # null, empty and blank texts alike
    assert len({r.s for r in scored if r.text == odd_rows[0][1]}) == 1
    # one kind of label only, or none
    for kind in ("toxic = 0", "toxic > 1"):
        none = text_cnn.train(docs, labels.filter(kind))
        assert {r.s for r in docs.select(text_cnn.score_column(none, F.col("text")).alias("s")).collect()} == {0.0}
    empty = docs.limit(0)
    assert empty.select(text_cnn.score_column(text_cnn.train(empty, labels), F.col("text")).alias("s")).collect() == []


def test_packed_words_are_read_alike(rng):
    h = text_cnn.word_hashes("der Hund und die Katze of " + prose(rng, 200))
    back = text_cnn.unpack(text_cnn.pack(h))
    assert all((a == b).all() for a, b in zip(text_cnn._rows(back), text_cnn._rows(h)))
    assert ((back & 7) == (h & 7)).all() and not len(text_cnn.unpack(text_cnn.pack(h[:0])))


@pytest.mark.parametrize("piece", [None, 7])
def test_best_windows_give_what_pooling_gives(rng, monkeypatch, piece):
    if piece:
        monkeypatch.setattr(text_cnn, "PIECE", piece)
    net = text_cnn.Network.new(1)
    docs = [text_cnn.word_hashes(t) for t in ("one", "one two", prose(rng, 50), prose(rng, 8), "x " * 30)]
    top, first, second = text_cnn.best_windows(net, docs)
    assert np.allclose(top, net.pooled(docs), atol=1e-5)
    x = net.tables[0][first] + net.tables[1][second]
    for c, (kind, col) in enumerate(zip(*text_cnn._windows())):
        w = text_cnn.WINDOWS[kind]
        assert np.allclose((x[:, c, :w] * net.filters[kind][:, :, col]).sum(axis=(1, 2)), top[:, c], atol=1e-4)


def test_decision_points_of_a_table(spark, rng):
    rows = [(rng.randint(0, 4), float(rng.choice([0, 1, 1.5, 3, 4, 7])), rng.random() < 0.4) for _ in range(300)] + [(4, 9.0, False)] * 3
    rows = [r for r in rows if r[0] != 2] + [(2, 0.5, True)]
    y = np.array([r[2] for r in rows])
    for weight, least in ((1.0, 5), (4.0, 5), (0.1, 1), (50.0, 5)):
        got = text_cnn.decision_points(spark.createDataFrame(rows, "lang int, logit double, toxic boolean"), weight, least)
        x = np.array([r[1] for r in rows])
        lang = np.array([r[0] for r in rows])
        common = text_cnn.decision_point(x, y, weight)
        for code in range(5):
            mine = lang == code
            enough = min(y[mine].sum(), (~y[mine]).sum()) >= least
            assert got[code] == (text_cnn.decision_point(x[mine], y[mine], weight) if enough else common)


def test_every_labelled_document_and_every_word_is_learned(spark, rng, monkeypatch):
    """Beyond 10,000 documents and 4,000 words, over several slices; the words of a document seen once, far in its text, change."""
    rows = [(i, "vile" if i % 3 == 0 else "calm", i % 3 == 0) for i in range(10_600)]
    rows += [(20_000 + i, "calm " * 6_000 + f"marker{i}", True) for i in range(3)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    learned = []
    fit = text_cnn.fit
    monkeypatch.setattr(text_cnn, "fit", lambda known, *a, **k: learned.append(
        [len(text_cnn.unpack(r.h)) for r in known.select("h").collect()]) or fit(known, *a, **k))
    calibrated = []
    calibrate = text_cnn.calibrate
    monkeypatch.setattr(text_cnn, "calibrate", lambda net, known, *a: calibrated.append(
        [len(text_cnn.unpack(r.h)) for r in known.select("h").collect()]) or calibrate(net, known, *a))
    c = text_cnn.train(docs, labels, slice_docs=2_000)
    sizes = learned[0] + calibrated[0]
    assert len(sizes) == len(rows) and sorted(sizes)[-3:] == [6001] * 3
    new = text_cnn.Network.new(13)
    changed = (c.net.tables[0] != new.tables[0]).any(axis=1)
    far = [int(text_cnn._rows(text_cnn.word_hashes(f"marker{i}"))[0][0]) for i in range(3)]
    assert sum(changed[r] for r in far) >= 1
    s = c.score([text_cnn.word_hashes("calm"), text_cnn.word_hashes("vile")])
    assert s[0] < 0.3 <= s[1]


def test_slices_are_averaged(spark):
    """What two equal slices change is what one of them changes; rows of one slice alone change whole."""
    net, step = text_cnn.Network.new(3), text_cnn._Step(0.2)
    docs = [text_cnn.word_hashes(t) for t in ("vile words here", "calm words there")] * 4
    toxic = np.array([True, False] * 4)
    one, seen = text_cnn.copy.deepcopy((net, step))
    text_cnn.steps(one, seen, docs, toxic, 1.0, np.random.default_rng(0))
    rows = [u for s in range(3) for u in text_cnn._changes(one, seen, (net, step), s)]
    pdf = text_cnn.pd.DataFrame(rows, columns=["block", "slice", "at", "slices", "change"])
    for block, part in pdf.groupby("block"):
        at, n, change = text_cnn._read_update(next(text_cnn._add(part).itertuples()))
        assert (n == 3).all() and np.allclose(change / 3, text_cnn._read_update(next(part.itertuples()))[2], atol=1e-6)
