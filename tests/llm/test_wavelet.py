import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskloom.llm import wavelet
from riskloom.llm.queries import TOKENIZER


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 2), (1000, 50_257), (5000, 3), (4096, 1 << 20)])
def test_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    assert (m.decode() == ids).all()
    for i in range(0, n, max(1, n // 50)):
        v = int(ids[i])
        assert m.access(i) == v
        assert m.rank(v, i) == int((ids[:i] == v).sum())
        assert m.select(v, m.rank(v, i)) == i
        assert m.count(v) == int((ids == v).sum())
    assert m.select(0, n) == -1 and m.count(1 << 30) == 0 and m.select(1 << 30, 0) == -1
    if n:
        assert m.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()


TEXTS = ["", "a", " a", "a  b   c", "a\n\nb", "x \n y", "it's they'll\tdon't", "\n", "  ", "a b ", "été  ñ o 漢字かな 😀 ok",
         "1 2  33\n44", "a\x1cb c\x85d", "<|endoftext|> end", "a b 　 c", "a   b\tc\td", "tail\n ", "w​x y", "Ends. with, marks!! and?! #tags it's (x) a_b _c_ .. 'll can't. x' 's", " lead. x", "\nlead x.", "a.\nb,\nc",
         "Ä. ß, word.\u00a0z", "\r\n a", " ", "a' s' re'", "A.B.C. 3.14 a1. b2, ABC's."]


def test_stretches_encode_like_whole_texts():
    plain = Tokenizer.from_file(TOKENIZER)
    plain.encode_special_tokens = True
    for _ in range(2):  # unknown, then known stretches
        got = wavelet.Encoder.of(TOKENIZER).encode(TEXTS)
        assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    flat, sizes, which = wavelet.Encoder.keys(TEXTS)
    edges = [0, *sizes.cumsum().tolist()]
    for i, a, b in zip(which, edges, edges[1:]):
        assert "".join(map(wavelet.Encoder.stretch, flat[a:b].to_pylist())) == TEXTS[i]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(wavelet, "MEMO", 3)
    e = wavelet.Encoder(TOKENIZER)
    plain = Tokenizer.from_file(TOKENIZER)
    for t in ("a b c d e f", "f e d", "a b c d e f"):
        assert e.encode([t])[0].tolist() == plain.encode(t, add_special_tokens=False).ids
        assert len(e.known) <= 3 + 7  # the bound and one batch


def want_rows(rows):
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    at, out = 0, []
    for i, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_tokens", [1 << 20, 50])
def test_round_trip(make_docs, odd_rows, shard_tokens):
    shards = wavelet.write(make_docs(odd_rows, extra=True), TOKENIZER, shard_tokens=shard_tokens)
    got = sorted((tuple(r) for r in wavelet.documents(shards).collect()), key=lambda r: r[1])
    assert got == want_rows(odd_rows)
    found = sorted(r.position for r in wavelet.occurrences(shards, 2).collect())
    assert found == sorted({at + n - 1 for _, at, n, _ in got})


def test_texts_with_odd_spaces(make_docs):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)]
    got = sorted((tuple(r) for r in wavelet.documents(wavelet.write(make_docs(rows), TOKENIZER)).collect()), key=lambda r: r[1])
    assert got == want_rows(rows)


def test_empty_table(make_docs):
    assert wavelet.documents(wavelet.write(make_docs([]), TOKENIZER)).collect() == []


def test_added_tokens_as_the_library_reads_them(spark, make_docs, tmp_path):
    import corpus_pipeline
    from riskloom.llm import queries

    texts = [*TEXTS, "<|endoftext|>", "a<|endoftext|>b. <|endoftext|>\n\nc", "<|endoftext|", "x <|endoftext|><|endoftext|> "]
    make_docs([(i, t, "s") for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    library, at, want = Tokenizer.from_file(TOKENIZER), 0, []
    for i, t in enumerate(texts):
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, queries.op3_wavelet_tokens(spark, str(tmp_path)).collect())) == want
    docs = queries.table(spark, str(tmp_path), "documents")
    assert sorted(map(tuple, corpus_pipeline.token_ids(spark, docs, "").collect())) == want
