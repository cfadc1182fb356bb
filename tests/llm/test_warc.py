import hashlib

import pytest

from riskloom.llm import warc
from riskloom.session import materialize


def want(rows, min_bytes=1000):
    best = {}
    for i, t in rows:
        p = (t or "").encode()
        if len(p) >= min_bytes and i is not None:
            best[p] = max(i, best.get(p, i))
    out = []
    for i, t in rows:
        p = (t or "").encode()
        to = best.get(p)
        to = None if to == i else to
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


@pytest.fixture
def pages(rng):
    from tests.llm.conftest import prose

    long, big = "x" * 999 + "é", "<p>" + prose(rng, 60_000) + "</p>"
    return [(1, long), (2, long), (9, long), (3, "y" * 999), (4, "y" * 999), (5, None), (6, ""), (7, big), (8, big),
            (10, "z" * 2000), (10, "z" * 2000), (11, "z" * 2000), (None, long), (None, "q" * 1500), (None, "q" * 1500),
            (12, "Ü\r\n\r\nWARC/1.1\r\n" * 100)]


def frame(spark, rows):
    return spark.createDataFrame([(i, f"http://h/{i}", t, "clash", 1, b"b") for i, t in rows],
                                 "page_id long, url string, html string, digest string, record int, bytes binary")


@pytest.mark.parametrize("chunk_bytes", [16 << 10, 7])
def test_round_trip(spark, pages, chunk_bytes):
    rows = pages if chunk_bytes > 100 else [r for r in pages if len(r[1] or "") < 10_000]
    got = warc.read(warc.write(frame(spark, rows), chunk_bytes=chunk_bytes)).collect()
    assert sorted(map(tuple, got), key=str) == want(rows)


def test_no_chunk_is_long_and_digests_run(spark, pages):
    rows = warc.write(frame(spark, pages), chunk_bytes=1000).orderBy("record", "chunk").collect()
    running = None
    for r in rows:
        if r.chunk == 0:
            running = hashlib.sha1()
            continue
        assert len(r.bytes) <= 1000
        running.update(r.bytes)
        assert running.hexdigest() == r.digest


def test_stream_is_a_warc_file(spark, pages):
    data = b"".join(warc.stream(warc.write(frame(spark, pages), chunk_bytes=100).orderBy("record", "chunk").toLocalIterator()))
    at, found = 0, []
    while at < len(data):  # a plain reader
        end = data.index(b"\r\n\r\n", at) + 4
        head = warc.parse_header(data[at:end])
        n = int(head["Content-Length"])
        found.append((head["WARC-Type"], hashlib.sha1(data[end:end + n]).hexdigest(), head["WARC-Payload-Digest"][5:]))
        assert data[end + n:end + n + 4] == b"\r\n\r\n"
        at = end + n + 4
    assert len(found) == len(pages)
    assert all(body == said for kind, body, said in found if kind == "response")


def test_damage_is_found(spark, pages):
    archive = warc.write(frame(spark, pages), chunk_bytes=100)
    for sql in ("chunk <> 3", "true"):
        broken = archive.filter(sql).selectExpr(
            "record", "chunk", "case when chunk = 2 and true = %s then cast('!' as binary) else bytes end as bytes" % (sql == "true"), "digest")
        with pytest.raises(Exception, match="does not follow|damaged|not what its header"):
            warc.read(materialize(broken, "broken")).collect()


def test_empty_table(spark):
    assert warc.read(warc.write(frame(spark, []))).collect() == []


def read_plainly(data):
    """(headers, body) per record, by the mail parser of the standard library."""
    from email.parser import BytesHeaderParser

    at, out = 0, []
    while at < len(data):
        line = data.index(b"\r\n", at)
        assert data[at:line] == b"WARC/1.1"
        end = data.index(b"\r\n\r\n", line)
        head = BytesHeaderParser().parsebytes(data[line + 2:end + 4])
        body = data[end + 4:end + 4 + int(head["Content-Length"])]
        at = end + 4 + len(body)
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
        out.append((head, body))
    return out


def test_another_reader_can_follow_revisits(spark, pages):
    import uuid

    rows = list(dict.fromkeys(pages))  # ids are one to a record but for repeated rows
    archive = warc.write(frame(spark, rows), chunk_bytes=100, date="2024-05-06T07:08:09Z")
    found = read_plainly(b"".join(warc.stream(archive.orderBy("record", "chunk").toLocalIterator())))
    by_id = {head["WARC-Record-ID"]: (head, body) for head, body in found}
    assert len(by_id) == len(found) == len(rows)
    for head, body in found:
        uuid.UUID(head["WARC-Record-ID"].removeprefix("<urn:uuid:").removesuffix(">"))
        assert head["WARC-Date"] == "2024-05-06T07:08:09Z"
        page = head["X-Page-ID"]
        assert head["WARC-Target-URI"] == f"http://h/{page}" or page == "-" and head["WARC-Target-URI"] == "http://h/None"
        if head["WARC-Type"] == "revisit":
            other, payload = by_id[head["WARC-Refers-To"]]
            assert other["WARC-Type"] == "response" and other["X-Page-ID"] == head["X-Refers-To-Page-ID"]
            assert (other["WARC-Target-URI"], other["WARC-Date"]) == (head["WARC-Refers-To-Target-URI"], head["WARC-Refers-To-Date"])
            assert "sha1:" + hashlib.sha1(payload).hexdigest() == head["WARC-Payload-Digest"] and body == b""
    assert sum(head["WARC-Type"] == "revisit" for head, _ in found) == sum(r[3] == "revisit" for r in want(rows)) > 2


def test_urls(spark):
    """Null, empty, long and odd urls; no url column; one page on two urls."""
    big = "x" * 1500
    urls = [(1, None, "a"), (2, "", "b"), (3, "http://h/" + "u" * 100_000, "c"), (4, "http://h/é x\r\nA: b", "d"),
            (5, "http://h/%20?q=1#f", "e"), (6, "http://h/1", big), (7, "http://h/a", big), (7, "http://h/b", big), (None, None, "f")]
    df = spark.createDataFrame(urls, "page_id long, url string, html string")
    found = read_plainly(b"".join(warc.stream(warc.write(df).orderBy("record", "chunk").toLocalIterator())))
    said = {(h["X-Page-ID"], b): h["WARC-Target-URI"] for h, b in found if h["X-Page-ID"] != "7"}
    assert said == {("1", b"a"): "urn:page:1", ("2", b"b"): "urn:page:2", ("3", b"c"): urls[2][1], ("4", b"d"): "http://h/%C3%A9%20x%0D%0AA:%20b",
                    ("5", b"e"): "http://h/%20?q=1#f", ("6", b""): "http://h/1", ("-", b"f"): "urn:page:-"}
    by_id = {h["WARC-Record-ID"]: h for h, _ in found}
    revisit = [h for h, _ in found if h["WARC-Type"] == "revisit"]
    assert len(by_id) == 9 and [h["X-Page-ID"] for h in revisit] == ["6"]
    assert by_id[revisit[0]["WARC-Refers-To"]]["WARC-Target-URI"] == "http://h/b"
    assert {h["WARC-Target-URI"] for h, _ in read_plainly(b"".join(warc.stream(
        warc.write(df.drop("url").limit(2)).orderBy("record", "chunk").toLocalIterator())))} <= {f"urn:page:{i}" for i in [*range(1, 8), "-"]}
