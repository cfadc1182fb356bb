"""WARC archives as tables of chunks.

A record is a header chunk (number 0) and the payload in chunks of at most ``chunk_bytes``
bytes; a row is (record, chunk, bytes, digest), where ``digest`` is the SHA-1
of the payload so far.  Writing and reading stream over chunks, carrying one
running digest, so no task holds a second copy of a large payload.  Read in
record and chunk order, the bytes are a WARC/1.1 file (``stream``): every record has its id, date and
target, and a revisit names the id, target and date of the response it stands for.

Records with equal payloads of at least ``min_bytes`` are stored once: the one with the
largest id is the response, the others are revisits, which refer to it and
have no body; their header keeps the digest and length of the full payload.

Record ids are UUIDs made from a row's id, url and payload, so they can be known without the record.

Defined cases: a null payload is empty; equal payloads are those with equal
SHA-1 and length; rows that tie on the largest id are all responses, and revisits name that with the last url; a row with
a null id never becomes what others refer to, unless all are null (then all are responses);
repeated rows are separate records with one record id; an empty table gives an empty archive.  A null, empty or missing url
is the target ``urn:page:<id>``; characters that a header cannot hold are percent-encoded, however long the
url.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import string
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize, scratch_path

ARCHIVE = "record long, chunk int, bytes binary, digest string"
CHUNK_BYTES = 16 << 10
_BATCH_BYTES = 8 << 20
_NONE = "-"


_SAFE = string.ascii_letters + string.digits + string.punctuation


def record_id(page_id, url: str | None, sha1: str, size: int, kind: str) -> str:
    said = repr((page_id, url, sha1, size, kind)).encode("utf-8", "surrogatepass")
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(said).digest()[:16], version=5)}>"


def target_uri(page_id, url: str | None) -> str:
    return quote(url, safe=_SAFE, errors="surrogatepass") if url else f"urn:page:{_NONE if page_id is None else page_id}"


def _header(page_id, url, kind: str, digest: str, size: int, date: str, target, target_url) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, url, digest, size, kind)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {target_uri(page_id, url)}", f"X-Page-ID: {_NONE if page_id is None else page_id}",
             f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {record_id(target, target_url, digest, size, 'response')}",
                  f"WARC-Refers-To-Target-URI: {target_uri(target, target_url)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page-ID: {target}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/octet-stream", f"Content-Length: {0 if kind == 'revisit' else size}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("ascii")


def parse_header(header: bytes) -> dict[str, str]:
    lines = header.decode("ascii").split("\r\n")
    if lines[0] != "WARC/1.1" or lines[-2:] != ["", ""]:
        raise ValueError("not a record header")
    return dict(x.split(": ", 1) for x in lines[1:-2])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size_of=lambda row: 64) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``_BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 1000,
            chunk_bytes: int = CHUNK_BYTES, url_col: str = "url", date: str | None = None) -> DataFrame:
    """Chunk rows of an archive of ``pages``; ``date`` (ISO 8601, UTC) is that of all records, now by default."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    url = F.col(url_col) if url_col in pages.columns else F.lit(None)
    rows = pages.select(F.col(id_col).alias("id"), url.cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload")).withColumn("sha", F.unhex(F.sha1("payload")))
    # Only digests and urls are shuffled to find equal payloads.  Written, the few groups
    # have a known size when the planner chooses how to join them to the payloads.
    groups = rows.filter(F.col("size") >= min_bytes).groupBy("sha", "size").agg(
        F.max(F.struct("id", "url")).alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 and last.id is not null")
    groups = materialize(groups.select(F.col("sha").alias("g_sha"), F.col("size").alias("g_size"), F.col("last.id").alias("target"),
                                       F.col("last.url").alias("target_url")), "warc-groups")
    rows = rows.join(groups, (F.col("sha") == F.col("g_sha")) & (F.col("size") == F.col("g_size")), "left")
    rows = rows.select("id", "url", "payload", "sha", F.when(F.col("id").eqNullSafe(F.col("target")), None).otherwise(F.col("target")).alias("target"),
                       "target_url")
    schema = pa.schema([("record", pa.int64()), ("chunk", pa.int32()), ("bytes", pa.binary()), ("digest", pa.string())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        from pyspark import TaskContext

        record = TaskContext.get().partitionId() << 33  # a number of its own for every row
        for b in batches:
            for k in range(b.num_rows):
                page, url, target = b["id"][k].as_py(), b["url"][k].as_py(), b["target"][k].as_py()
                payload = memoryview(b["payload"][k].as_buffer())  # no copy
                kind = "response" if target is None else "revisit"
                head = _header(page, url, kind, b["sha"][k].as_py().hex(), len(payload), date, target, b["target_url"][k].as_py())
                yield record, 0, head, hashlib.sha1().hexdigest()
                if kind == "response":
                    running = hashlib.sha1()
                    for i in range(0, len(payload), chunk_bytes):
                        piece = bytes(payload[i:i + chunk_bytes])
                        running.update(piece)
                        yield record, i // chunk_bytes + 1, piece, running.hexdigest()
                record += 1

    return rows.mapInArrow(lambda batches: _batches(chunks(batches), schema, lambda row: len(row[2]) + 64), ARCHIVE)


def write(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the archive of ``pages`` to ``path`` (default: an intermediate
    table) and return it as a table."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    made = records(pages, **options)
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def read(archive: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to.  Chunks stream by in order; a response's digest and length are
    taken from its chunks and must be what its header and chunks say."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def row(head: dict[str, str], size: int, running) -> tuple:
        page = None if head["X-Page-ID"] == _NONE else int(head["X-Page-ID"])
        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        target = int(head["X-Refers-To-Page-ID"]) if kind == "revisit" else None
        if kind == "response" and (running.hexdigest() != digest or size != int(head["Content-Length"])):
            raise ValueError(f"record of page {page}: the payload is not what its header says")
        return page, int(head["X-Payload-Length"]), digest, kind, target

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        head, running, size, now, last = None, None, 0, None, -1
        for b in batches:
            for k in range(b.num_rows):
                record, chunk = b["record"][k].as_py(), b["chunk"][k].as_py()
                data = b["bytes"][k].as_buffer()
                if chunk == 0:
                    if head is not None:
                        yield row(head, size, running)
                    head, running, size, now, last = parse_header(data.to_pybytes()), hashlib.sha1(), 0, record, 0
                    continue
                if record != now or chunk != last + 1:
                    raise ValueError(f"record {record}: chunk {chunk} does not follow")
                running.update(data)
                size, last = size + data.size, chunk
                if running.hexdigest() != b["digest"][k].as_py():
                    raise ValueError(f"record {record}: chunk {chunk} is damaged")
        if head is not None:
            yield row(head, size, running)

    ordered = archive.repartition("record").sortWithinPartitions("record", "chunk")
    return ordered.mapInArrow(lambda batches: _batches(parse(batches), schema),
                              "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def stream(rows: Iterator) -> Iterator[bytes]:
    """The bytes of a WARC file from chunk rows in (record, chunk) order."""
    begun = False
    for r in rows:
        if r["chunk"] == 0 and begun:
            yield b"\r\n\r\n"
        begun = True
        yield bytes(r["bytes"])
    if begun:
        yield b"\r\n\r\n"
