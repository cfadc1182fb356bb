"""Token ids in wavelet-matrix shards.

``encode`` tokenizes whole texts, appends an end id to each document and packs
the ids, in ascending document order, into shards of about ``shard_tokens``
ids.  A shard is one compressed blob: for each bit of the ids, from the highest, a plane of
one bit per position and cumulative counts for rank; below each plane the
positions are stably reordered zeros first (a wavelet matrix).  A blob alone
answers ``access`` (the id at a position), ``count``/``rank`` (how often an id
occurs in a prefix) and ``select`` (where its n-th occurrence is) without
decoding the sequence.  Its directory says which stretch of
which document lies where.  Documents are never cut: one that is longer than a
shard has a shard of its own.

Blobs are rows of a Parquet table (one row is one shard), which Spark can
write to and read from any store.  ``documents`` reads such a table back.

Work is spread by ranges of document ids.  Inside a task, texts stream
through in batches, so the memory needed is one batch and one shard.  The tokenizer
runs on stretches between white space that sits between non-space
characters: no token of a byte-level tokenizer that splits words before their
blank reaches across such a place, so each distinct stretch needs encoding only once per
worker (a bounded memory of ``MEMO`` stretches).

The strings of the file's added tokens (as ``<|endoftext|>``) are ordinary text unless ``added_tokens``
is set (op3 and the pipeline set it): then they become those tokens' ids, as the library does by itself, and a
text that holds one goes through the library whole.

Defined cases: a null text is empty and has the end id alone; rows that tie on the id go
by a hash of their text; null ids come first; repeated rows are separate documents; an empty table gives
no shards.  Only the named columns are read.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import scratch_path, shuffle_partitions

MEMO = 1_000_000
SHARD_TOKENS = 1 << 20
_MAGIC = b"WMX1"
_RANK_STEP = 512  # bits between two stored rank counts
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
# two separators in a row or at an end, or white space that is neither blank nor newline
_ODD = ("[ \\n][ \\n]|^[ \\n]|[ \\n]$|[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}"
        "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]")
_MARKS = string.punctuation
_LETTERS = re.compile("[A-Za-zªµºÀ-ÖØ-öø-ÿ]+").fullmatch


def _alphabet() -> dict[int, str]:
    """The byte alphabet of byte-level tokenizers: visible Latin-1 characters stand for
    themselves, the other bytes for U+0100 and following, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    return {b: chr(256 + k) for k, b in enumerate(others)}


_ALPHABET = _alphabet()
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.int64)


class WaveletMatrix:
    """A sequence of non-negative integers as succinct bit planes."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], counts: list[np.ndarray]) -> None:
        self.n, self.planes, self.zeros, self.counts = n, planes, zeros, counts

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) if len(ids) else 0
        width = max(1, top.bit_length())
        values = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes, zeros, counts = [], [], []
        for bit in range(width - 1, -1, -1):
            ones = ((values >> bit) & 1).astype(bool)
            plane = np.packbits(ones)
            planes.append(plane)
            counts.append(cls._counts(plane))
            rest = values[~ones]
            zeros.append(len(rest))
            values = np.concatenate((rest, values[ones]))
        return cls(len(ids), planes, zeros, counts)

    @staticmethod
    def _counts(plane: np.ndarray) -> np.ndarray:
        step = _RANK_STEP // 8
        per = np.bitwise_count(np.pad(plane, (0, -len(plane) % step))).reshape(-1, step).sum(axis=1, dtype=np.int64)
        return np.concatenate(([0], np.cumsum(per))).astype(np.uint32)

    def to_bytes(self) -> bytes:
        body = b"".join(p.tobytes() for p in self.planes) + b"".join(c.tobytes() for c in self.counts)
        head = _MAGIC + struct.pack("<IH", self.n, len(self.planes)) + np.array(self.zeros, "<u4").tobytes()
        return head + pa.compress(body, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        if blob[:4] != _MAGIC:
            raise ValueError("not a wavelet-matrix shard")
        n, width = struct.unpack_from("<IH", blob, 4)
        zeros = np.frombuffer(blob, "<u4", width, 10).tolist()
        size = -(-n // 8)
        marks = -(-size // (_RANK_STEP // 8)) + 1
        body = pa.decompress(blob[10 + 4 * width:], width * (size + 4 * marks), codec="zstd", asbytes=True)
        planes = [np.frombuffer(body, np.uint8, size, i * size) for i in range(width)]
        counts = [np.frombuffer(body, "<u4", marks, width * size + 4 * marks * i) for i in range(width)]
        return cls(n, planes, zeros, counts)

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` positions of a plane."""
        mark = i // _RANK_STEP
        byte = i // 8
        bits = self.planes[plane]
        total = int(self.counts[plane][mark]) + int(_POPCOUNT[bits[mark * (_RANK_STEP // 8):byte]].sum())
        return total + (int(_POPCOUNT[bits[byte] >> (8 - i % 8)]) if i % 8 else 0)

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][i // 8]) >> (7 - i % 8) & 1

    def access(self, i: int) -> int:
        value = 0
        for p in range(len(self.planes)):
            bit = self._bit(p, i)
            ones = self._rank1(p, i)
            i = self.zeros[p] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _narrow(self, value: int, i: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` among the first ``i`` positions
        lie below the last plane: [from, to)."""
        lo, hi = 0, i
        for p in range(len(self.planes)):
            a, b = self._rank1(p, lo), self._rank1(p, hi)
            if value >> (len(self.planes) - 1 - p) & 1:
                lo, hi = self.zeros[p] + a, self.zeros[p] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, value: int, i: int) -> int:
        """Occurrences of ``value`` among the first ``i`` positions."""
        if value < 0 or value >> len(self.planes):
            return 0
        lo, hi = self._narrow(value, i)
        return hi - lo

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, nth: int) -> int:
        """Position of the ``nth`` occurrence (from 0) of ``value``; -1 if there
        are not that many."""
        if value < 0 or value >> len(self.planes):
            return -1
        lo, hi = self._narrow(value, self.n)
        if not 0 <= nth < hi - lo:
            return -1
        i = lo + nth
        for p in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - p) & 1
            i = self._select_bit(p, one, i - self.zeros[p] if one else i)
        return i

    def _select_bit(self, plane: int, bit: int, nth: int) -> int:
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._rank1(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) > nth:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def decode(self) -> np.ndarray:
        """The whole sequence: planes are undone from the lowest upwards."""
        values = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for p in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[p], count=self.n).view(bool)
            above = np.empty_like(values)
            above[~ones] = values[:self.zeros[p]]
            above[ones] = values[self.zeros[p]:] | values.dtype.type(1 << (len(self.planes) - 1 - p))
            values = above
        return values.astype(np.uint32)


_FIRST = "\r"  # marks a stretch at a text's start; other white space never begins a key


class Encoder:
    """Texts to ids with a byte-level BPE tokenizers file, remembering stretches.

    A text is cut before single blanks and newlines that stand between other
    characters.  The key of a stretch is what follows its blank, or the newline
    and what follows, or ``_FIRST`` and the text's first stretch.
    """

    _made: dict[tuple[str, bool], Encoder] = {}

    def __init__(self, path: str, added_tokens: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens  # else their strings in a text are ordinary text
        self.whole = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self._newline = self._piece("\n")
        self._forget()

    @classmethod
    def of(cls, path: str, added_tokens: bool = False) -> Encoder:
        """One per worker process, so that what it remembers serves later tasks."""
        if (path, added_tokens) not in cls._made:
            cls._made[path, added_tokens] = cls(path, added_tokens)
        return cls._made[path, added_tokens]

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)  # of each known stretch in ids
        self.pieces: dict[str, list[int]] = {}  # of endings like "." and "!!"

    @staticmethod
    def keys(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(keys of all texts, number of keys per text, which texts): texts with
        uncommon white space come last."""
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
        common, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
        marked = pc.binary_join_element_wise(_FIRST, column.take(pa.array(common)), "")
        lists = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        cut = [Encoder.cut(texts[i]) for i in rest]
        sizes = np.concatenate((np.diff(lists.offsets.to_numpy()), np.fromiter(map(len, cut), np.int64, len(cut))))
        flat = pa.concat_arrays([lists.flatten(), pa.array(list(chain.from_iterable(cut)), pa.string())])
        return flat, sizes, np.concatenate((common, rest))

    @staticmethod
    def cut(text: str) -> list[str]:
        """Keys of any text."""
        out = [s[1:] if s[:1] == " " else s for s in _CUT.split(text)]
        if text[:1] == " ":  # the first stretch keeps its blank
            out[0] = " " + out[0]
        out[0] = _FIRST + out[0]
        return out

    @staticmethod
    def stretch(key: str) -> str:
        return key[1:] if key[0] == _FIRST else key if key[0] == "\n" else " " + key

    def _piece(self, piece: str) -> list[int]:
        """Ids of one word or run of marks."""
        in_bytes = piece if piece.isascii() and " " not in piece and "\n" not in piece else \
            piece.encode().decode("latin-1").translate(_ALPHABET)
        return [t.id for t in self.tokenizer.model.tokenize(in_bytes)]

    def _plain(self, key: str) -> list[int] | None:
        """Ids of a stretch that is letters and then ASCII marks, which the tokenizer
        splits there and after a newline; None for other stretches."""
        word = key.rstrip(_MARKS)
        head = word[:1]
        if not _LETTERS(word[1:] if head in (_FIRST, "\n") else word):
            return None
        tail = key[len(word):]
        if tail not in self.pieces:
            self.pieces[tail] = self._piece(tail) if tail else []
        at = self.known.get(word) if tail else None
        if at is not None:
            return self.ids[self.ends[at - 1] if at else 0:self.ends[at]].tolist() + self.pieces[tail]
        found = self._newline + self._piece(word[1:]) if head == "\n" else \
            self._piece(word[1:] if head == _FIRST else " " + word)
        return found + self.pieces[tail]

    def _learn(self, new: list[str]) -> None:
        lists = [self._plain(k) for k in new]
        rest = [i for i, x in enumerate(lists) if x is None]
        found = self.tokenizer.encode_batch_fast([self.stretch(new[i]) for i in rest], add_special_tokens=False)
        for i, e in zip(rest, found):
            lists[i] = e.ids
        k, n = len(self.known), len(self.known) + len(new)
        start = int(self.ends[k - 1]) if k else 0
        ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists))) + start
        if n > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros(max(n, len(self.ends)), np.int64)))
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(max(int(ends[-1]), len(self.ids)), np.uint32)))
        self.ids[start:int(ends[-1])] = np.fromiter(chain.from_iterable(lists), np.uint32, int(ends[-1]) - start)
        self.ends[k:n] = ends
        self.known.update(zip(new, range(k, n)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        held = [i for i, t in enumerate(texts) if any(w in t for w in self.whole)]
        if not held:
            return self._encode(texts)
        lib = self.tokenizer.encode_batch_fast([texts[i] for i in held], add_special_tokens=False)
        whole = {i: np.array(e.ids, np.uint32) for i, e in zip(held, lib)}
        rest = [t for i, t in enumerate(texts) if i not in whole]
        others = iter(self._encode(rest) if rest else [])
        return [whole[i] if i in whole else next(others) for i in range(len(texts))]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        flat, sizes, which = self.keys(texts)
        if len(self.known) > MEMO:
            self._forget()
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if new := [k for k in distinct if k not in self.known]:
            self._learn(new)
        places = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        codes = places[coded.indices.to_numpy()]
        ends = self.ends[codes]
        starts = np.where(codes > 0, self.ends[codes - 1], 0)
        lengths = ends - starts
        before = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.ids[np.arange(before[-1]) + np.repeat(starts - before[:-1], lengths)]
        edges = before[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        out: list[np.ndarray] = [None] * len(texts)
        for i, a, z in zip(which.tolist(), edges, edges[1:]):
            out[i] = ids[a:z]
        return out


SHARDS = "part int, shard int, n_tokens long, doc_ids array<long>, doc_sizes array<int>, blob binary"


def encode(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
           shard_tokens: int = SHARD_TOKENS, batch_chars: int = 4_000_000, added_tokens: bool = False) -> DataFrame:
    """Shard rows of ``docs``: their part (an id range), number within it,
    directory and blob."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        encoder = Encoder.of(tokenizer, added_tokens)
        ids: list[np.ndarray] = []  # documents not yet in a shard
        keys: list[int | None] = []
        held = 0

        def close() -> pd.DataFrame:
            blob = WaveletMatrix.build(np.concatenate(ids)).to_bytes()
            return pd.DataFrame({"part": [part], "shard": [shard], "n_tokens": [held], "doc_ids": [keys],
                                 "doc_sizes": [[len(x) for x in ids]], "blob": [blob]})

        for key, found in _tokens(batches, encoder, end_id, batch_chars):
            if held and held + len(found) > shard_tokens:
                yield close()
                ids, keys, held, shard = [], [], 0, shard + 1
            ids.append(found)
            keys.append(key)
            held += len(found)
        if held:
            yield close()

    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # ties by a hash: the range exchange samples its keys, which should be short
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ranges = texts.repartitionByRange(shuffle_partitions(docs.sparkSession), *order)
    return ranges.sortWithinPartitions(*order).mapInPandas(pack, SHARDS)


def _tokens(batches: Iterator[pd.DataFrame], encoder: Encoder, end_id: int,
            batch_chars: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each row's id and its text's ids with the end id."""
    for b in batches:
        texts, keys = b["text"].tolist(), b["doc_id"].tolist()
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= batch_chars):
                chars += len(texts[j])
                j += 1
            for key, ids in zip(keys[i:j], encoder.encode(texts[i:j])):
                yield None if pd.isna(key) else int(key), np.append(ids, np.uint32(end_id))
            i = j


def documents(shards: DataFrame) -> DataFrame:
    """Per document of a shard table, read from the blobs: doc_id, start (ids
    of all documents before it), n_tokens, ids_crc32."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                raw = WaveletMatrix.from_bytes(row["blob"]).decode().astype("<u4", copy=False)
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                if ends[-1] != len(raw):
                    raise ValueError("a shard's directory does not add up to its ids")
                starts, k = ends - sizes, len(sizes)
                crcs = [zlib.crc32(raw[a:z]) for a, z in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]] * k, pa.int32()), "shard": pa.array([row["shard"]] * k, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "at": pa.array(starts),
                    "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crcs, pa.int64())})

    found = shards.select("part", "shard", "doc_ids", "doc_sizes", "blob").mapInArrow(
        read, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(shard_starts(shards), ["part", "shard"]).select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): the ids in all shards before.  Two levels,
    so that one task sees the shards of a part, or one row per part."""
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before_shard = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before_part), F.lit(0)).alias("part_start"))
    inside = sizes.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before_shard), F.lit(0)).alias("inside"))
    return inside.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("inside")).alias("shard_start"))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(position) of every occurrence of an id in the whole sequence, by select
    on the shards' blobs."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples(index=False):
                at = WaveletMatrix.from_bytes(row.blob).occurrences(token)
                yield pd.DataFrame({"part": row.part, "shard": row.shard, "at": pd.array(at, dtype="int64")})

    hits = shards.select("part", "shard", "blob").mapInPandas(find, "part int, shard int, at long")
    return hits.join(shard_starts(shards), ["part", "shard"]).select((F.col("shard_start") + F.col("at")).alias("position"))


def write(docs: DataFrame, tokenizer: str, path: str | None = None, **options) -> DataFrame:
    """Write the shards of ``docs`` to ``path`` (default: an intermediate table)
    and return the table."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-shards")
    shards = encode(docs, tokenizer, **options)
    # a shard is compressed already; small row groups let several tasks read one file
    shards.write.option("compression", "none").option("parquet.block.size", 8 << 20).parquet(path)
    return spark.read.schema(shards.schema).parquet(path)
