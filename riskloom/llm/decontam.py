"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are sequences of words (lower-cased runs of digits, letters and non-ASCII
characters; in scripts written without blanks every character is a word, and their
punctuation separates).  An item leaks into a document if some stretch of the document
is within ``e`` word insertions, deletions or replacements of it, ``e`` being ``rate`` of
the item's length.  Cut into ``e + 1`` pieces, an item within the budget leaves one piece
intact; so all exact piece hits (one Aho-Corasick pass over the whole text) point to all
candidates, and Myers' bit-parallel distance verifies the stretch around each.

The items are read in blocks of at most ``block_items``, each of which is broadcast (its
size is bounded) and gets one pass over the documents.  Documents are not shuffled.  A passage that very many
documents share costs each of them its own hits only: windows that overlap are merged
and verified once.

Defined cases: null and empty texts and items without a word match nothing; items with fewer than
``min_words`` words must occur exactly; repeated rows of documents or items give repeated pairs; of several
stretches the closest counts, then the first; texts of any length are searched whole, one
at a time in their task's memory; empty documents or items give an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import licenses

RATE = 0.2
MIN_WORDS = 5

# Thai, Lao, Tibetan, Myanmar; Khmer; Tai scripts, Balinese; CJK radicals, ideographs, kana, bopomofo; Yi;
# Javanese, Myanmar and Tai extensions; compatibility ideographs; half-width kana; ideographs and kana beyond U+FFFF
_UNSPACED = ("\u0e00-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u1b00-\u1b7f\u2e80-\u2fdf\u3005-\u3007\u3021-\u302f"
             "\u3031-\u303c\u3041-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf\ua980-\ua9ff"
             "\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U0003ffff")
_STOPS = ("\u0e5a\u0e5b\u0f0b-\u0f14\u104a\u104b\u17d4-\u17da\u3000-\u3003\u3008-\u3020\u3030\u303d\u30a0\u30fb"
          "\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65")
_APART = re.compile(f"[{_STOPS}]+|([{_UNSPACED}])[\u200b-\u200d\u2060\ufe00-\ufe0f\ufeff\U000e0100-\U000e01ef]*")


def words(text: str | None) -> list[bytes]:
    """Lower-cased (in any script) runs of digits, letters and non-ASCII characters;
    single characters of scripts written without blanks."""
    if not text:
        return []
    text = text.lower()
    return licenses.words(text if text.isascii() else _APART.sub(r" \1 ", text))


def pieces(n: int, budget: int) -> list[tuple[int, int]]:
    """``budget + 1`` stretches [a, b) that cover ``n`` words."""
    k = budget + 1
    edges = [i * n // k for i in range(k + 1)]
    return list(zip(edges, edges[1:]))


def myers(pattern: list[bytes], text: list[bytes], budget: int) -> tuple[int, int] | None:
    """(distance, end) of the stretch of ``text`` closest to ``pattern``, the
    first of equals, if within ``budget``.  One bit per pattern word."""
    m = len(pattern)
    where: dict[bytes, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m  # vertical differences
    best = None
    for j, w in enumerate(text):
        match = where.get(w, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = (minus | ~(diagonal | plus)) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full  # a match may begin anywhere
        plus = (down | ~(diagonal | up)) & full
        minus = up & diagonal
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Matcher:
    """The pieces of a block of items, and what to verify at a hit."""

    _made: tuple[str, Matcher] | None = None

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_words: int) -> None:
        import ahocorasick

        self.items: list[tuple[int | None, list[bytes], int]] = []
        self.automaton = ahocorasick.Automaton()
        for key, text in items:
            found = words(text)
            if not found:
                continue
            budget = int(rate * len(found)) if len(found) >= min_words else 0
            for a, b in pieces(len(found), budget):
                # one character per byte, blanks around: whole words only
                piece = (b" " + b" ".join(found[a:b]) + b" ").decode("latin-1")
                length, targets = self.automaton.get(piece, (len(piece), []))
                targets.append((len(self.items), a))
                self.automaton.add_word(piece, (length, targets))
            self.items.append((key, found, budget))
        if self.items:
            self.automaton.make_automaton()

    @classmethod
    def of(cls, name: str, items: list, rate: float, min_words: int) -> Matcher:
        """One per worker process and block of items."""
        if cls._made is None or cls._made[0] != name:
            cls._made = (name, cls(items, rate, min_words))
        return cls._made[1]

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item, distance, end word, item words) for each item that leaks into the text."""
        if not text or not self.items:
            return []
        found = words(text)
        joined = (b" " + b" ".join(found) + b" ").decode("latin-1")
        hits = [(end - length + 1, targets) for end, (length, targets) in self.automaton.iter(joined)]
        if not hits:
            return []
        blanks = [i for i, c in enumerate(joined) if c == " "]
        spans: dict[int, list[list[int]]] = {}
        for at, targets in hits:
            word = bisect.bisect_left(blanks, at)
            for item, offset in targets:
                _, pattern, budget = self.items[item]
                spans.setdefault(item, []).append(
                    [max(0, word - offset - budget), min(len(found), word - offset + len(pattern) + budget)])
        out = []
        for item in sorted(spans):
            key, pattern, budget = self.items[item]
            merged: list[list[int]] = []
            for a, b in sorted(spans[item]):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            best = None
            for a, b in merged:
                got = myers(pattern, found[a:b], budget)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], a + got[1])
            if best:
                out.append((key, best[0], best[1], len(pattern)))
        return out


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                block_items: int = 20_000) -> Iterator[list[tuple[int | None, str]]]:
    """The items, in blocks of bounded size; one block is on the driver at a time."""
    held: list[tuple[int | None, str]] = []
    for r in benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")) \
            .filter(F.col("text").isNotNull()).orderBy("item", "text").toLocalIterator():
        held.append((r.item, r.text))
        if len(held) == block_items:
            yield held
            held = []
    if held:
        yield held


HIT = "struct<item_id:bigint,distance:int,end_word:bigint,item_words:int>"


def leak_column(spark, text: Column, items: list[tuple[int | None, str]], rate: float = RATE,
                min_words: int = MIN_WORDS) -> Column:
    """An array of ``HIT`` for each text, against one block of items."""
    import uuid

    shared, name = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    @F.pandas_udf(f"array<{HIT}>")
    def run(texts: pd.Series) -> pd.Series:
        matcher = Matcher.of(name, shared.value, rate, min_words)
        return pd.Series([[dict(zip(("item_id", "distance", "end_word", "item_words"), h)) for h in matcher.find(t)]
                          for t in texts], dtype=object)

    return run(text)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE,
          min_words: int = MIN_WORDS, **blocks) -> DataFrame:
    """(doc_id, item_id, distance, end_word, item_words) for every document and
    item that leaks into it; ``end_word`` is where the closest stretch ends."""
    spark = docs.sparkSession
    parts = [docs.select(F.col(id_col).alias("doc_id"), F.explode(
        leak_column(spark, F.col(text_col), items, rate, min_words)).alias("hit")).select("doc_id", "hit.*")
        for items in item_blocks(benchmark, **blocks)]
    if not parts:
        return docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast(HIT).alias("hit")).select("doc_id", "hit.*").limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = RATE,
          min_words: int = MIN_WORDS, **blocks) -> DataFrame:
    """The rows of ``docs`` into which no item leaks."""
    for items in item_blocks(benchmark, **blocks):
        docs = docs.filter(F.size(leak_column(docs.sparkSession, F.col(text_col), items, rate, min_words)) == 0)
    return docs
