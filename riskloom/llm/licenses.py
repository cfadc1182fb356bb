r"""License scans: phrases, and an exact set-similarity join with notices.

Words are runs of digits, letters and non-ASCII characters of the lower-cased
text.  The base scan finds places where a phrase's words stand next to each
other.  The method adds labels by containment: a text block matches a template
notice if it holds at least ``threshold`` of the notice's distinct words.  Blocks are
windows of ``2 * span`` words that start every ``span`` words, so any stretch of ``span``
words lies whole in a block, whatever its line breaks.  A template of more words has blocks of its own size:
``span`` is doubled until it holds the template.

The join is exact and filtered: the templates' words are ordered by the number of
blocks in the whole corpus that hold them, rare first.  A block that shares ``a`` of a template's ``t``
words holds one of its ``t - a + 1`` rarest (prefix filter); a block with fewer than ``a``
distinct words is out (length filter).  With the i-th rarest of the template as the first one shared, which is
the j-th of the ``k`` words of the block that are in any template, at most ``t - i`` and ``k - j`` can be
(positional filter).  Only the rest are counted.
Templates are a fixed small parameter, so blocks never leave the task that reads
their text; nothing is shuffled but the words' counts.

Defined cases: a null or empty text has no words, no labels and score 0; a very long text is scanned whole, block by
block; repeated rows give repeated rows; an empty table gives an empty result; a template without words matches nothing;
equal counts are ordered by the word.  The score is 1 for a phrase, else the best containment
that reaches the threshold, else 0.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 128

# Openings of public license notices, and whole short ones.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer",
    ),
    "gpl-family": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
}

# bytes: A-Z to a-z; 0-9, a-z and 0x80-0xFF stay; the rest separates words
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if text else []


def blocks(found: list[bytes], span: int = SPAN) -> Iterator[set[bytes]]:
    for i in range(0, max(1, len(found) - span), span):
        yield set(found[i:i + 2 * span])


def spans(templates: dict[str, tuple[str, ...]], span: int = SPAN) -> dict[int, dict[str, tuple[str, ...]]]:
    """The templates by the span of their blocks: ``span``, doubled until it holds the template."""
    out: dict[int, dict[str, tuple[str, ...]]] = {}
    for label, texts in templates.items():
        for text in texts:
            n = len(words(text))
            size = span
            while size < n:
                size *= 2
            if n:
                of = out.setdefault(size, {})
                of[label] = (*of.get(label, ()), text)
    return dict(sorted(out.items()))


def block_counts(docs: DataFrame, vocabulary: dict[int, set[bytes]], text_col: str = "text") -> dict[int, dict[bytes, int]]:
    """For each span the blocks of the corpus that hold each word of ``vocabulary[span]`` (the
    templates' words, so the result is as small as they are)."""
    lookup = {span: frozenset(known) for span, known in vocabulary.items()}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {span: dict.fromkeys(sorted(known), 0) for span, known in lookup.items()}
        for b in batches:
            for text in b["text"]:
                found = words(text)
                for span, known in lookup.items():
                    for block in blocks(found, span):
                        for w in block & known:
                            total[span][w] += 1
        flat = [(span, w, n) for span, counts in total.items() for w, n in counts.items()]
        yield pd.DataFrame(flat, columns=["span", "word", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "span int, word binary, n long")
    out: dict[int, dict[bytes, int]] = {span: {} for span in vocabulary}
    for r in rows.groupBy("span", "word").agg(F.sum("n").alias("n")).collect():
        out[r.span][bytes(r.word)] = r.n
    return out


class Notices:
    """Template word sets of one span with their prefix index.  Words are known by their place in the global order."""

    def __init__(self, templates: dict[str, tuple[str, ...]], counts: dict[bytes, int], threshold: float) -> None:
        sets = [(label, set(words(text))) for label in sorted(templates) for text in templates[label]]
        order = sorted(set().union(*(w for _, w in sets)), key=lambda w: (counts.get(w, 0), w))
        self.place = {w: i for i, w in enumerate(order)}
        self.vocabulary = frozenset(order)
        self.items = []
        self.index: dict[int, list[tuple[int, int]]] = {}
        for label, notice in sets:
            ordered = sorted(self.place[w] for w in notice)
            need = ceil(threshold * len(ordered) - 1e-9)
            for i in range(len(ordered) - need + 1):
                self.index.setdefault(ordered[i], []).append((len(self.items), i))
            self.items.append((label, frozenset(ordered), need))
        self.rare = frozenset(order[i] for i in self.index)

    def best(self, block: set[bytes]) -> dict[str, float]:
        """Containment per label, of the notices that reach the threshold."""
        out: dict[str, float] = {}
        if self.rare.isdisjoint(block):
            return out
        known = sorted(self.place[w] for w in block & self.vocabulary)
        first: dict[int, tuple[int, int]] = {}
        for j, place in enumerate(known):
            for item, i in self.index.get(place, ()):
                first.setdefault(item, (i, j))
        for item, (i, j) in first.items():
            label, notice, need = self.items[item]
            if len(block) >= need and min(len(notice) - i, len(known) - j) >= need and (shared := len(notice.intersection(known))) >= need:
                out[label] = max(out.get(label, 0.0), shared / len(notice))
        return out


RESULT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_text(text: str | None, phrases: dict[str, str], notices: dict[int, Notices]) -> tuple:
    found = words(text)
    joined = b" " + b" ".join(found) + b" "
    starts, base = [], set()
    for phrase, label in phrases.items():
        wanted = b" " + b" ".join(words(phrase)) + b" "
        at = joined.find(wanted)
        place = joined.count(b" ", 0, max(at, 0))
        while at >= 0:
            starts.append(place)
            base.add(label)
            after = joined.find(wanted, at + 1)
            place += joined.count(b" ", at, max(after, at))
            at = after
    labels: dict[str, float] = {}
    for span, of in notices.items():
        for block in blocks(found, span):
            for label, share in of.best(block).items():
                labels[label] = max(share, labels.get(label, 0.0))
    return (len(found), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(labels))), 1.0 if base else max(labels.values(), default=0.0))


def scan(docs: DataFrame, phrases: dict[str, str], templates: dict[str, tuple[str, ...]] | None = None,
         threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN) -> DataFrame:
    """doc_id and the fields of ``RESULT`` per row of ``docs``."""
    by_span = spans(TEMPLATES if templates is None else templates, span)
    vocabulary = {size: {w for texts in of.values() for t in texts for w in words(t)} for size, of in by_span.items()}
    counts = block_counts(docs, vocabulary, text_col)
    notices = {size: Notices(of, counts[size], threshold) for size, of in by_span.items()}
    return docs.select(F.col(id_col).alias("doc_id"), _scan_column(F.col(text_col), phrases, notices).alias("r")) \
        .select("doc_id", "r.*")


def _scan_column(text: Column, phrases: dict[str, str], notices: dict[int, Notices]) -> Column:
    names = [f.split()[0] for f in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([scan_text(t, phrases, notices) for t in texts], columns=names)
        return out.astype({"first_word": "Int64", "last_word": "Int64", "score": "float64"})

    return run(text)
