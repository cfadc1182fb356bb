r"""Line dedup over a suffix array of line ids.

A document is its sequence of lines that have a word (blank lines are kept
and do not count).  A run of consecutive lines with at least ``min_words`` words in
all that occurs more than once in the corpus is repeated; its first place (by
document id, then text, then line) stays, the lines of every later copy are deleted.

Suffixes are the positions of these sequences, ordered by prefix doubling: rank 0 orders
suffixes by their first line, rank k+1 by the pairs (rank k here, rank k 2^k lines on); the
ranks are numbered in the sorted order of the distinct pairs.  Positions whose prefix
occurs once drop out: no repeated run holds them.  The doubling goes on until no pair repeats, so its rounds are
the logarithm of the longest repeated run.

Suffixes that share their first l lines form an LCP interval; its first place names it.  The longest run
that a suffix shares with an earlier one is built up from the highest rank down: a suffix whose run of l lines
has an earlier copy, and whose rank k is known l lines on, falls into the interval (l, first place, that rank); if that
interval begins before the suffix, the run grows to l + 2^k lines and takes the interval's first place, which
itself stays to be met there.  (Every other earlier copy may grow further, never the earliest one.)  A run is
maximal if the line before does not begin a run over it.

The runs of at least ``min_words`` words delete their lines.  ``runs=True`` adds, per document, what the intervals
tell of them: how many maximal runs go, the lines of the longest, and the document and line of its first place.

Built-in functions only.  Texts are read twice and shuffled once, to meet
their deletions; everything between is rows of numbers.  A line that a third of the
rows share is counted by partial aggregates; its interval is a written table before its places meet it, so
adaptive execution splits that join.

Defined cases: a null text stays null with no lines; an empty text is one blank line; rows that repeat an id and a text
are one document and get the same result each; documents of one id come in the order of a hash of their texts; null
ids come first; lines are equal if all characters are; texts of any length are read whole (a document's own rows of
numbers meet in one task); of several longest runs the first counts; without runs the columns of ``runs`` are 0 and
null; an empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import drop_scratch, save_scratch

WORD = r"[^\x20\x09-\x0D]+"


def _key(id_col: Column, text: Column) -> list[Column]:
    return [id_col.alias("did"), F.xxhash64(text, id_col).alias("h")]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(did, h, line, seq, k1, k2, words) of lines with a word: ``seq`` counts these,
    ``line`` all lines."""
    text = F.col(text_col)
    numbered = F.transform(F.split(text, "\n"), lambda s, i: F.struct(i.alias("line"), s.alias("s")))
    worded = F.filter(numbered, lambda x: x["s"].rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.filter(text.isNotNull()).select(*_key(F.col(id_col), text), F.posexplode(worded).alias("seq", "l"))
    # two hashes of 64 bits name a line
    return rows.select("did", "h", "l.line", "seq", F.xxhash64("l.s").alias("k1"), F.xxhash64("l.s", F.lit(1)).alias("k2"),
                       F.regexp_count("l.s", F.lit(WORD)).alias("words"))


def _named(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(na, nb, rank) for the pairs that occur more than once, ranks ascending
    with the pairs."""
    often = pairs.groupBy(F.col(a).alias("na"), F.col(b).alias("nb")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return often.orderBy("na", "nb").select("na", "nb", F.monotonically_increasing_id().alias("rank"))


def _ranked(pairs: DataFrame, names: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.join(names, (F.col(a) == F.col("na")) & (F.col(b) == F.col("nb"))).drop("na", "nb")


def deletions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(did, h, lines, n_runs, longest, first): for every document with deletions, the sorted numbers
    of the lines (from 0, blank ones counted) that go, how many maximal runs they are, the lines of
    the longest and its first place."""
    spark = docs.sparkSession
    lines = _lines(docs, id_col, text_col)
    lines, lines_path = save_scratch(lines, "lines")
    names, _ = save_scratch(_named(lines, "k1", "k2"), "line-names")
    doc = Window.partitionBy("did", "h").orderBy("seq")
    # Only lines that occur again; neighbours among them share a run.  A document that
    # is in several rows has each line several times: kept once.
    here = _ranked(lines, names, "k1", "k2").withColumn("run", F.col("seq") - F.dense_rank().over(doc)) \
        .dropDuplicates(["did", "h", "seq"]).select("did", "h", "run", "seq", "line", "words", "rank")
    here, _ = save_scratch(here, "repeated-lines")
    drop_scratch(spark, lines_path)

    levels = [here.select("did", "h", "seq", "rank")]
    while True:
        # rank k at 2^k lines on: the lines before are all repeated, else it is null there
        now, on = levels[-1], 1 << (len(levels) - 1)
        pairs = _ahead(now.withColumnRenamed("rank", "first"), now, F.col("seq") + on, "inner").filter("next is not null")
        pairs, pairs_path = save_scratch(pairs, "suffix-pairs")
        names, _ = save_scratch(_named(pairs, "first", "next"), "suffix-names")
        if names.isEmpty():
            break
        levels.append(save_scratch(_ranked(pairs, names, "first", "next").select("did", "h", "seq", "rank"), "suffix-ranks")[0])
        drop_scratch(spark, pairs_path)
    runs = _longest_runs(here, levels)
    return save_scratch(_report(here, runs, min_words), "deletions")[0]


def _ahead(rows: DataFrame, ranks: DataFrame, place: Column, how: str) -> DataFrame:
    """``rows`` with ``next``, the rank at ``place`` in the same document."""
    at = ranks.select(F.col("did").alias("d"), F.col("h").alias("g"), F.col("seq").alias("q"), F.col("rank").alias("next"))
    return rows.join(at, F.col("did").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")) & (place == F.col("q")), how).drop("d", "g", "q")


_PLACE = "struct<did:{0},h:bigint,seq:int,line:int>"


def _longest_runs(here: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(did, h, seq, line, len, first) of the suffixes with an earlier copy: the lines of
    the longest run that has one, and the first place of that run."""
    lines = here.select("did", "h", "seq", "line")
    none = F.lit(None).cast(_PLACE.format(here.schema["did"].dataType.simpleString()))
    state, old = None, []
    for k in range(len(levels) - 1, -1, -1):
        ranks = levels[k]
        fresh = ranks if state is None else ranks.join(
            state.filter("not head_only").select(F.col("did").alias("d"), F.col("h").alias("g"), F.col("seq").alias("q")),
            F.col("did").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")) & (F.col("seq") == F.col("q")), "left_anti")
        fresh = fresh.join(lines.select(F.col("did").alias("d"), F.col("h").alias("g"), F.col("seq").alias("q"), "line"),
                           F.col("did").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")) & (F.col("seq") == F.col("q")))
        tried = fresh.select("did", "h", "seq", "line", F.lit(0).alias("len"), none.alias("first"), F.lit(False).alias("head_only"), F.col("rank").alias("next"))
        if state is not None:
            tried = tried.union(_ahead(state, ranks, F.col("seq") + F.col("len"), "left").select(*tried.columns))
        tried, tried_path = save_scratch(tried, "run-tries")
        place = F.struct("did", "h", "seq", "line")
        # the LCP intervals that more than their first place falls into; written, so that the join below has a plain
        # shuffle on both sides and a hot interval is split
        found = tried.filter("next is not null").groupBy(F.col("len").alias("l"), F.col("first").alias("f"), F.col("next").alias("r")).agg(
            F.min(place).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        found, found_path = save_scratch(found, "run-intervals")
        joined = tried.join(found, (F.col("len") == F.col("l")) & F.col("first").eqNullSafe(F.col("f")) & (F.col("next") == F.col("r")), "left")
        # null-safe: a null id is the smallest
        longer = F.col("head").isNotNull() & ~F.col("head").eqNullSafe(place) & ~F.col("head_only")
        new = joined.select("did", "h", "seq", "line", F.when(longer, F.col("len") + (1 << k)).otherwise(F.col("len")).alias("len"),
                            F.when(longer, F.col("head")).otherwise(F.col("first")).alias("first"), "head_only").filter("len > 0")
        heads = found.select("head.*", (F.col("l") + (1 << k)).alias("len"), F.col("head").alias("first"), F.lit(True).alias("head_only"))
        state, state_path = save_scratch(new.union(heads), "runs")
        drop_scratch(here.sparkSession, tried_path, found_path, *old)
        old = [state_path]
    return state.filter("not head_only").drop("head_only")


def _report(here: DataFrame, runs: DataFrame, min_words: int) -> DataFrame:
    """(did, h, lines, n_runs, longest, first) per document with deletions."""
    mine = Window.partitionBy("did", "h").orderBy("seq")
    if min_words > 1:
        words = here.withColumn("upto", F.sum("words").over(mine))
        begin = words.select(F.col("did").alias("d"), F.col("h").alias("g"), F.col("seq").alias("q"), (F.col("upto") - F.col("words")).alias("before"))
        end = words.select(F.col("did").alias("d"), F.col("h").alias("g"), F.col("seq").alias("q"), "upto")
        at = lambda place: F.col("did").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")) & (place == F.col("q"))
        runs = runs.join(begin, at(F.col("seq"))).drop("d", "g", "q")
        runs = runs.join(end, at(F.col("seq") + F.col("len") - 1)).drop("d", "g", "q").withColumn("goes", F.col("upto") - F.col("before") >= min_words)
    else:
        runs = runs.withColumn("goes", F.lit(True))
    end = F.col("seq") + F.col("len")
    # the line before begins a run that holds this one
    inner = F.coalesce((F.lag("seq").over(mine) == F.col("seq") - 1) & (F.lag(end).over(mine) == end), F.lit(False))
    rows = runs.withColumn("maximal", F.col("goes") & ~inner).withColumn(
        "covered", F.max(F.when(F.col("goes"), end)).over(mine) > F.col("seq"))
    best = F.max_by("first", F.when(F.col("maximal"), F.struct("len", -F.col("seq"))))
    return rows.filter("covered").groupBy("did", "h").agg(
        F.sort_array(F.collect_list("line")).alias("lines"), F.count_if("maximal").cast("int").alias("n_runs"),
        F.max(F.when(F.col("maximal"), F.col("len"))).alias("longest"), best.alias("first"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, runs: bool = False) -> DataFrame:
    """doc_id, n_lines (all lines), n_removed and text (what is left) per row of
    ``docs``; with ``runs`` also n_runs, longest_run, first_doc and first_line (from 0)."""
    gone = deletions(docs, id_col, text_col, min_words).select(
        F.col("did").alias("d"), F.col("h").alias("g"), F.col("lines").alias("gone"), "n_runs", "longest", "first")
    text = F.col(text_col)
    rows = docs.select(*_key(F.col(id_col), text), F.split(text, "\n").alias("ls"))
    # a hash join: texts stream past the deletions and are never sorted, at any size
    rows = rows.join(gone.hint("shuffle_hash"), F.col("did").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), F.col("gone"))
    left = F.when(F.col("gone").isNull(), F.col("ls")).otherwise(F.transform(kept, lambda i: F.get(F.col("ls"), i)))
    more = [F.coalesce("n_runs", F.lit(0)).alias("n_runs"), F.coalesce("longest", F.lit(0)).alias("longest_run"),
            F.col("first.did").alias("first_doc"), F.col("first.line").alias("first_line")] if runs else []
    return rows.select(
        F.col("did").alias("doc_id"), F.when(F.col("ls").isNull(), 0).otherwise(F.size("ls")).alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"), F.array_join(left, "\n").alias("text"), *more)
