"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

Every source gets a word budget: a weight share of all words, at most
``cap`` times what the source holds, with the excess shared again by weight
among the sources still below their caps.  A budget of ``e`` full passes and
a rest takes every document ``e`` times; the rest goes to the documents with
the smallest exponential keys ``-ln(u) / quality``, taken in key order while
the running word count stays within the rest.  Documents are taken whole: one that does not
fit is passed over, and those after it that are small enough still go in, until none is.

That filling runs in rounds over all sources at once.  Let L be the words a source still misses.  While
more than L/2 of them are open, every document of at most L/2 words fits, and of the larger ones
only the first that fits beside the small ones before it goes in, as it leaves less than L/2.  So one
running count of the small documents decides a round, and what is left at its end is under L/2 or
nothing more fits: a budget of w words takes at most 2 + log2(w) rounds, whatever the sizes are.

Nothing is ordered in one task: documents are range-partitioned by
(source, key), each partition adds up its words per source, and a row's
running count is its partition's offset plus its place inside the partition.
A source with most of the rows therefore spreads over many partitions.

Defined cases: a null text has size 0; documents of size 0 take 0; a null
source is a source of its own, last in the order; documents that tie on the
key go by id, then size; rows that repeat a document count each; an empty
table gives an empty result.  Only the named columns are read, so others may
have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize, save_scratch, shuffle_partitions

WORD = r"[^\x20\x09-\x0D]+"
MARKUP = "#$%&*|!<>{}[]_=~^\\"
_HASH_RANGE = float(1 << 52)


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plain_share(text: Column) -> Column:
    """A document quality weight in (0, 1]: the share of characters that are
    not markup or filler symbols."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(F.translate(text, MARKUP, "")) + 1) / (F.length(text) + 1)


def uniform(doc_id: Column, seed: int) -> Column:
    """A fixed number in (0, 1) per id and seed."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / _HASH_RANGE


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0,
                   cap: float = 3.0) -> DataFrame:
    """One row per source of ``sized`` (src, size): src, source_size, target.

    Weights go to the sources in code-point order, null last, repeating.  The
    budget is filled like water: sources are visited by cap per weight; the
    first level at which the next source would not reach its cap is the final
    words per unit of weight.
    """
    per = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                           (place % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("src").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn(
        "level",
        (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    below = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    per = per.withColumn("level", F.first(below, ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return per.select("src", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: Column | None = None, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.0,
        cap: float = 3.0, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, key, copies, taken, text_hash: how often the mix
    takes each document, and the words that makes.  ``quality`` (default:
    ``plain_share``) weighs documents within a source; it must be positive."""
    spark = docs.sparkSession
    quality = plain_share(F.col(text_col)) if quality is None else quality
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("src"), word_count(F.col(text_col)).alias("size"),
        (-F.log(uniform(F.col(id_col), seed)) / quality).alias("key"), F.xxhash64(text_col).alias("text_hash"))
    # The texts are read once; every later pass reads these narrow rows.
    sized, _ = save_scratch(sized, "mix-sizes")
    targets = save_scratch(source_targets(sized, weights, share, cap), "mix-targets")[0]
    placed = sized.repartitionByRange(shuffle_partitions(spark), F.col("src").asc_nulls_last(), *_ORDER) \
        .withColumn("part", F.spark_partition_id())
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budgets = targets.select(F.col("src").alias("s"), "source_size", "target", full.cast("int").alias("full"),
                             (F.col("target") - full * F.col("source_size")).alias("left"))
    rows = placed.join(budgets, F.col("src").eqNullSafe(F.col("s"))).drop("s")
    rows, _ = save_scratch(rows, "mix-order")
    decided = []
    while True:
        counted, _ = save_scratch(_counted(rows), "mix-round")
        if decided and counted.isEmpty():
            break
        # one row per source, of known size once written
        ends, _ = save_scratch(_ends(counted), "mix-ends")
        told = counted.join(ends, F.col("src").eqNullSafe(F.col("s")))
        alone = F.coalesce((F.col("part") == F.col("large.part")) & (F.col("place") == F.col("large.place")), F.lit(False))
        told = told.withColumn("extra", (alone | F.col("small") & (F.col("words") <= F.col("open"))).cast("int"))
        decided.append(told.filter("extra = 1 or size > rest"))
        rows = told.filter("extra = 0 and size <= rest").withColumn("left", F.col("rest")).select(*rows.columns)
    columns = ("doc_id", "src", "size", "source_size", "target", "key", "full", "extra", "text_hash")
    out = reduce(DataFrame.union, [d.select(*columns) for d in decided])
    copies = F.col("full") + F.col("extra")
    return out.select("doc_id", F.col("src").alias("source"), "size", "source_size", "target", "key",
                      copies.alias("copies"), (F.col("size") * copies).alias("taken"), "text_hash")


_ORDER = ("key", "doc_id", "size", "text_hash")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``small`` (at most half of what is left), ``place`` within the partition, and
    ``words``: the running word count of the small rows of the source, in key order, this row included."""
    small = F.col("size") * 2 <= F.col("left")
    rows = rows.withColumn("small", small).withColumn("light", F.when(small, F.col("size")).otherwise(0))
    parts = rows.groupBy(F.col("src").alias("s"), F.col("part").alias("p")).agg(F.sum("light").alias("words"))
    earlier = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("s", "p", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    order = Window.partitionBy("src", "part").orderBy(*_ORDER)
    counted = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "inside", F.sum("light").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = counted.join(parts, F.col("src").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    return joined.withColumn("words", F.col("offset") + F.col("inside")).drop("s", "p", "offset", "inside", "light")


def _ends(counted: DataFrame) -> DataFrame:
    """One row per source: the first ``large`` row that fits beside the small ones before it, the words
    ``open`` to small rows, and the ``rest`` after them."""
    fits = ~F.col("small") & (F.col("words") + F.col("size") <= F.col("left"))
    first = counted.groupBy(F.col("src").alias("s")).agg(
        F.min(F.when(fits, F.struct("part", "place", "size"))).alias("large"), F.first("left").alias("had"))
    first = first.select("s", "large", (F.col("had") - F.coalesce(F.col("large.size"), F.lit(0))).alias("open"))
    small = counted.filter("small").join(first.select(F.col("s").alias("f"), F.col("open").alias("most")),
                                         F.col("src").eqNullSafe(F.col("f")))
    took = small.filter("words <= most").groupBy(F.col("src").alias("t")).agg(F.max("words").alias("took"))
    return first.join(took, F.col("s").eqNullSafe(F.col("t")), "left").select(
        "s", "large", "open", (F.col("open") - F.coalesce("took", F.lit(0))).alias("rest"))


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it.  ``mixed`` is ``mix(docs)``.  Rows
    with the same id, source and text are equal: of those, as many are taken once more as the mix decided."""
    plan = materialize(mixed.groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"),
                                     F.col("text_hash").alias("_mix_text")).agg(
        F.min("copies").alias("_mix_copies"), F.max("copies").alias("_mix_most"), F.sum("copies").alias("_mix_all"),
        F.count(F.lit(1)).alias("_mix_rows")), "mix-plan")
    rows = docs.withColumn("_mix_hash", F.xxhash64(text_col))
    mine = F.col(id_col).eqNullSafe(F.col("_mix_id")) & F.col(source_col).eqNullSafe(F.col("_mix_source")) \
        & (F.col("_mix_hash") == F.col("_mix_text"))
    joined = rows.join(plan.filter("_mix_copies = _mix_most and _mix_copies > 0"), mine)
    # equal rows of which the mix takes only some once more: one such group at most in a source's round
    split = plan.filter("_mix_copies <> _mix_most")
    if not split.isEmpty():
        number = F.row_number().over(Window.partitionBy("_mix_id", "_mix_source", "_mix_text").orderBy(F.lit(0)))
        more = number <= F.col("_mix_all") - F.col("_mix_copies") * F.col("_mix_rows")
        some = rows.join(split, mine).withColumn("_mix_copies", (F.col("_mix_copies") + more.cast("int")).cast("int"))
        joined = joined.withColumn("_mix_copies", F.col("_mix_copies").cast("int")).union(some.filter("_mix_copies > 0"))
    joined = joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
