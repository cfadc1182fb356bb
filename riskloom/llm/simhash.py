"""SimHash near-duplicates, searched with vantage-point trees.

Fingerprints: texts are lower-cased (A-Z), cut into words at ASCII white space
and into shingles of ``k`` words (a shorter text is one shingle, a text with
no words has fingerprint 0); a fingerprint bit is 1 if it is set in over half
of the shingles' XXH64 values (seed 42).  Documents with fingerprints at
``max_bits`` or fewer differing bits are linked.

Search: equal fingerprints are one point.  A vantage-point tree over a bounded
sample of points cuts the Hamming space into shards; a node sends points
nearer than its radius to one side, the others to the other.  Each point
has one home shard.  By the triangle inequality a partner within ``r`` bits can
lie across a node's boundary only if the point's distance is within ``r`` of
the radius, so only such points visit the far side too (of two points that a
node separates the nearer one visits, which is enough to meet).  Each shard
compares its visitors and its own points with its own points exactly, and
returns a spanning forest of what it found instead of all pairs; so a group of
thousands of close fingerprints costs as many edges as points.  A shard with more
than ``block`` points is cut into blocks whose pairs go to different tasks.

Defined cases: a null text counts as no words; repeated rows and equal texts
share a point; null ids are kept and are never a component's id unless all ids
of a component are null; an empty table gives an empty result; texts of any length are
read whole, one at a time in their task's memory.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.session import drop_scratch, save_scratch

SEED = 42
_PIECE = 1 << 16  # shingles hashed at a time


def fingerprint(text: str | None, k: int = 3) -> int:
    """The 64-bit fingerprint of one text, as a signed integer."""
    from xxhash import xxh64_intdigest

    # bytes.lower and bytes.split know ASCII only, as the definition does
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < k:
        return int(np.uint64(xxh64_intdigest(b" ".join(words), SEED)).astype(np.int64))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:len(words) - k] + 1).tolist()]
    ends = ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), _PIECE):
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[i:i + _PIECE], ends[i:i + _PIECE])],
                     dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, k: int = 3) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, k) for t in texts], dtype="int64")

    return run(text)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """(doc_id, h, fp) per row of ``docs``; ``h`` is a hash of the text."""
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"),
                       fingerprint_column(F.col(text_col), k).alias("fp"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _bits(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """A complete binary tree in arrays: node ``i`` has children 2i+1 (nearer
    than the radius) and 2i+2; shards are numbered from the left."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.points = np.zeros((1 << depth) - 1, np.uint64)
        self.radii = np.zeros((1 << depth) - 1, np.int64)
        self._grow(0, np.sort(sample), 0)

    def _grow(self, node: int, sample: np.ndarray, level: int) -> None:
        if level == self.depth:
            return
        if len(sample):
            self.points[node] = sample[len(sample) // 2]
        away = _bits(sample, self.points[node]).astype(np.int64)
        self.radii[node] = int(np.median(away)) if len(away) else 32
        near = away < self.radii[node]
        self._grow(2 * node + 1, sample[near], level + 1)
        self._grow(2 * node + 2, sample[~near], level + 1)

    def route(self, points: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, point index, at home?) for every shard that a point lives in
        or has to visit."""
        at = np.zeros(len(points), np.int64)
        who = np.arange(len(points))
        home = np.ones(len(points), bool)
        for _ in range(self.depth):
            away = _bits(points[who], self.points[at]).astype(np.int64)
            radius = self.radii[at]
            near = away < radius
            # at home: the side the point is on, and the far side only outwards
            left, right = np.where(home, near, away - r < radius), np.where(home, ~near, away + r >= radius)
            visit = home & near & (away + r >= radius)
            at, who, home = (np.concatenate((2 * at[left] + 1, 2 * at[right] + 2, 2 * at[visit] + 2)),
                             np.concatenate((who[left], who[right], who[visit])),
                             np.concatenate((home[left], home[right], np.zeros(int(visit.sum()), bool))))
        return at - ((1 << self.depth) - 1), who, home


def _forest(points: np.ndarray, queries: np.ndarray, r: int, cells: int = 1 << 21) -> np.ndarray:
    """A component label for each of ``points`` then ``queries``, where every
    item links to the points within ``r`` bits."""
    items = np.concatenate((points, queries))
    label = np.arange(len(items))
    step = max(1, cells // max(1, len(points)))
    for i in range(0, len(items), step):
        a, b = np.nonzero(_bits(items[i:i + step, None], points[None, :]) <= r)
        a += i
        keep = a != b
        a, b = a[keep], b[keep]
        while len(a):
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                break
            for side in (a, b):
                np.minimum.at(label, label[side], low)
                np.minimum.at(label, side, low)
            while (label != label[label]).any():
                label = label[label]
    return label


def link_points(points: DataFrame, max_bits: int = 2, shard_points: int = 2048, max_depth: int = 20,
                sample_points: int = 4096, block: int = 1 << 15) -> DataFrame:
    """Edges (u, v) that connect all ``points`` (fp, id) within ``max_bits``
    bits of each other, directly or through other points.

    ``shard_points`` is the wanted shard size, from which the depth follows.  The tree is built from
    ``sample_points`` points, or four to a shard if that is more; every point is routed and
    compared.  ``max_depth`` bounds the tree (16 MB) and that sample (4 million points); beyond two
    billion distinct fingerprints shards grow and are compared block by block.
    """
    n = points.count()
    depth = 0
    while depth < max_depth and (shard_points << depth) < n:
        depth += 1
    sample = [] if depth == 0 else [
        r.fp for r in points.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(max(sample_points, 4 << depth)).collect()]
    tree = VantageTree(np.array(sample, np.int64).view(np.uint64), depth)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            shard, who, home = tree.route(b["fp"].to_numpy(np.int64).view(np.uint64), max_bits)
            yield pd.DataFrame({"shard": shard, "home": home, "fp": b["fp"].to_numpy()[who],
                                "id": b["id"].to_numpy()[who]})

    routed, path = save_scratch(points.mapInPandas(route, "shard long, home boolean, fp long, id long"), "simhash-routes")
    # Blocks of the shards that outgrew one task: own points x own points and visitors.
    sizes = routed.groupBy("shard").agg(F.count_if("home").alias("own"), F.count(F.lit(1)).alias("all")).select(
        F.col("shard").alias("s"), F.ceil(F.col("own") / block).alias("own_blocks"),
        F.ceil(F.col("all") / block).alias("all_blocks")).filter("own_blocks > 0")
    rows = routed.join(sizes, F.col("shard") == F.col("s"))
    place = F.xxhash64("fp")
    as_own = rows.filter("home").select(
        "shard", F.pmod(place, "own_blocks").alias("ob"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)).alias("ab"),
        F.lit(True).alias("own"), "fp", "id")
    as_query = rows.select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("own_blocks") - 1)).alias("ob"),
        F.pmod(place, "all_blocks").alias("ab"), F.lit(False).alias("own"), "fp", "id", "home", "own_blocks", "all_blocks")
    # In an undivided shard the own points query themselves.
    as_query = as_query.filter("not home or own_blocks > 1 or all_blocks > 1").drop("home", "own_blocks", "all_blocks")

    def compare(shard: pd.DataFrame) -> pd.DataFrame:
        own = shard["own"].to_numpy()
        order = np.concatenate((np.flatnonzero(own), np.flatnonzero(~own)))
        fps, ids = shard["fp"].to_numpy(np.int64).view(np.uint64)[order], shard["id"].to_numpy(np.int64)[order]
        k = int(own.sum())
        label = _forest(fps[:k], fps[k:], max_bits)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": ids[moved], "v": ids[label[moved]]})

    edges, edges_path = save_scratch(as_own.union(as_query).groupBy("shard", "ob", "ab").applyInPandas(
        compare, "u long, v long").filter("u <> v").distinct(), "simhash-edges")
    drop_scratch(points.sparkSession, path)
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, max_bits: int = 2,
                    **search) -> DataFrame:
    """(doc_id, h, fp, component_id, component) per row of ``docs``: the smallest id reachable
    over links of at most ``max_bits`` differing bits.  ``component`` names the group, also
    where all its ids are null."""
    spark = docs.sparkSession
    fps, _ = save_scratch(fingerprints(docs, id_col, text_col, k), "simhash-fps")
    return cluster(fps, max_bits, **search)


def cluster(fps: DataFrame, max_bits: int = 2, **search) -> DataFrame:
    """``near_duplicates`` from (doc_id, fp) and any other columns, which should be a written
    table: it is read twice."""
    points, _ = save_scratch(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-points")
    # a point is named by its fingerprint, so that ids may repeat or be null
    edges = link_points(points.select("fp", F.col("fp").alias("id")), max_bits, **search)
    found, _ = save_scratch(components(edges), "simhash-components")
    named = points.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id")).withColumnRenamed("component", "c")
    classes = named.join(smallest, F.col("component") == F.col("c")).select(F.col("fp").alias("f"), "component_id", "component")
    return fps.join(classes, F.col("fp") == F.col("f")).select(*fps.columns, "component_id", "component")


def representatives(docs: DataFrame, classes: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``classes`` (``near_duplicates(docs)``): that with the smallest id
    (null last), then the smallest hash of the text; of repeated rows of that one of them."""
    keep = classes.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("first")) \
        .select(F.col("first.doc_id").alias("_kept_id"), F.col("first.h").alias("_kept_text"))
    rows = docs.withColumn("_text", F.xxhash64(text_col))
    kept = rows.join(keep, F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.col("_text") == F.col("_kept_text")), "left_semi")
    return kept.dropDuplicates([id_col, "_text"]).drop("_text")
