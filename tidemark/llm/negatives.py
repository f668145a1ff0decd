"""Hard negatives by exact search: anchors in spanning trees, bounds passed from parent to child.

Vectors are taken as integers, scores are integer inner products. Anchors of a block are split into trees of
bounded size; a tree spans its anchors by short edges (Prim). For a candidate ``x`` and an anchor ``a`` with
parent ``p`` the score ``<x, a>`` lies within ``<x, p> -+ |a - p| |x|``: the parent's exact score, or the
bounds it had, widened by the edge's length times the candidate's norm, bound the child's. Only candidates
whose bounds overlap a window in question are scored again, exactly:

* positives: rows of the anchor's label that may reach its worst positive so far;
* negatives: rows of other labels that may lie in a positive's window ``[low * score, score]`` and reach the
  worst negative that it has so far.

All rows are packed into shards of bounded size where they are read. A task takes one block of anchors
through one run of shards; what it has found so far narrows the windows from shard to shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare

SHARD_ROWS = 2_048
TREE_ROWS = 512  # anchors in a tree
BLOCK_ROWS = 4_096  # anchors that meet the shards together
RUN_SHARDS = 64  # most shards that one task takes a block through
LIMIT = 1 << 55  # scores and the window's multiples of them stay within 64 bits

_LOW = -(2**62)
_HIGH = 2**62


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, parent, length)``: anchors in the order in which a minimum spanning tree takes them up, each one's
    parent (an anchor before it; -1 for the first) and an upper bound of the edge's length."""
    n = len(points)
    x = points.astype(np.float64)
    near, parent = np.full(n, np.inf), np.full(n, -1, dtype=np.int64)
    order, length, left = np.empty(n, dtype=np.int64), np.zeros(n), np.ones(n, dtype=bool)
    now = 0
    for step in range(n):
        order[step], left[now] = now, False
        d = ((x - x[now]) ** 2).sum(axis=1)
        closer = left & (d < near)
        near[closer], parent[closer] = d[closer], now
        if step + 1 < n:
            now = int(np.argmin(np.where(left, near, np.inf)))
            length[now] = math.sqrt(near[now]) * (1 + 1e-9)
    return order, parent, length


def exact_scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer products of rows and an anchor: by floating point where that is exact."""
    top = (np.abs(rows).max() if rows.size else 0), (np.abs(anchor).max() if anchor.size else 0)
    if int(top[0]) * int(top[1]) * max(1, len(anchor)) < 2**52:
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return rows @ anchor


class Shard:
    """Candidates: their integer vectors, ids, labels, row numbers and upper bounds of their norms."""

    def __init__(self, row, dim: int):
        self.vectors = np.frombuffer(row.data, dtype="<i8" if row.wide else "<i4").reshape(row.n, dim).astype(np.int64)
        self.real = self.vectors.astype(np.float64)
        self.ids, self.labels, self.rows = (np.frombuffer(x, dtype="<i8") for x in (row.ids, row.labels, row.rows))
        self.norms = np.sqrt((self.real ** 2).sum(axis=1)) * (1 + 1e-9)
        self.small = len(self.vectors) and int(np.abs(self.vectors).max()) < 2**20 or not len(self.vectors)

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.small and np.abs(anchor).max(initial=0) < 2**20 and len(anchor) < 2**12:
            return (self.real[at] @ anchor.astype(np.float64)).astype(np.int64)
        return exact_scores(self.vectors[at], anchor)


class Best:
    """The best ``k`` (score, id) of one search so far, highest scores first, ties by smaller id."""

    __slots__ = ("k", "score", "ids")

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def worst(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else _LOW

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score) > 4 * self.k:  # only what reaches the kth score can enter
            keep = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[keep], ids[keep]
        score, ids = np.concatenate((self.score, score)), np.concatenate((self.ids, ids))
        order = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[order], ids[order]


def walk(tree, anchors: np.ndarray, shard: Shard, wanted, found) -> int:
    """Take a tree of anchors through a shard. ``wanted(a, lo, hi)``: positions of candidates whose bounds ``lo <=
    score <= hi`` for anchor ``a`` overlap what is in question; ``found(a, at, score)`` gets their exact scores.
    Returns the number of products computed."""
    order, parent, length = tree
    lo, hi = np.empty((len(order), len(shard.ids))), np.empty((len(order), len(shard.ids)))
    products = 0
    for a in order.tolist():
        p = parent[a]
        if p < 0:
            at = np.arange(len(shard.ids))
        else:
            reach = length[a] * shard.norms + 1
            np.subtract(lo[p], reach, out=lo[a])
            np.add(hi[p], reach, out=hi[a])
            at = wanted(a, lo[a], hi[a])
        if len(at):
            score = shard.scores(at, anchors[a])
            # floating point bounds of a large integer may be off by its last digits
            lo[a, at], hi[a, at] = score * (1 - np.sign(score) * 1e-15), score * (1 + np.sign(score) * 1e-15)
            found(a, at, score)
            products += len(at)
    return products


def _packed(dim: int, rows: int):
    """Pack the rows of a partition, in their order, into shards."""
    def pack(ids, labels, numbers, vectors):
        matrix = np.zeros((len(ids), dim), dtype=np.int64)
        for i, x in enumerate(vectors):
            matrix[i, :len(x)] = x
        wide = bool(len(matrix) and np.abs(matrix).max(initial=0) >= 2**31)
        flat = [np.asarray(x, dtype="<i8").tobytes() for x in (ids, labels, numbers)]
        return pa.RecordBatch.from_pydict(
            {"n": pa.array([len(ids)], pa.int32()), "wide": [wide], "ids": pa.array([flat[0]], pa.binary()),
             "labels": pa.array([flat[1]], pa.binary()), "rows": pa.array([flat[2]], pa.binary()),
             "data": pa.array([matrix.astype("<i8" if wide else "<i4").tobytes()], pa.binary())})

    def run(batches):
        held = [[], [], [], []]
        for batch in batches:
            for store, column in zip(held, (batch.column(i).to_pylist() for i in range(4)), strict=True):
                store.extend(column)
            while len(held[0]) >= rows:
                yield pack(*(x[:rows] for x in held))
                held = [x[rows:] for x in held]
        if held[0]:
            yield pack(*held)
    return run


_PACKED = "n int, wide boolean, ids binary, labels binary, rows binary, data binary"


class Block:
    """Anchors of one block, in trees of up to ``TREE_ROWS`` anchors that lie next to each other in it."""

    def __init__(self, row, dim: int):
        s = Shard(row, dim)
        self.vectors, self.ids, self.labels, self.rows = s.vectors, s.ids, s.labels, s.rows
        self.trees = [(a, spanning_tree(self.vectors[a:a + TREE_ROWS])) for a in range(0, len(self.ids), TREE_ROWS)]


def positives_in(block: Block, shards, k: int) -> tuple[list[Best], int]:
    """The best ``k`` other rows of each anchor's label among the shards, and the products computed."""
    best, products = [Best(k) for _ in block.ids], 0
    for shard in shards:
        for base, tree in block.trees:
            def wanted(a, lo, hi, base=base, shard=shard):
                return np.flatnonzero((shard.labels == block.labels[base + a]) & (hi >= best[base + a].worst()))

            def found(a, at, score, base=base, shard=shard):
                j = base + a
                ok = (shard.labels[at] == block.labels[j]) & (shard.rows[at] != block.rows[j])
                best[j].add(score[ok], shard.ids[at[ok]])

            products += walk(tree, block.vectors[base:base + TREE_ROWS], shard, wanted, found)
    return best, products


def negatives_in(block: Block, shards, windows: dict[int, np.ndarray], k: int, low: int) -> tuple[dict, int]:
    """For each anchor's row number and each of its distinct positive scores, the best ``k`` rows of other labels
    with ``low * positive <= 100 * score <= 100 * positive``, and the products computed."""
    best = {(j, int(s)): Best(k) for j, row in enumerate(block.rows.tolist()) for s in windows.get(row, ())}
    asked = [sorted({int(s) for s in windows.get(row, ())}) for row in block.rows.tolist()]
    products = 0
    for shard in shards:
        for base, tree in block.trees:
            def wanted(a, lo, hi, base=base, shard=shard):
                j, may = base + a, np.zeros(len(shard.ids), dtype=bool)
                for s in asked[j]:
                    may |= (hi >= max(-(-low * s // 100), best[j, s].worst())) & (lo <= s)
                return np.flatnonzero(may & (shard.labels != block.labels[j]))

            def found(a, at, score, base=base, shard=shard):
                j = base + a
                other = shard.labels[at] != block.labels[j]
                for s in asked[j]:
                    ok = other & (100 * score >= low * s) & (score <= s) & (score >= best[j, s].worst())
                    if ok.any():
                        best[j, s].add(score[ok], shard.ids[at[ok]])

            products += walk(tree, block.vectors[base:base + TREE_ROWS], shard, wanted, found)
    return best, products


def mine(vectors: DataFrame, anchors: str, label=None, positives: int = 5, negatives: int = 5, low: int = 80,
         scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``: for every row that the
    condition ``anchors`` (on ``id``) holds for, its first ``positives`` other rows of its label by score, and for
    each of these the first ``negatives`` rows of other labels with ``low * positive_score <= 100 *
    negative_score <= 100 * positive_score``. Higher scores come first, ties by smaller id.

    ``label``: an expression on ``id`` and ``label`` in place of the label column. Components are taken as
    ``floor(scale * x)``, scores are exact integers; vectors whose products could leave 64 bits are an error.
    Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows of one id are rows
    of their own. Shorter vectors count as filled up with zeros. No rows, no anchors, no positives, no negatives in
    a window: no result there. Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col("v")
    named = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    rows = (named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
                        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .select("id", F.col("label") if label is None else label.cast("long").alias("label"),
                    F.transform(v, lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("v"))
            .where("label is not null").withColumn("row", F.monotonically_increasing_id()))
    rows = cut(rows, "numbered-vectors")
    size = rows.agg(F.max(F.size("v")).alias("dim"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("top"),
                    F.count(F.when(F.expr(anchors), 1)).alias("anchors")).first()
    dim, top = max(1, size["dim"] or 0), size["top"] or 0
    if top < 0 or top * top * dim >= LIMIT:
        raise ValueError(f"components of up to {top} in {dim} dimensions: their products could leave 64 bits")

    shards = cut(rows.select("id", "label", "row", "v").mapInArrow(_packed(dim, SHARD_ROWS), _PACKED)
                 .withColumn("shard", F.monotonically_increasing_id()), "vector-shards")
    count = shards.count()
    # like anchors side by side: by label, then by the signs of their first components
    blocks = max(1, -(-size["anchors"] // BLOCK_ROWS))
    signs = F.array_join(F.transform(F.slice("v", 1, 12), lambda x: F.when(x < 0, "0").otherwise("1")), "")
    block = cut(rows.where(anchors).withColumn("signs", signs).repartitionByRange(blocks, "label", "signs", "id", "row")
                .sortWithinPartitions("label", "signs", "id", "row").select("id", "label", "row", "v")
                .mapInArrow(_packed(dim, 2 * BLOCK_ROWS), _PACKED).withColumn("block", F.spark_partition_id()), "anchor-blocks")
    # enough runs for all cores, each of a bounded number of shards
    cores = 2 * spark.sparkContext.defaultParallelism
    runs = max(-(-count // RUN_SHARDS), min(count, -(-cores // blocks)), 1)
    left = shards.withColumn("run", F.pmod(F.xxhash64("shard"), F.lit(runs)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def met(right: DataFrame, search, schema: str) -> DataFrame:
        dealt = right.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))
        return left.groupBy("block", "run").cogroup(dealt.groupBy("block", "run")).applyInPandas(search, schema)

    def opened(points: pd.DataFrame):
        return (Shard(s, dim) for s in points.sort_values("shard").itertuples())

    def find_positives(points: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in block.itertuples():
            held = Block(b, dim)
            best, _ = positives_in(held, opened(points), positives)
            out += [(row, anchor, int(i), int(s)) for row, anchor, x in zip(held.rows.tolist(), held.ids.tolist(), best, strict=True)
                    for s, i in zip(x.score, x.ids, strict=True)]
        return pd.DataFrame(out, columns=["row", "anchor_id", "id", "score"]).astype("int64")

    first = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id"))
    chosen = cut(met(block, find_positives, "row long, anchor_id long, id long, score long")
                 .withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "positives")

    # a block's anchors travel with the scores of their positives, at most ``positives`` for each
    of = chosen.groupBy("row").agg(F.collect_set("score").alias("scores"))
    whose = rows.where(anchors).select("row")
    home = block.select("block", "rows")
    number = home.mapInArrow(_rows_of, "block int, row long")
    per_block = number.join(whose, "row").join(of, "row").groupBy("block").agg(
        F.collect_list(F.struct("row", "scores")).alias("windows"))

    def find_negatives(points: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in block.itertuples():
            held = Block(b, dim)
            windows = {int(w["row"]): w["scores"] for w in b.windows}
            best, _ = negatives_in(held, opened(points), windows, negatives, low)
            out += [(int(held.rows[j]), s, int(i), int(x)) for (j, s), y in best.items()
                    for x, i in zip(y.score, y.ids, strict=True)]
        return pd.DataFrame(out, columns=["row", "positive_score", "negative_id", "negative_score"]).astype("int64")

    place = Window.partitionBy("row", "positive_score").orderBy(F.col("negative_score").desc(), F.col("negative_id"))
    mined = met(block.join(per_block, "block"), find_negatives,
                "row long, positive_score long, negative_id long, negative_score long") \
        .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
    pairs = chosen.select("row", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(mined, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _rows_of(batches):
    for batch in batches:
        for block, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            numbers = np.frombuffer(rows, dtype="<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(numbers), block, dtype=np.int32)), pa.array(numbers)],
                                             names=["block", "row"])
