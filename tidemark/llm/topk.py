"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal, kth score carried on.

Vectors are dealt into shards of bounded size. A shard's tree halves its points at the median of the
widest dimension, down to leaves; as every split is by position, the tree is the order of the points,
and tight bounding boxes of its nodes are taken from that order. For a query ``q`` and a box the score
is at most ``sum(max(q * lo, q * hi))``. Queries go through a shard's leaves in the order of that bound
(the order in which a best-first search takes them) until the bound falls below the query's kth score,
which is carried from shard to shard.

Vectors of every row meet queries in blocks: a task holds one block of queries and one run of shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare

SHARD_ROWS = 1_024
LEAF_ROWS = 64
QUERY_ROWS = 4_096  # queries in a block
RUN_SHARDS = 64  # most shards that one task takes a block of queries through

_LOW = -(2**62)


def _pack(matrix: np.ndarray) -> bytes:
    small = matrix.size == 0 or np.abs(matrix).max() < 2**31
    return matrix.astype("<i4" if small else "<i8").tobytes()


def _unpack(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = "<i4" if len(data) == 4 * rows * dim else "<i8"
    return np.frombuffer(data, dtype=kind).reshape(rows, dim).astype(np.int64)


def node_ranges(n: int, leaf: int = LEAF_ROWS) -> list[list[tuple[int, int]]]:
    """Ranges of points of the tree's nodes, level by level; the last level has the leaves."""
    levels = [[(0, n)]]
    while max(b - a for a, b in levels[-1]) > leaf:
        levels.append([r for a, b in levels[-1] for r in ((a, (a + b) // 2), ((a + b) // 2, b))])
    return levels


def kd_order(matrix: np.ndarray, leaf: int = LEAF_ROWS) -> np.ndarray:
    """Order of the points in which each node of :func:`node_ranges` is split at its median."""
    order = np.arange(len(matrix))
    for level in node_ranges(len(matrix), leaf)[:-1]:
        for a, b in level:
            part = matrix[order[a:b]]
            widest = int(np.argmax(part.max(axis=0) - part.min(axis=0))) if part.size else 0
            order[a:b] = order[a:b][np.argsort(part[:, widest], kind="stable")] if part.size else order[a:b]
    return order


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of ``a`` and ``b``: by floating point where that is exact."""
    top = (np.abs(a).max() if a.size else 0), (np.abs(b).max() if b.size else 0)
    if int(top[0]) * int(top[1]) * max(1, a.shape[1]) < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class BestK:
    """The best ``k`` (score, id) of each query so far: highest scores, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, numbers: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.numbers = ids if numbers is None else numbers  # of the queries' own rows
        self.score = np.full((len(ids), k), _LOW, dtype=np.int64)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, numbers: np.ndarray) -> None:
        score = _dot(self.vectors[rows], vectors)
        score[self.numbers[rows][:, None] == numbers[None, :]] = _LOW  # a query's own row
        score = np.concatenate((self.score[rows], score), axis=1)
        found = np.concatenate((self.found[rows], np.broadcast_to(ids, (len(rows), len(ids)))), axis=1)
        best = np.lexsort((found, -score), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(score, best, axis=1)
        self.found[rows] = np.take_along_axis(found, best, axis=1)

    def search(self, ids: np.ndarray, points: np.ndarray, numbers: np.ndarray | None = None) -> None:
        """Take all queries through one shard, whose points are in tree order; ``numbers``: of its rows (the ids, if
        these differ)."""
        numbers = ids if numbers is None else numbers
        positive, negative = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        alive = np.ones((len(self.ids), 1), dtype=bool)
        for level in node_ranges(len(ids)):
            cuts = [a for a, _ in level]
            lo, hi = np.minimum.reduceat(points, cuts), np.maximum.reduceat(points, cuts)
            least = np.minimum.reduceat(ids, cuts)
            bound = _dot(positive, hi) + _dot(negative, lo)
            if alive.shape[1] != len(level):
                alive = np.repeat(alive, 2, axis=1)  # the children of nodes that are still in question
            alive &= self._may(slice(None), bound, least)
        order = np.argsort(np.where(alive, -bound, -_LOW), axis=1, kind="stable")
        for step in range(len(level)):
            leaf = order[:, step]
            rows = np.arange(len(self.ids))
            left = alive[rows, leaf]
            left &= self._may(rows, bound[rows, leaf][:, None], least[leaf][:, None])[:, 0]
            if not left.any():
                break
            for x in np.unique(leaf[left]):
                a, b = level[x]
                self.add(np.flatnonzero(left & (leaf == x)), ids[a:b], points[a:b], numbers[a:b])

    def _may(self, rows, bound, least) -> np.ndarray:
        """Whether a box may hold a better candidate than the kth: a higher score, or a smaller id."""
        kth, last = self.score[rows, -1:], self.found[rows, -1:]
        return (bound > kth) | ((bound == kth) & (least < last))


def top_k(vectors: DataFrame, queries: str, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row that the condition ``queries`` (on ``id``)
    holds for, the ``k`` highest inner products with all other rows, ties to the smaller id; all of them
    if there are fewer. Components are taken as ``floor(scale * x)``; scores are exact integers.

    Rows with a null id, a null vector or a null or non-finite component take no part. Rows of one id are rows of
    their own: each is a candidate for the others, and a query of its own if its id is asked for. Vectors whose
    products could leave 64 bits are an error. Shorter vectors count as filled up with zeros. No rows, no queries:
    no result. Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col("v")
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & v.isNotNull()
                   & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .select("id", F.transform(v, lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("v"),
                    F.monotonically_increasing_id().alias("row")))
    rows = cut(rows, "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"),
                    F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("top"),
                    F.count(F.when(F.expr(queries), 1)).alias("q")).first()
    n, dim, q, top = size["n"], max(1, size["dim"] or 0), size["q"], size["top"] or 0
    if top < 0 or top * top * dim >= -_LOW:
        raise ValueError(f"components of up to {top} in {dim} dimensions: their products could leave 64 bits")
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-q // QUERY_ROWS))
    # enough runs for all cores, each of a bounded number of shards
    runs = max(-(-shards // RUN_SHARDS), min(shards, -(-2 * spark.sparkContext.defaultParallelism // blocks)))

    def packed(frame: pd.DataFrame, tree: bool):
        frame = frame.sort_values(["id", "row"], kind="stable")
        matrix = np.zeros((len(frame), dim), dtype=np.int64)
        for i, x in enumerate(frame["v"]):
            matrix[i, :len(x)] = x
        ids, numbers = (frame[c].to_numpy().astype("<i8") for c in ("id", "row"))
        order = kd_order(matrix) if tree else np.arange(len(ids))
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "n": [len(ids)], "ids": [ids[order].tobytes()],
                             "rows": [numbers[order].tobytes()], "data": [_pack(matrix[order])]})

    def parts(df: DataFrame, count: int, tree: bool) -> DataFrame:
        dealt = df.withColumn("part", F.pmod(F.xxhash64("id", "row"), F.lit(count)).cast("int"))
        return dealt.groupBy("part").applyInPandas(lambda f: packed(f, tree), "part int, n int, ids binary, rows binary, data binary")

    # one row per shard and per block; every block meets every run of shards in one task
    shard = parts(rows, shards, True).withColumn("run", F.pmod("part", F.lit(runs)))
    left = shard.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = parts(rows.where(queries), blocks, False).withColumnRenamed("part", "block") \
        .withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1))))

    def search(points: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(block):
            return pd.DataFrame({"row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")
        b = block.iloc[0]
        ids, own = (np.frombuffer(b[c], dtype="<i8") for c in ("ids", "rows"))
        best = BestK(ids, _unpack(b["data"], b["n"], dim), k, own)
        for s in points.sort_values("part").itertuples():
            best.search(np.frombuffer(s.ids, dtype="<i8"), _unpack(s.data, s.n, dim), np.frombuffer(s.rows, dtype="<i8"))
        have = best.score > _LOW
        found = have.sum(axis=1)
        return pd.DataFrame({"row": np.repeat(own, found), "query_id": np.repeat(best.ids, found), "vec_id": best.found[have],
                             "score": best.score[have]})

    found = left.groupBy("block", "run").cogroup(right.groupBy("block", "run")).applyInPandas(
        search, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
