"""Hard-negative mining against plain numpy."""

import numpy as np
import pytest

import tidemark.llm.negatives as N
from tidemark.llm.negatives import mine, spanning_tree, walk

SCHEMA = "vec_id long, embedding array<double>, label int, id string, row int, v double"


def _brute(rows, every=10, positives=5, negatives=5, low=80, scale=256.0):
    kept = []
    for r in rows:
        if r.vec_id is None or r.label is None or r.embedding is None or any(x is None or not np.isfinite(x) for x in r.embedding):
            continue
        kept.append((r.vec_id, r.label, [int(np.floor(scale * x)) for x in r.embedding]))
    dim = max((len(k[2]) for k in kept), default=0)
    m = np.array([k[2] + [0] * (dim - len(k[2])) for k in kept], dtype=np.int64).reshape(len(kept), dim)
    out = []
    for i, (a, label, _) in enumerate(kept):
        if a % every:
            continue
        s = m @ m[i]
        order = sorted((j for j in range(len(kept)) if j != i), key=lambda j: (-s[j], kept[j][0]))
        for p in [j for j in order if kept[j][1] == label][:positives]:
            fit = [j for j in order if kept[j][1] != label and low * s[p] <= 100 * s[j] <= 100 * s[p]]
            out += [(a, kept[p][0], k + 1, kept[j][0], int(s[p]), int(s[j])) for k, j in enumerate(fit[:negatives])]
    return sorted(out)


def _vectors(spark, n=700, dim=16, seed=1):
    """Clusters over several labels, ties, repeated rows and ids, short vectors, and rows that take no part."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dim))
    rows = []
    for i in range(n):
        x = centres[i % 12] + 0.3 * rnd.normal(size=dim)
        rows.append((i, [float(y) for y in np.round(x, 1 if i % 3 else 3)], int(i % 12 // 3 if rnd.random() < 0.8 else rnd.integers(5))))
    rows += [rows[10], rows[10], (20, rows[35][1], 2), (20, rows[35][1], 2), (n, [0.0] * dim, 1), (n + 10, rows[0][1][:5], 0),
             (n + 1, None, 1), (n + 2, [float("nan")] * dim, 1), (n + 3, [None, 1.0], 1), (n + 4, [float("inf")], 1),
             (None, rows[3][1], 1), (n + 5, rows[3][1], None), (n + 20, [], 3)]
    return spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], SCHEMA)


def _got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("dim", [4, 16])
def test_matches_numpy(spark, dim):
    rows = _vectors(spark, dim=dim)
    want = _brute(rows.collect())
    assert want and _got(mine(rows, "id % 10 = 0")) == want


def test_small_blocks_trees_and_shards(spark, monkeypatch):
    rows = _vectors(spark, n=400, dim=6, seed=2).repartition(5)
    for name, value in (("SHARD_ROWS", 30), ("TREE_ROWS", 7), ("BLOCK_ROWS", 16), ("RUN_SHARDS", 4)):
        monkeypatch.setattr(N, name, value)
    assert _got(mine(rows, "id % 10 = 0", positives=3, negatives=4)) == _brute(rows.collect(), positives=3, negatives=4)


def test_nothing_to_find(spark):
    rows = _vectors(spark, n=60)
    assert _got(mine(rows.where("false"), "id % 10 = 0")) == []
    assert _got(mine(rows, "id < 0")) == []
    assert _got(mine(rows.where("label = 1"), "id % 10 = 0")) == []  # no row of another label


def test_products_beyond_64_bits_are_an_error(spark):
    rows = spark.createDataFrame([(1, [1e18, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="64 bits"):
        mine(rows, "id % 10 = 0")


def test_large_components_are_exact(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rnd.integers(-2**18, 2**18, 3)], i % 3) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert _got(mine(df, "id % 10 = 0")) == _brute(df.collect())


def test_tree_spans_and_bounds_hold():
    rnd = np.random.default_rng(3)
    x = rnd.integers(-50, 50, (40, 8))
    order, parent, length = spanning_tree(x)
    assert sorted(order) == list(range(40)) and parent[order[0]] == -1
    seen = {order[0]}
    for a in order[1:]:
        assert parent[a] in seen
        assert length[a] >= np.sqrt(((x[a] - x[parent[a]]) ** 2).sum())
        seen.add(a)


def test_bounds_prune_and_never_lie():
    rnd = np.random.default_rng(4)
    centre = rnd.normal(size=(5, 16)) * 100
    points = np.array([centre[i % 5] + rnd.normal(size=16) * 3 for i in range(400)]).astype(np.int64)
    anchors = points[:60]

    class Row:
        n, wide = 400, True
        ids = rows = labels = np.arange(400, dtype="<i8").tobytes()
        data = points.astype("<i8").tobytes()

    shard = N.Shard(Row, 16)
    exact = points @ anchors.T

    def wanted(a, lo, hi):
        assert (lo <= exact[:, a]).all() and (hi >= exact[:, a]).all()
        return np.flatnonzero(hi >= np.sort(exact[:, a])[-5])

    hits = {}
    products = walk(spanning_tree(anchors), anchors, shard, wanted, lambda a, at, s: hits.update({a: set(at)}))
    assert products < 0.5 * exact.size
    assert all(set(np.argsort(-exact[:, a])[:1]) <= hits[a] for a in range(60))
