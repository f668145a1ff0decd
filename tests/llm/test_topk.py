import numpy as np
import pytest

from tidemark.llm import topk
from tidemark.llm.topk import BestK, kd_order, node_ranges, top_k


def _rows(seed=1, n=400, dim=6):
    rnd = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rnd.normal(0, 0.2, dim).astype(np.float32)]) for i in range(n)]
    for i in range(0, n, 3):
        rows[i] = (i, rows[0][1])  # a third of all vectors are one vector
    return rows + [(1000, None), (1020, [0.1, None]), (1040, [float("nan")] * dim), (1060, [float("inf")] + [0.0] * (dim - 1)),
                   (None, rows[1][1]), (1080, []), (1100, [0.5, -0.5]), (20, rows[20][1]),
                   (40, rows[7][1]), (7, rows[8][1]), (7, rows[8][1])]  # ids and rows that repeat


def _brute(rows, k, every):
    ok = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ok.append((i, [int(np.floor(64 * x)) for x in v]))
    out = []
    for n, (q, x) in enumerate(ok):
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for m, (c, y) in enumerate(ok) if m != n)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"SHARD_ROWS": 40, "QUERY_ROWS": 7, "RUN_SHARDS": 2}])
def test_matches_brute_force(spark, monkeypatch, sizes):
    for k, v in sizes.items():
        monkeypatch.setattr(topk, k, v)
    rows = _rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, part int, n string")
    got = sorted(tuple(r) for r in top_k(df, "id % 20 = 0", k=20).collect())
    assert got == _brute([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], 20, 20)


def test_fewer_rows_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (20, [0.5]), (3, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in top_k(df, "id % 20 = 0", k=5).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 64 * 32), (0, 2, 3, -64 * 64), (20, 1, 0, 64 * 32), (20, 2, 3, -32 * 64)]
    assert top_k(df.where("false"), "id % 20 = 0").count() == 0
    assert top_k(df.where("vec_id = 3"), "id % 20 = 0").count() == 0


def test_search_prunes_and_stays_exact():
    rnd = np.random.default_rng(2)
    points = np.concatenate([rnd.integers(-5, 5, (600, 3)) + c for c in ([90, 0, 0], [0, 90, 0], [0, 0, -90])])
    ids = rnd.permutation(len(points))
    order = kd_order(points)
    assert sorted(order) == list(range(len(points))) and node_ranges(len(points))[-1][0][1] <= 64
    best = BestK(np.array([-1]), np.array([[10, 1, 0]]), 5)
    looked = []
    add = best.add
    best.add = lambda rows, i, v, own: (looked.append(len(i)), add(rows, i, v, own))
    best.search(ids[order], points[order])
    scores = points @ np.array([10, 1, 0])
    expect = sorted(zip(-scores, ids))[:5]
    assert [(int(-s), int(i)) for s, i in expect] == list(zip(best.score[0].tolist(), best.found[0].tolist()))
    assert sum(looked) < len(points) / 3  # boxes of the other clusters are never opened


def test_large_components_are_exact_or_an_error(spark):
    b = np.array([[2**25, 3]])
    assert topk._dot(b, b).tolist() == [[2**50 + 9]]
    a = np.array([[2**30, 2**29]])
    assert topk._dot(a, a).tolist() == [[2**60 + 2**58]]
    df = spark.createDataFrame([(0, [1e12]), (20, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        top_k(df, "id % 20 = 0")
