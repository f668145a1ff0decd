from collections import defaultdict

import numpy as np
import pytest

from fixtures import documents, empty, words
from tidemark.llm.components import components
from tidemark.llm.neardup import links, near_duplicates, shingle_sets


def _set(text):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def _brute(rows, percent):
    sets = [_set(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = []
    for group in members.values():
        ids = [rows[i].doc_id for i in group if rows[i].doc_id is not None]
        for i in group:
            c = min(ids, default=None)
            out.append((rows[i].doc_id, len(sets[i]), c, rows[i].doc_id == c))
    return sorted(out, key=repr)


def _near_copies(spark, n=120, seed=3):
    """A large group of near copies of very different closeness, and others."""
    import random

    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rnd.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 6])):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(w)))
    rows += [(n + i, " ".join(rnd.choice(vocabulary) for _ in range(100))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("percent", [85, 60])
def test_matches_brute_force(spark, percent):
    docs = documents(spark)
    got = near_duplicates(docs, percent=percent).drop("key").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(docs.collect(), percent)


@pytest.mark.parametrize("node,depth", [(1024, 10), (6, 3), (6, 1), (3, 2)])
def test_large_groups_of_near_copies(spark, node, depth):
    # small nodes and few levels: the branching, the pivots and the tiles all have to do with it
    docs = _near_copies(spark)
    got = near_duplicates(docs, percent=85, node=node, depth=depth).drop("key").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(docs.collect(), 85)


def test_empty(spark):
    assert near_duplicates(empty(spark)).count() == 0


def test_shingle_sets():
    texts = ["A b c d e f", "a B c d e F", "a b", None, "", "a b c d e a b c d e a", "x"]
    sets, first = shingle_sets(texts)
    assert np.diff(first).tolist() == [len(_set(t)) for t in texts]
    part = [set(sets[first[i]:first[i + 1]].tolist()) for i in range(len(texts))]
    assert part[0] == part[1] and not part[2] & part[6]


def test_links_are_exact_at_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert links(85, [a, a[:85]]) and not links(85, [a, a[:84]])
    found = links(50, [a, a[:60], a[40:], a + np.uint64(1000)])
    assert len(found) == 2 and {x for p in found for x in p} == {0, 1, 2}


def test_components(spark):
    import random

    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] \
        + [(500, 500 + i) for i in range(1, 50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
