"""The Jaccard join against plain Python."""

import itertools
import random
from collections import defaultdict

import numpy as np
import pytest

from fixtures import documents, empty, words
from tidemark.llm.setjoin import allocation, bands, jaccard_join, links, most_differing, segment_keys, sketches, token_sets


def _set(text, n=3):
    w = words(text, lower=True)
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def _brute(rows, percent, n=3):
    sets = [_set(r.text, n) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = []
    for group in members.values():
        least = min((rows[i].doc_id for i in group if rows[i].doc_id is not None), default=None)
        out += [(rows[i].doc_id, len(sets[i]), least) for i in group]
    return sorted(out, key=repr)


def _near_copies(spark, n=150, seed=3):
    """Groups of near copies about the threshold, long and short, and unlike texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for size in (150, 12, 40):
        base = [rnd.choice(vocabulary) for _ in range(size)]
        for _ in range(n):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
                at = rnd.randrange(len(w))
                w[at:at + rnd.choice([0, 1, 1])] = [rnd.choice(vocabulary)]
            if rnd.random() < 0.2:
                del w[rnd.randrange(len(w)):]
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(8, 100)))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=repr)


@pytest.mark.parametrize(("percent", "shingle"), [(90, 3), (80, 5), (95, 1)])
def test_matches_plain_python(spark, percent, shingle):
    docs = documents(spark)
    assert _got(jaccard_join(docs, percent, shingle)) == _brute(docs.collect(), percent, shingle)


@pytest.mark.parametrize("group_tokens", [1 << 18, 2_000])
def test_near_copies_in_small_and_tiled_groups(spark, group_tokens):
    docs = _near_copies(spark)
    assert _got(jaccard_join(docs, group_tokens=group_tokens)) == _brute(docs.collect(), 90)


def test_deletion_neighbourhoods_find_the_same(spark):
    docs = _near_copies(spark, n=60, seed=5)

    def deletions_only(size, differing, sets):
        return 0, (differing + 2) // 2

    def mixed(size, differing, sets):
        b = (differing + 1) // 3
        return max(0, differing + 1 - 2 * b), b

    want = _brute(docs.collect(), 90)
    assert _got(jaccard_join(docs, allocate=deletions_only)) == want
    assert _got(jaccard_join(docs, allocate=mixed)) == want


def test_empty_table_and_no_words(spark):
    assert jaccard_join(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, None), (2, ""), (None, " "), (3, "a"), (4, "A")], "doc_id long, text string")
    assert _got(jaccard_join(docs)) == sorted([(1, 0, 1), (2, 0, 2), (None, 0, None), (3, 1, 3), (4, 1, 3)], key=repr)


def test_very_long_text(spark):
    rnd = random.Random(1)
    w = [f"v{rnd.randrange(10**6)}" for _ in range(60_000)]
    near = list(w)
    for i in range(0, 60_000, 100):
        near[i] = "x"
    docs = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(near)), (3, " ".join(w[:50_000]))],
                                 "doc_id long, text string")
    assert _got(jaccard_join(docs)) == _brute(docs.collect(), 90)


def test_bands_cover_all_partners():
    for percent in (60, 85, 90, 99):
        found = bands(percent, 7000)
        place = {s: k for k, (lo, hi, _) in enumerate(found) for s in range(lo, hi + 1)}
        assert all(most_differing(s, percent) < 1 for s in range(1, found[0][0]))
        for s in range(found[0][0], 4000):
            for t in (s, s * 100 // percent):
                assert place[t] - place[s] in (0, 1)
                least = -(-percent * (s + t) // (100 + percent))  # of the intersection
                assert s + t - 2 * least <= found[place[s]][2]


def test_allocation_covers_and_follows_cost():
    for size, differing in ((10, 1), (40, 4), (1000, 105)):
        for sets in (0, 10, 10**4, 10**9):
            a, b = allocation(size, differing, sets)
            assert a + 2 * b > differing
    assert allocation(10, 1, 100) == (2, 0) and allocation(10, 1, 10**9) == (0, 1)


def test_pigeonhole_on_random_pairs():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(9, 200)
        common = [rnd.getrandbits(64) for _ in range(n)]
        lo, hi, differing = next(x for x in bands(90, 400) if x[0] <= n <= x[1])
        extra = [rnd.getrandbits(64) for _ in range(differing)]
        at = rnd.randint(0, differing)
        x, y = sorted({*common, *extra[:at]}), sorted({*common, *extra[at:]})
        sets, first = np.array(x + y, dtype=np.uint64), np.array([0, len(x), len(x) + len(y)])
        for b in range((differing + 2) // 2 + 1):
            a = max(0, differing + 1 - 2 * b)
            key, own = segment_keys(sets, first, np.array([3, 3]), np.array([a, a]), np.array([b, b]))
            assert set(key[own == 0]) & set(key[own == 1])


def test_links_skip_what_is_connected():
    sets, _ = token_sets(["a b c d e f g h i j k l m n", "a b c d e f g h i j k l m n", "x y z"], 3)
    one, two = sets[:12], sets[12:24]
    assert links(90, [one, two], np.array([1, 2])) == [(0, 1)]
    assert links(90, [one, two], np.array([7, 7])) == []


def test_sketches_differ_in_no_more_bits_than_the_sets_in_tokens():
    rnd = random.Random(7)
    for _ in range(200):
        pool = [rnd.getrandbits(64) for _ in range(80)]
        x, y = (sorted(rnd.sample(pool, rnd.randint(1, 80))) for _ in range(2))
        sets, first = np.array(x + y, dtype=np.uint64), np.array([0, len(x), len(x) + len(y)])
        one, two = (np.unpackbits(np.frombuffer(s, dtype=np.uint8)) for s in sketches(sets, first, np.array([128, 128])))
        assert (one != two).sum() <= len(set(x) ^ set(y))
        assert (one != two).sum() % 2 == len(set(x) ^ set(y)) % 2
