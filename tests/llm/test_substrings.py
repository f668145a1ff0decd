from collections import Counter

import numpy as np
import pytest

from fixtures import documents, empty, words
from tidemark.llm.substrings import StretchHashes, least_places, remove_repeats


def _brute(rows, window):
    docs = [words(r.text) for r in rows]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    out = Counter()
    for r, w in zip(rows, docs):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        out[(r.doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    return out


@pytest.mark.parametrize("window,anchor", [(35, 8), (12, 4), (5, 5), (70, 7)])
def test_matches_brute_force(spark, window, anchor):
    docs = documents(spark)
    rows = remove_repeats(docs, window=window, anchor=anchor).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows) == _brute(docs.collect(), window)
    for r in rows:  # maximal repeats: apart, and no shorter than a window
        ends = [(s.start, s.end) for s in r.repeats]
        assert all(b - a >= window for a, b in ends) and all(x[1] < y[0] for x, y in zip(ends, ends[1:]))
        assert sum(b - a for a, b in ends) == r.n_removed


@pytest.mark.parametrize("seed", [2, 3])
def test_other_rows(spark, seed):
    docs = documents(spark, seed=seed, n=90)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(docs, window=20, anchor=6).collect())
    assert got == _brute(docs.collect(), 20)


def test_columns_that_are_kept(spark):
    out = remove_repeats(documents(spark), keep=["text", "key", "n"])
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept", "repeats", "text", "key", "n"]
    assert out.where("key <> -1 or n <> 2.0").count() == 0
    assert remove_repeats(empty(spark)).count() == 0


def test_least_places():
    rnd = np.random.default_rng(1)
    for n, span in ((50, 1), (50, 7), (50, 28), (28, 28), (40, 33)):
        v = rnd.integers(0, 9, n).astype(np.uint64)
        assert least_places(v, span).tolist() == [i + int(np.argmin(v[i:i + span])) for i in range(n - span + 1)]


def test_stretch_hashes_depend_on_content_alone():
    w = np.random.default_rng(2).integers(0, 2**63, 40).astype(np.uint64)
    twice = StretchHashes(np.concatenate((w, w)))
    a = np.arange(30)
    assert (twice.of(a, a + 10) == twice.of(a + 40, a + 50)).all()
    assert len(set(twice.of(a, a + 10).tolist())) == 30
