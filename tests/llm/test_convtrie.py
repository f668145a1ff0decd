"""The conversation prefix trie against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.convtrie import extents, prefix_trie, sparse_minima, turn_sequences

SCHEMA = "conv_id long, turn long, role string, text string, key string, part int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def _brute(rows, family=20, rebuilt=True):
    convs = {}
    for r in rows:
        if r.conv_id is not None:
            convs.setdefault(r.conv_id, []).append((r.turn, r.role or "", r.text or ""))
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, _digest(t[1], t[2])))
        convs[c] = [t[1:] for t in turns]
    made = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuilt else 0
        base = c - int(np.fmod(c, family))
        made[c] = (convs.get(base, [])[:h] + turns[h:]) if rebuilt else turns
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)

    def below(k):
        yield k
        for x in children.get(k, []):
            yield from below(x)

    out = []
    for k, cs in members.items():
        tree = list(below(k))
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(made[c]) == len(k)))
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in tree if x)
        out.append((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), len(children.get(k, [])),
                    sum(x not in children for x in tree), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _conversations(spark, n=160, seed=1):
    """Shared and equal conversations, null and repeated turns, null roles and texts, gaps in the ids."""
    rnd = random.Random(seed)
    said = ["", "yes", "no thanks", "a longer  answer\twith\nspace", "É ü 中文", "x " * 50]
    rows = []
    for c in range(n):
        if c % 40 == 20 or rnd.random() < 0.1:
            continue  # families without their first conversation
        for t in range(rnd.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, rnd.choice(["user", "assistant"]) if t > 1 else "user", rnd.choice(said[:3] if t < 2 else said)))
    long = [(900, t, "user", said[t % 5]) for t in range(150)]
    rows += long + [(901, *r[1:]) for r in long] + [(902, *r[1:]) for r in long[:120]] + [(903, *r[1:]) for r in long[:121]]
    rows += [(1000 + i, t, "user", "same") for i in range(90) for t in range(3)]
    rows += [(7, None, "user", "null turn"), (7, None, None, None), (7, 1, "user", "tie"), (7, 1, "user", "tie"),
             (None, 0, "user", "nobody"), (-5, 0, "user", "below zero"), (-5, 1, "user", "yes"), (2001, 0, None, "yes")]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def _got(df):
    assert df.columns == COLUMNS
    return sorted([tuple(r) for r in df.collect()], key=repr)


def _lead():
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4


@pytest.mark.parametrize("partitions", [1, 7])
def test_matches_plain_python(spark, partitions):
    rows = _conversations(spark)
    got = _got(prefix_trie(turn_sequences(rows, family=20, lead=_lead()), partitions=partitions))
    assert got == _brute(rows.collect())


def test_own_turns_only(spark):
    rows = _conversations(spark, seed=4)
    assert _got(prefix_trie(turn_sequences(rows), partitions=60)) == _brute(rows.collect(), rebuilt=False)


def test_without_turns_and_without_rows(spark):
    rows = spark.createDataFrame([], SCHEMA)
    assert _got(prefix_trie(turn_sequences(rows, 20, _lead()))) == []
    only = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)  # its one turn is dropped, no family
    rows = spark.createDataFrame([(only, 0, "user", "hello", "", 1), (None, 1, "user", "hello", "", 1)], SCHEMA)
    assert _got(prefix_trie(turn_sequences(rows, 20, _lead()))) == [
        (only, 0, None, 1, 0, 1, 0, hashlib.sha256(str(only).encode()).hexdigest())]


def test_extents_are_those_of_a_scan():
    rnd = np.random.default_rng(1)
    for size in (1, 2, 9, 64, 100):
        lcp = rnd.integers(0, 5, size)
        row, depth = np.repeat(np.arange(size), 6), np.tile(np.arange(6), size)
        left, right = extents(lcp, row, depth)
        for i, d, lo, hi in zip(row, depth, left, right, strict=True):
            a = b = i
            while a > 0 and lcp[a] >= d:
                a -= 1
            while b + 1 < size and lcp[b + 1] >= d:
                b += 1
            assert (a, b) == (lo, hi)
    assert [list(x) for x in sparse_minima(np.array([3, 1, 2]))] == [[3, 1, 2], [1, 1]]
