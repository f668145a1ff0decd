"""Near-duplicate documents by a chosen-path similarity join over word shingles.

Documents of equal shingle sets are one class. Each class has ``MINWISE`` minwise tokens (the least hash
of its set under as many hash functions). A tree branches classes by one token at its root, so similar
classes mostly fall into the same node; nodes of more than ``NODE`` classes branch again by further
tokens that the path selects, several at first and about one over the similarity later, so that a pair at
the threshold stays together in some node while less similar ones part. Nodes of bounded size are
compared exhaustively: their tokens tell which classes have a likely partner, and only those bring their
full sets for the exact comparison. ``TREES`` independent trees make it all but certain that a pair at
the threshold meets: the probability of a miss is below 1e-5, and links are exact in any case.

Nodes that are still too large at the last level hold classes of one huge group of near copies. Their
classes are compared with one pivot first; those that this leaves outside the main component are compared
with all others, tile by tile, so nothing is capped or dropped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, among, byte_groups, cut, doc_key, gram_hashes, mix64, prepare
from tidemark.llm.components import components

SHINGLE = 5
MINWISE = 128
TREES = 10
NODE = 2_048  # classes compared exhaustively at a time
DEPTH = 10
FIRST_BRANCHES = 3
GROUP_CHARS = 1 << 20

_U = np.uint64
_FACTORS = (mix64(np.arange(1, MINWISE + 1, dtype=np.uint64)) >> _U(32)).astype(np.uint32) | np.uint32(1)
_OTHER = _U(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, sorted, and their number before each text.

    A text's shingles are its runs of ``SHINGLE`` words in lower case (A-Z); with fewer words, but not
    none, the whole sequence is one."""
    w = Words(texts, lower=True)
    words = w.hashes()
    n = np.diff(w.first)
    grams = gram_hashes(words, SHINGLE)
    text = np.repeat(np.arange(len(texts)), n)
    at = np.flatnonzero(text[:len(grams)] == text[SHINGLE - 1:][:len(grams)]) if len(grams) else np.zeros(0, dtype=np.int64)
    value, own = [grams[at]], [text[at]]
    for size in range(1, SHINGLE):
        short = np.flatnonzero(n == size)
        if len(short):
            value.append(mix64(gram_hashes(words, size)[w.first[short]] + _U(size)))
            own.append(short)
    value, own = np.concatenate(value), np.concatenate(own)
    order = np.argsort(value)
    order = order[np.argsort(own[order].astype(np.uint16 if len(texts) < 65536 else np.int64), kind="stable")]
    value, own = value[order], own[order]
    if len(value):
        new = np.concatenate(([True], (value[1:] != value[:-1]) | (own[1:] != own[:-1])))
        value, own = value[new], own[new]
    return value, np.searchsorted(own, np.arange(len(texts) + 1))


def _features(batches):
    for batch in batches:
        texts = batch.column(2).to_pylist()
        sizes, classes, tokens = [], [], []
        for a, b in byte_groups(texts, GROUP_CHARS):
            sets, first = shingle_sets(texts[a:b])
            n = np.diff(first)
            full = np.flatnonzero(n)
            cls = np.zeros(b - a, dtype=np.uint64)
            sig = np.zeros((b - a, MINWISE), dtype=np.uint32)
            if len(full):
                start = first[:-1][full]
                with np.errstate(over="ignore"):
                    one = np.add.reduceat(mix64(sets), start, dtype=np.uint64)
                    two = np.add.reduceat(mix64(sets ^ _OTHER), start, dtype=np.uint64)
                    cls[full] = mix64(mix64(one) * _OTHER + two + n[full].astype(np.uint64))
                    short = (sets >> _U(32)).astype(np.uint32)
                    for i, f in enumerate(_FACTORS):
                        sig[full, i] = np.minimum.reduceat(short * f, start)
            sizes.append(n)
            classes.append(cls)
            tokens.append(sig)
        if not sizes:
            continue
        n = np.concatenate(sizes).astype(np.int64)
        flat = pa.array(np.concatenate(tokens).view(np.int32).ravel())
        offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * MINWISE)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n),
             pa.array(np.concatenate(classes).view(np.int64), mask=n == 0), pa.ListArray.from_arrays(offsets, flat)],
            names=["id", "key", "n", "cls", "sig"])


def least_agreement(percent: int) -> int:
    """Equal minwise tokens that a pair at the threshold misses with a probability of about 1e-6."""
    p = percent / 100
    return max(1, math.floor(MINWISE * (p - 4.7 * math.sqrt(p * (1 - p) / MINWISE))))


def _likely(percent: int, table: pa.Table) -> pa.Table:
    """Of one node (``node, cls, tree, mask, n, sig``): the classes that have a likely partner in it.

    A pair that also shares the root of an earlier tree, in a node compared there, is left to that node."""
    m = table.num_rows
    sig = table.column("sig").combine_chunks().flatten().to_numpy().reshape(m, MINWISE)
    n, mask = (table.column(c).to_numpy() for c in ("n", "mask"))
    tree = int(table.column("tree")[0].as_py())
    likely = np.zeros(m, dtype=bool)
    least = least_agreement(percent)
    for a in range(0, m, 64):
        rows = slice(a, min(m, a + 64))
        ok = (sig[rows, None, :] == sig[None, :, :]).sum(axis=2) >= least
        small, big = np.minimum(n[rows, None], n[None, :]), np.maximum(n[rows, None], n[None, :])
        ok &= 100 * small >= percent * big
        for t in range(TREES if tree < 0 else tree):
            ok &= ~((sig[rows, None, t] == sig[None, :, t]) & ((mask[rows, None] & mask[None, :]) >> t & 1).astype(bool))
        ok[np.arange(rows.stop - a), np.arange(a, rows.stop)] = False
        likely |= ok.any(axis=0)
        likely[rows] |= ok.any(axis=1)
    return table.select(["node", "cls"]).filter(pa.array(likely))


def links(percent: int, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of a forest that connects all sets which links connect: pairs with
    ``100 * |intersection| >= percent * |union|``, counted on the full sets."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(-size, kind="stable")
    sets, size = [sets[i] for i in order], size[order]
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate(([0], np.cumsum(size)))
    seen = np.zeros(ids.max() + 1, dtype=np.int64)
    group = np.arange(len(sets))
    out = []
    for a in range(len(sets) - 1):
        # sizes fall: partners are the following sets down to percent of this one
        b = a + 1 + int(np.searchsorted(-size[a + 1:], -(-(-percent * size[a] // 100)), side="right"))
        if b == a + 1 or (group[a + 1:b] == group[a]).all():
            continue
        seen[ids[first[a]:first[a + 1]]] = 1
        both = np.add.reduceat(seen[ids[first[a + 1]:first[b]]], first[a + 1:b] - first[a + 1])
        seen[ids[first[a]:first[a + 1]]] = 0
        near = np.flatnonzero(100 * both >= percent * (size[a] + size[a + 1:b] - both)) + a + 1
        for x in near:
            if group[x] != group[a]:
                out.append((int(order[a]), int(order[x])))
                group[group == group[x]] = group[a]
    return out


def _exact(percent: int, table: pa.Table) -> pa.Table:
    cls = table.column("cls").to_numpy()
    found = links(percent, [np.frombuffer(s.as_buffer(), dtype="<u8") for c in table.column("shingles").chunks for s in c])
    return pa.table({"a": pa.array([cls[i] for i, _ in found], pa.int64()),
                     "b": pa.array([cls[j] for _, j in found], pa.int64())})


def _sized(members: DataFrame, name: str) -> DataFrame:
    """Members of nodes of two and more, with the node's size; written out."""
    sizes = cut(members.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), f"{name}-sizes")
    return cut(members.join(sizes, "node"), name)


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
                    node: int = NODE, depth: int = DEPTH, with_root: bool = False) -> DataFrame:
    """``(id, n_shingles, component_id, kept, key)`` per row: the size of its shingle set, the least id that
    links reach from it, whether it is that row, and its :func:`tidemark.llm.common.doc_key`. With
    ``with_root`` also ``root``, which tells groups apart where ids are null or repeat (null without words).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; rows are linked if
    ``100 * |intersection| >= percent * |union|`` of their sets of 5-word shingles. A text of fewer words is
    one shingle; one without words (or null) has none and is linked with nothing. Null ids are never the
    least: a row with a null id is kept only if no id is reached. Repeated ids are rows of their own that
    share an id. An empty table gives no row. Other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), doc_key(id_col, text_col).alias("key"),
                       F.col(text_col).alias("text"))
    feats = cut(rows.mapInArrow(_features, "id long, key long, n long, cls long, sig array<int>"), "shingles")
    some = feats.where("n > 0")
    reps = cut(some.groupBy("cls").agg(F.min("id").alias("id"), F.min("key").alias("key")), "classes")

    def tokens_of(classes: DataFrame) -> DataFrame:
        """``(cls, n, sig)`` of the classes that ``classes`` names, and of few others."""
        return among(some.select("cls", "n", "sig"), classes, key="cls").groupBy("cls").agg(
            F.first("n").alias("n"), F.first("sig").alias("sig"))

    # level 1: a tree's root branches by its own token
    first = some.select("cls", F.slice("sig", 1, TREES).alias("roots")).groupBy("cls").agg(F.first("roots").alias("roots")) \
        .select("cls", F.posexplode("roots").alias("tree", "token")) \
        .select(F.xxhash64("tree", "token").alias("node"), "cls", "tree")
    members = _sized(first, "nodes-1")
    mask = cut(members.where(F.col("size") <= node).groupBy("cls").agg(
        F.bit_or(F.expr("shiftleft(1, tree)")).alias("mask")), "small-roots")
    leaves = [members.where(F.col("size") <= node).select("node", "cls", "tree")]
    large = members.where(F.col("size") > node).select("node", "cls")
    level = 1
    while level < depth and not large.isEmpty():
        level += 1
        # tokens after the roots', selected by the path: several at first, then one, and for some paths two
        alone = 100 - round(10_000 / percent - 100)  # percent of paths that select one token
        tokens = [F.pmod(F.xxhash64("node", F.lit(j)), F.lit(MINWISE - TREES)) + TREES + 1
                  for j in range(FIRST_BRANCHES if level == 2 else 2)]
        children = [F.xxhash64("node", t, F.element_at("sig", t.cast("int"))) for t in tokens]
        if level > 2:
            second = F.pmod(F.xxhash64("node", F.lit("second")), F.lit(100)) >= alone
            children[1] = F.when(second, children[1])
        branched = large.join(tokens_of(large).select("cls", "sig"), "cls") \
            .select(F.explode(F.array_distinct(F.array(*children))).alias("node"), "cls").where("node is not null")
        members = _sized(branched, f"nodes-{level}")
        leaves.append(members.where(F.col("size") <= node).select("node", "cls", F.lit(-1).alias("tree")))
        large = members.where(F.col("size") > node).select("node", "cls")

    def sets_in(nodes: DataFrame) -> DataFrame:
        """``(node, cls, shingles)`` for the rows ``(node, cls)``: full sets, each from the text of one row of
        the class, which is read once for all nodes that ask for it."""
        wanted = cut(nodes.groupBy("cls").agg(F.collect_set("node").alias("nodes"))
                     .join(reps.select("cls", "key"), "cls"), "wanted")
        texts = among(rows.select("key", "text"), wanted).join(wanted, "key").groupBy("key").agg(
            F.first("cls").alias("cls"), F.first("nodes").alias("nodes"), F.first("text").alias("text"))

        def run(batches):
            for batch in batches:
                cls, asked, texts = (batch.column(i).to_pylist() for i in range(3))
                for a, b in byte_groups(texts, GROUP_CHARS):
                    sets, first = shingle_sets(texts[a:b])
                    for i in range(a, b):
                        own = sets[first[i - a]:first[i - a + 1]].astype("<u8").tobytes()
                        n = len(asked[i])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(asked[i], pa.int64()), pa.array([cls[i]] * n, pa.int64()),
                             pa.array([own] * n, pa.binary())], names=["node", "cls", "shingles"])

        return texts.select("cls", "nodes", "text").mapInArrow(run, "node long, cls long, shingles binary")

    def compared(leaf: DataFrame) -> DataFrame:
        with_tokens = leaf.join(mask, "cls", "left").na.fill({"mask": 0}).join(tokens_of(leaf), "cls")
        likely = cut(with_tokens.groupBy("node").applyInArrow(lambda t: _likely(percent, t), "node long, cls long"), "likely")
        return cut(sets_in(likely).groupBy("node").applyInArrow(lambda t: _exact(percent, t), "a long, b long"), "links")

    leaf = leaves[0]
    for x in leaves[1:]:
        leaf = leaf.unionByName(x)
    edges = compared(leaf)
    if not large.isEmpty():
        edges = edges.unionByName(_large_nodes(large, edges, sets_in, compared, percent, node))

    roots = components(edges)
    own = reps.select("cls", "id").join(roots.withColumnRenamed("node", "cls"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    least = cut(own.groupBy("root").agg(F.min("id").alias("component")), "least-ids")
    named = cut(own.join(least, "root").select("cls", "component", "root"), "components")
    out = feats.select("id", "key", "n", "cls").join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"), "key", *(["root"] if with_root else []))


def _large_nodes(large: DataFrame, edges: DataFrame, sets_in, compared, percent: int, node: int) -> DataFrame:
    """Links in nodes that are too large at the last level: all members with a pivot, then those outside the
    node's main component with all others, in tiles."""
    pivot = cut(large.groupBy("node").agg(F.min_by("cls", F.xxhash64("cls")).alias("pivot")), "pivots")
    pairs = cut(large.join(pivot, "node").where("cls <> pivot").select("cls", "pivot").distinct(), "pivot-pairs")
    sets = cut(sets_in(large.select(F.lit(0).cast("long").alias("node"), "cls").distinct()).drop("node"), "sets")

    def run(batches):
        for batch in batches:
            a, b = (batch.column(i).to_numpy() for i in range(2))
            own, other = batch.column(2), batch.column(3)
            ok = [bool(links(percent, [np.frombuffer(x.as_buffer(), dtype="<u8") for x in two]))
                  for two in zip(own, other, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])

    stars = cut(pairs.join(sets, "cls")
                .join(sets.select(F.col("cls").alias("pivot"), F.col("shingles").alias("other")), "pivot")
                .select("cls", "pivot", "shingles", "other").mapInArrow(run, "a long, b long"), "pivot-links")
    roots = components(edges.unionByName(stars))
    placed = cut(large.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
                 .withColumn("root", F.coalesce("root", "cls")), "placed")
    share = placed.groupBy("node", "root").agg(F.count(F.lit(1)).alias("c"))
    main = cut(share.groupBy("node").agg(F.max_by("root", F.struct("c", "root")).alias("main"),
                                         F.sum("c").alias("all"), F.max("c").alias("most")).where("most < all"), "mains")
    half = max(1, node // 2)

    def tile(column: str, count):
        return F.pmod(F.xxhash64("cls", F.lit(column)), F.ceil(count / half)).cast("int")

    def tiles(count):
        return F.sequence(F.lit(0), F.ceil(count / half).cast("int") - 1)

    of = placed.join(main, "node").withColumn("few", F.col("all") - F.col("most"))
    outside = of.where("root <> main").select("node", "cls", tile("few", F.col("few")).alias("x"),
                                              F.explode(tiles(F.col("all"))).alias("y"))
    inside = of.select("node", "cls", F.explode(tiles(F.col("few"))).alias("x"), tile("all", F.col("all")).alias("y"))
    units = outside.unionByName(inside).select(F.xxhash64("node", "x", "y").alias("node"), "cls",
                                               F.lit(-1).alias("tree")).distinct()
    return stars.unionByName(compared(cut(units, "tiles")))
