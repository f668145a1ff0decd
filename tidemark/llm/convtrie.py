"""Prefix trie of conversations from sorted sequences: range minima over the LCPs of neighbours.

A turn is the MD5 digest of its role and text, a conversation the string of its turns' digests; only digests
and word counts are shuffled. Equal sequences are one class. Classes are sorted over the whole table (range
partitions), so the members of a prefix lie side by side: the extent of the prefix of ``d`` turns of row
``i`` reaches as far to either side as the least common prefix (LCP) of neighbours is at least ``d``. Within
a partition a sparse table holds the minima of the LCPs over runs of every power of two, and each candidate
``(i, d)`` searches its left and right extents by halving steps, independently of all others. What a node
sums over its subtree are differences of running sums over its extent:

* every row that is not followed by an extension of itself is a leaf;
* a row is the first with its prefixes that are longer than the LCP with its predecessor, so the words of the
  distinct prefixes in a subtree are those of its rows beyond that LCP.

All of these are sums over rows, so the parts of a node whose extent goes on in a neighbouring partition
simply add up. A partition knows from its neighbours' edge rows which nodes these are (those of prefixes of
its first or last row); only they are shuffled again, by an MD5 of their prefix.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare

DIGEST = 16
PART_TURNS = 1 << 18  # turns of distinct sequences in a partition
RANGE_TURNS = 64  # turns by which sequences are dealt to partitions (the sort itself takes all)
CHUNK_IDS = 4_096  # ids in one piece of a class's list
NO_IDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """MD5 of a turn, as hex; null role or text counts as empty."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def turn_sequences(conversations: DataFrame, family: int = 1, lead: Column | None = None) -> DataFrame:
    """``(conv_id, key, words)`` per conversation: the digests of its turns and the number of words in each.

    Turns are ordered by ``turn``, null first; turns of equal number by the MD5 of role and text; repeated rows
    are turns of their own. Rows with a null ``conv_id`` belong to no conversation. Words are
    ``[^\\x20\\x09-\\x0D]+``. With ``family`` and ``lead`` a conversation ``c`` is rebuilt: the first ``lead``
    turns of conversation ``c - c % family`` (all it has if fewer, none if it is absent), then its own turns after
    its first ``lead``. Other columns are not read. A conversation's digests (not its texts) are held in one row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).where("conv_id is not null")
    base = F.col("conv_id") - F.col("conv_id") % family
    listed = turns.withColumn("base", base).repartition("base").groupBy("base", "conv_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "digest", "words"))).alias("s"))
    if lead is not None:
        # at most a family's conversations meet here; its first one gives the shared turns
        families = listed.groupBy("base").agg(F.collect_list(F.struct("conv_id", "s")).alias("all"))
        head = F.get(F.filter("all", lambda x: x["conv_id"] == F.col("base")), F.lit(0))["s"]
        each = families.withColumn("head", head).select("head", F.explode("all").alias("c")).select("head", "c.*") \
            .withColumn("lead", lead.cast("int"))
        none = F.slice("s", 1, F.lit(0))
        listed = each.select("conv_id", F.concat(F.coalesce(F.slice("head", 1, F.col("lead")), none),
                                                 F.slice("s", F.col("lead") + 1, F.size("s"))).alias("s"))
    return listed.select("conv_id", F.unhex(F.array_join(F.transform("s", lambda x: x["digest"]), "")).alias("key"),
                         F.transform("s", lambda x: x["words"]).alias("words"))


# ---- lists of ids ---------------------------------------------------------------------------------------
def _chunks(batches):
    for batch in batches:
        cls, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, a = [], 0
        for i in range(1, len(cls) + 1):
            if i == len(cls) or cls[i] != cls[a] or i - a == CHUNK_IDS:
                out.append((cls[a], ids[a], ",".join(map(str, ids[a:i]))))
                a = i
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
                                          pa.array([x[2] for x in out], pa.string())], names=["cls", "at", "ids"])


def _hashed(batches):
    """SHA-256 of each class's pieces, which come in order; a piece at a time."""
    now, state = None, None
    for batch in batches:
        done = []
        for cls, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if cls != now:
                if now is not None:
                    done.append((now, state.hexdigest()))
                now, state = cls, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        yield _ends(done)
    if now is not None:
        yield _ends([(now, state.hexdigest())])


def _ends(rows):
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.binary()),
                                       pa.array([x[1] for x in rows], pa.string())], names=["cls", "ends"])


# ---- nodes of one partition -----------------------------------------------------------------------------
def sparse_minima(x: np.ndarray) -> list[np.ndarray]:
    """``[k][j]``: the least of ``x[j:j + 2 ** k]``."""
    out = [x]
    while 2 * (1 << (len(out) - 1)) <= len(x):
        half, last = 1 << (len(out) - 1), out[-1]
        out.append(np.minimum(last[:-half], last[half:]))
    return out


def extents(lcp: np.ndarray, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share their first ``depth`` turns with ``row``; ``lcp[i]``: common turns of
    rows ``i - 1`` and ``i`` (``lcp[0]`` is not used)."""
    table = sparse_minima(lcp)
    last = len(lcp) - 1
    left, right = row.copy(), row.copy()
    for k in reversed(range(len(table))):
        step, least = 1 << k, table[k]
        may = np.flatnonzero(right + step <= last)
        go = may[least[right[may] + 1] >= depth[may]]
        right[go] += step
        may = np.flatnonzero(left - step >= 0)
        go = may[least[left[may] - step + 1] >= depth[may]]
        left[go] -= step
    return left, right


def common_turns(digests: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Common leading turns of each sequence and the one before (0 for the first)."""
    n = np.diff(offset)
    out = np.zeros(len(n), dtype=np.int64)
    short = np.minimum(n[:-1], n[1:])
    rows = np.flatnonzero(short > 0)
    if len(rows):
        size = short[rows]
        cuts = np.concatenate(([0], np.cumsum(size)[:-1]))
        t = np.arange(size.sum()) - np.repeat(cuts, size)
        one, two = np.repeat(offset[rows], size) + t, np.repeat(offset[rows + 1], size) + t
        same = (digests[one] == digests[two]).all(axis=1)
        out[rows + 1] = np.minimum.reduceat(np.where(same, np.repeat(size, size), t), cuts)
    return out


NODE_SCHEMA = ("id binary, parent_id binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
               "n_children long, n_leaves long, saved_tokens long, ends string")


def partition_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one partition's classes (``key, words, members, least, ends, before, after``). ``before`` and
    ``after`` are the common turns of its first row with the row before and of its last row with the one
    after, -1 if there is none. ``id`` is given for nodes that go on in another partition, ``parent_id`` for
    those whose parent does."""
    keys = table.column("key").to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    table = table.take(pa.array(order))
    keys = [keys[i] for i in order]
    m = len(keys)
    n = np.array([len(k) // DIGEST for k in keys], dtype=np.int64)
    offset = np.concatenate(([0], np.cumsum(n)))
    lcp = np.empty(m + 1, dtype=np.int64)
    lcp[:m] = common_turns(np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2), offset)
    lcp[0], lcp[m] = table.column("before")[0].as_py(), table.column("after")[0].as_py()
    words = table.column("words").combine_chunks()
    run = np.concatenate(([0], np.cumsum(words.flatten().to_numpy(zero_copy_only=False).astype(np.int64))))
    members, least = (table.column(c).to_numpy().astype(np.int64) for c in ("members", "least"))
    ends = table.column("ends").to_pylist()

    # every prefix of every row is a candidate
    begin = np.concatenate(([0], np.cumsum(n + 1)))
    row = np.repeat(np.arange(m), n + 1)
    depth = np.arange(begin[-1]) - begin[row]
    left, right = extents(lcp[:m], row, depth)

    def sums(x):
        return np.concatenate(([0], np.cumsum(x)))

    total = run[offset[1:]] - run[offset[:-1]]
    own = total - (run[offset[:-1] + np.maximum(lcp[:m], 0)] - run[offset[:-1]])
    all_members, all_words, all_own = sums(members), sums(members * total), sums(own)
    leaves = sums(lcp[1:] < n)
    # a row starts a child below the node of the turns that it shares with its predecessor
    child = np.flatnonzero(lcp[:m] >= 0)
    above = begin[left[begin[child] + lcp[child]]] + lcp[child]
    children = np.bincount(above, minlength=begin[-1])

    node = np.flatnonzero(left == row)  # one candidate of each node
    first, last, d = row[node], right[node], depth[node]
    fresh = d > lcp[first]  # the node starts here, not in an earlier partition
    before = run[offset[first] + np.maximum(d - 1, 0)] - run[offset[first]]
    convs = all_members[last + 1] - all_members[first]
    owned = all_own[last + 1] - all_own[first + 1] + np.where(fresh, total[first] - before, own[first])
    saved = all_words[last + 1] - all_words[first] - convs * before - owned
    power = np.floor(np.log2(last - first + 1)).astype(np.int64)
    minima = sparse_minima(least)
    conv = np.empty(len(node), dtype=np.int64)
    for k in np.unique(power):
        at = power == k
        conv[at] = np.minimum(minima[k][first[at]], minima[k][last[at] - (1 << k) + 1])
    goes_on = ((first == 0) & (d <= lcp[0])) | ((last == m - 1) & (d <= lcp[m]))

    place = np.full(begin[-1], -1, dtype=np.int64)
    place[node] = np.arange(len(node))
    parent = np.full(len(node), -1, dtype=np.int64)
    below = np.flatnonzero(d > 0)
    parent[below] = place[begin[left[begin[first[below]] + d[below] - 1]] + d[below] - 1]
    known = (parent >= 0) & ~goes_on[parent]

    def prefix_id(i, turns):
        return hashlib.md5(keys[i][:DIGEST * turns]).digest()

    open_parent = (parent >= 0) & goes_on[parent]
    own_id = [prefix_id(i, t) if g else None for i, t, g in zip(first.tolist(), d.tolist(), goes_on.tolist(), strict=True)]
    up_id = [own_id[p] if o else None for p, o in zip(parent.tolist(), open_parent.tolist(), strict=True)]
    end = np.flatnonzero(fresh & (d == n[first]))
    told = [None] * len(node)
    for x in end.tolist():
        told[x] = ends[first[x]]
    return pa.table({
        "id": pa.array(own_id, pa.binary()), "parent_id": pa.array(up_id, pa.binary()),
        "conv_id": conv, "depth": d, "parent_conv_id": pa.array(conv[parent], mask=~known), "n_convs": convs,
        "n_children": children[node] + (fresh & (d < n[first])), "n_leaves": leaves[last + 1] - leaves[first],
        "saved_tokens": saved, "ends": pa.array(told, pa.string())})


def _edge_turns(batches):
    for batch in batches:
        first, before, last, after = (batch.column(i).to_pylist() for i in range(1, 5))

        def same(x, y):
            if x is None or y is None:
                return -1
            a, b = (np.frombuffer(z[:min(len(x), len(y))], dtype="<u8").reshape(-1, 2) for z in (x, y))
            differ = np.flatnonzero((a != b).any(axis=1))
            return int(differ[0]) if len(differ) else len(a)

        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([same(x, y) for x, y in zip(before, first, strict=True)], pa.int32()),
             pa.array([same(x, y) for x, y in zip(last, after, strict=True)], pa.int32())],
            names=["part", "before", "after"])


def prefix_trie(sequences: DataFrame, part_turns: int = PART_TURNS, partitions: int | None = None) -> DataFrame:
    """One row per node of the trie of ``sequences`` (``conv_id, key, words`` of :func:`turn_sequences`): every
    distinct sequence of the first ``d`` turns, from the root (``d = 0``).

    ``conv_id``: the smallest member; ``depth``; ``parent_conv_id``: the parent's ``conv_id`` (null for the root);
    ``n_convs``: members; ``n_children``; ``n_leaves``: childless nodes in the subtree, itself included;
    ``saved_tokens``: summed over the subtree, ``n_convs - 1`` times the words of the node's last turn;
    ``ends_sha256``: SHA-256 of the ids of the members that end here, ascending, joined by commas. No
    conversation: no row. A conversation without turns is a member of the root. Ids are taken to differ; one
    that repeats counts as often as it is there. A class of equal conversations is one row however large;
    the ids of a class are hashed piece by piece. Sequences are dealt by their first 64 turns: only
    conversations that agree in all of these must fit into one partition together.
    """
    spark = sequences.sparkSession
    prepare(spark)
    rebuilt = cut(sequences.withColumn("cls", F.unhex(F.md5("key"))), "conv-sequences")
    pieces = rebuilt.select("cls", "conv_id").repartitionByRange("cls", "conv_id").sortWithinPartitions("cls", "conv_id") \
        .mapInArrow(_chunks, "cls binary, at long, ids string")
    ends = pieces.repartition("cls").sortWithinPartitions("cls", "at").mapInArrow(_hashed, "cls binary, ends string")
    classes = rebuilt.groupBy("cls").agg(F.first("key").alias("key"), F.first("words").alias("words"),
                                         F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("least"))
    turns = rebuilt.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    parts = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // part_turns))
    dealt = cut(classes.join(ends, "cls").drop("cls")
                .repartitionByRange(parts, F.substring("key", 1, DIGEST * RANGE_TURNS))
                .withColumn("part", F.spark_partition_id()), "conv-classes")

    # one row per partition, with its neighbours' edges
    edge = dealt.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    beside = Window.orderBy("part")
    near = edge.select("part", "first", F.lag("last").over(beside).alias("prev"), "last", F.lead("first").over(beside).alias("next")) \
        .mapInArrow(_edge_turns, "part int, before int, after int")
    nodes = cut(dealt.join(near, "part").groupBy("part").applyInArrow(partition_nodes, NODE_SCHEMA), "conv-nodes")

    whole = nodes.where("id is null").drop("id")
    merged = cut(nodes.where("id is not null").groupBy("id", "depth").agg(
        F.first("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"),
        F.max("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.max("ends").alias("ends")),
        "conv-merged")
    every = whole.unionByName(merged.drop("id"))
    above = merged.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("above"))
    # the root's children may be a large part of all nodes; both sides are written, so Spark can split them
    return every.join(above, "parent_id", "left").select(
        "conv_id", "depth", F.coalesce("above", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_IDS)).alias("ends_sha256"))
