"""Exact Jaccard join of shingle sets by universe partition and the pigeonhole principle.

Rows of equal sets are one class. Sizes are cut into bands, so narrow that a partner lies in the same or
the next band; a set is *home* in its own band and a *guest* in the one below. Two sets of a band whose
similarity reaches the threshold differ in at most ``H`` tokens (symmetric difference). A band cuts the
universe of hashed tokens into ``a + b`` ranges, its segments: were the two to differ in at least one
token in each of the ``a`` segments, and in at least two in each of the ``b`` others, they would differ in
``a + 2 b > H``. So they agree in one of the former, or differ by at most one token in one of the latter.
A set is therefore filed under its subset in each segment, and for the ``b`` segments also under all that
the subset becomes when one token is deleted. Band by band, ``b`` is the one of least cost by the number of
sets that meet there: deletions cost rows, small segments chance candidates (:func:`allocation`).

What is filed under one key are candidates; every link is confirmed on full sets. Near copies meet under
many keys, and some groups are huge, so they are not expanded: first each member is compared with one
pivot of its key. Keys whose members that connects are done. Of the others, members of different
components are compared exhaustively, within a group of bounded size, or tile by tile in a larger one:
those outside its main component with all.

Full sets are brought together only where a sketch does not rule a link out: a bit for each of about two
slots a token, flipped by every token that hashes there. Two sketches differ in at most as many bits as
the sets in tokens, so a pair whose sketches differ in more bits than a link allows is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, among, byte_groups, cut, doc_key, gram_hashes, mix64, prepare
from tidemark.llm.components import components

GROUP_CHARS = 1 << 20
GROUP_TOKENS = 1 << 18  # tokens of all sets that are compared exhaustively at a time
DELETION_ROW = 1.0  # cost of one key of one set
CHANCE_PAIR = 20.0  # cost of one pair of unlike sets that meet by chance

_U = np.uint64
_OTHER = _U(0xD6E8FEB86659FD93)


# ---- bands and their segments ---------------------------------------------------------------------------
def most_differing(size: int, percent: int) -> int:
    """Most tokens in which a set of this size and a linked one of the same or a larger size can differ."""
    return (size + size * 100 // percent) * (100 - percent) // (100 + percent)


def bands(percent: int, largest: int) -> list[tuple[int, int, int]]:
    """``(least, greatest, H)`` of each band up to ``largest``. Sets below the first link with equal ones only."""
    low = 1
    while low <= largest and most_differing(low, percent) < 1:
        low += 1
    out = []
    while low <= largest:
        high = max(low, low * 100 // percent)
        out.append((low, high, most_differing(high, percent)))
        low = high + 1
    return out


def allocation(size: int, differing: int, sets: int) -> tuple[int, int]:
    """``(a, b)``: segments to match as they are and with one deletion, so that ``a + 2 b > differing``, of least
    cost for ``sets`` sets of ``size`` tokens. A pair meets by chance where both have next to nothing in a
    segment: the number of tokens there is taken as Poisson distributed."""
    best = None
    for b in range((differing + 2) // 2 + 1):
        a = max(0, differing + 1 - 2 * b)
        mean = size / (a + b)
        rows = sets * (a + b * (1 + mean))
        chance = sets * sets / 2 * np.exp(-2 * mean) * (a + b * (1 + 2 * mean))
        cost = rows * DELETION_ROW + chance * CHANCE_PAIR
        if best is None or cost < best[0]:
            best = (cost, a, b)
    return best[1:]


# ---- sets and their keys --------------------------------------------------------------------------------
def token_sets(texts: list[str | None], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct ``n``-word shingles of each text, sorted, and their number before each text; a text
    of fewer words, but not none, is one shingle."""
    w = Words(texts, lower=True)
    words = w.hashes()
    count = np.diff(w.first)
    text = np.repeat(np.arange(len(texts)), count)
    grams = gram_hashes(words, n)
    whole = text[:len(grams)] == text[n - 1:n - 1 + len(grams)]
    value, own = [grams[whole]], [text[:len(grams)][whole]]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        value.append(mix64(gram_hashes(words, size)[w.first[short]] + _U(size)) if len(short) else grams[:0])
        own.append(short)
    value, own = np.concatenate(value), np.concatenate(own).astype(np.int64)
    order = np.lexsort((value, own))
    value, own = value[order], own[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    value, own = value[new], own[new]
    return value, np.searchsorted(own, np.arange(len(texts) + 1))


def class_ids(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One id per set, equal for equal sets (0 for empty ones)."""
    n = np.diff(first)
    full = np.flatnonzero(n)
    out = np.zeros(len(n), dtype=np.uint64)
    if len(full):
        with np.errstate(over="ignore"):
            one = np.add.reduceat(mix64(sets), first[:-1][full], dtype=np.uint64)
            two = np.add.reduceat(mix64(sets ^ _OTHER), first[:-1][full], dtype=np.uint64)
            out[full] = mix64(mix64(one) * _OTHER + two + n[full].astype(np.uint64))
    return out


def segment_keys(sets: np.ndarray, first: np.ndarray, band: np.ndarray, a: np.ndarray, b: np.ndarray):
    """``(key, owner)``: the keys that each set files under in its band, of ``a`` segments matched as they are
    and ``b`` with one deletion."""
    sizes, m = np.diff(first), a + b
    own = np.repeat(np.arange(len(sizes)), sizes)
    start = np.concatenate(([0], np.cumsum(m)))
    # segments are ranges of the hashed universe, so sorted tokens lie segment by segment
    part = ((sets >> _U(32)) * m[own].astype(np.uint64)) >> _U(32)
    at = start[own] + part.astype(np.int64)
    mixed = mix64(sets ^ _OTHER)
    total = np.zeros(start[-1], dtype=np.uint64)
    with np.errstate(over="ignore"):
        if len(at):
            edge = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            total[at[edge]] = np.add.reduceat(mixed, edge, dtype=np.uint64)
        owner = np.repeat(np.arange(len(sizes)), m)
        number = (np.arange(start[-1]) - start[owner]).astype(np.uint64)
        place = mix64((band[owner].astype(np.uint64) << _U(40)) + number + _U(1))
        deleted = np.flatnonzero(number[at] < b[own].astype(np.uint64)) if len(at) else np.zeros(0, dtype=np.int64)
        key = np.concatenate((mix64(mix64(total) ^ place),
                              mix64(mix64(total[at[deleted]] - mixed[deleted]) ^ place[at[deleted]])))
    return key, np.concatenate((owner, own[deleted]))


def sketches(sets: np.ndarray, first: np.ndarray, slots: np.ndarray) -> list[bytes]:
    """Parity of the tokens in each of a set's ``slots`` (a multiple of 64): 8 slots a byte."""
    out = []
    for i, n in enumerate(slots.tolist()):
        at = (mix64(sets[first[i]:first[i + 1]]) % _U(n)).astype(np.int64) if n else np.zeros(0, dtype=np.int64)
        out.append(np.packbits((np.bincount(at, minlength=n) & 1).astype(np.uint8)).tobytes())
    return out


def slots_of(high: np.ndarray) -> np.ndarray:
    """Slots of the sketches in a band of sets of up to ``high`` tokens."""
    return 64 * (high // 32 + 1)


def _bits_apart(one: bytes, two: bytes) -> int:
    a, b = (np.frombuffer(x, dtype="<u8") for x in (one, two))
    return int(np.bitwise_count(a ^ b).sum())


def _sets(batches, column: int, n: int) -> Iterator:
    """``(batch, from, to, sets, first)`` for runs of rows of bounded size."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        for x, y in byte_groups(texts, GROUP_CHARS):
            yield batch, x, y, *token_sets(texts[x:y], n)


# ---- exhaustive comparison ------------------------------------------------------------------------------
def links(percent: int, sets: list[np.ndarray], root: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all sets which links connect, given that those of one ``root`` already are: pairs with
    ``100 * |intersection| >= percent * |union|``, counted on the full sets."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(-size, kind="stable")
    sets, size, group = [sets[i] for i in order], size[order], np.unique(root[order], return_inverse=True)[1]
    first = np.concatenate(([0], np.cumsum(size)))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    seen = np.zeros(ids.max() + 1, dtype=np.int64)
    out = []
    for x in range(len(sets) - 1):
        # sizes fall: partners are the following sets down to percent of this one, of other groups
        end = x + 1 + int(np.searchsorted(-size[x + 1:], -(-(-percent * size[x] // 100)), side="right"))
        other = np.flatnonzero(group[x + 1:end] != group[x]) + x + 1
        if not len(other):
            continue
        seen[ids[first[x]:first[x + 1]]] = 1
        taken = size[other]
        flat = np.repeat(first[other] - np.concatenate(([0], np.cumsum(taken)[:-1])), taken) + np.arange(taken.sum())
        both = np.add.reduceat(seen[ids[flat]], np.concatenate(([0], np.cumsum(taken)[:-1])))
        seen[ids[first[x]:first[x + 1]]] = 0
        for y in other[100 * both >= percent * (size[x] + taken - both)]:
            if group[y] != group[x]:
                out.append((int(order[x]), int(order[y])))
                group[group == group[y]] = group[x]
    return out


def _unpacked(column) -> list[np.ndarray]:
    return [np.frombuffer(s.as_buffer(), dtype="<u8") for c in column.chunks for s in c]


def _compare(percent: int, table: pa.Table) -> pa.Table:
    cls = table.column("cls").to_numpy()
    found = links(percent, _unpacked(table.column("tokens")), table.column("root").to_numpy())
    return pa.table({"a": pa.array([cls[i] for i, _ in found], pa.int64()),
                     "b": pa.array([cls[j] for _, j in found], pa.int64())})


def _possible_pairs(percent: int):
    """Of ``(cls, other, n, home, guest, m, home2, guest2)`` the pairs that their sketches do not rule out."""
    def run(batches):
        for batch in batches:
            n, home, guest, m, home2, guest2 = (batch.column(i).to_pylist() for i in range(2, 8))
            ok = []
            for i in range(batch.num_rows):
                one, two = home[i], home2[i]
                if len(one) != len(two):  # of the next band: as a guest of the smaller set's
                    one, two = (guest[i], two) if n[i] > m[i] else (one, guest2[i])
                ok.append(_bits_apart(one, two) * (100 + percent) <= (n[i] + m[i]) * (100 - percent))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], names=["cls", "other"])
    return run


def _possible(percent: int, table: pa.Table) -> pa.Table:
    """Of one node (``node, cls, root, n, sketch``) the classes that may have a link to another component's."""
    n, root = (table.column(c).to_numpy() for c in ("n", "root"))
    order = np.argsort(-n, kind="stable")
    bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), dtype="<u8").reshape(len(n), -1)[order]
    n, root = n[order], root[order]
    may = np.zeros(len(n), dtype=bool)
    for x in range(len(n) - 1):
        end = x + 1 + int(np.searchsorted(-n[x + 1:], -(-(-percent * n[x] // 100)), side="right"))
        apart = np.bitwise_count(bits[x + 1:end] ^ bits[x]).sum(axis=1, dtype=np.int64)
        near = (root[x + 1:end] != root[x]) & (apart * (100 + percent) <= (n[x] + n[x + 1:end]) * (100 - percent))
        may[x + 1:end] |= near
        may[x] |= near.any()
    return table.select(["node", "cls", "root"]).take(pa.array(order[may]))


def _linked_pairs(percent: int):
    def run(batches):
        for batch in batches:
            x, y = (batch.column(i).to_numpy() for i in range(2))
            one, two = (pa.chunked_array([batch.column(i)]) for i in (2, 3))
            ok = np.zeros(batch.num_rows, dtype=bool)
            for i, (s, t) in enumerate(zip(_unpacked(one), _unpacked(two), strict=True)):
                both = len(np.intersect1d(s, t, assume_unique=True))
                ok[i] = 100 * both >= percent * (len(s) + len(t) - both)
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]), pa.array(y[ok])], names=["a", "b"])
    return run


# ---- the join -------------------------------------------------------------------------------------------
def jaccard_join(docs: DataFrame, percent: int = 90, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 group_tokens: int = GROUP_TOKENS, allocate=allocation) -> DataFrame:
    """``(id, n_shingles, component_id, root)`` per row: the size of its set, the least id that links reach from it,
    itself included, and a number that tells components apart where ids are null or repeat (null for rows that
    have no words).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; rows are linked if ``100 * |intersection| >=
    percent * |union|`` of their sets of ``shingle``-word shingles (1 <= percent <= 99). A text of fewer words is
    one shingle; a null text, or one without words, has none and links with nothing: its component is its own id.
    Null ids are never the least. Repeated ids are rows of their own that share an id; repeated rows are one
    class. An empty table gives no row. Other columns are not read. A text is worked on whole, in memory of about
    60 bytes a word; no set, key or group is capped. No link is lost; sets are compared as 64-bit hashes of
    shingles.
    """
    if not 1 <= percent <= 99:
        raise ValueError("percent must be between 1 and 99")
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), doc_key(id_col, text_col).alias("key"),
                       F.col(text_col).alias("text"))

    def features(batches):
        for batch, x, y, sets, first in _sets(batches, 2, shingle):
            n = np.diff(first)
            limits = bands(percent, int(n.max(initial=0)))
            low, high = (np.array([b[i] for b in limits], dtype=np.int64) for i in (0, 1))
            own = [np.searchsorted(low, n, side="right") - 1 - down for down in (0, 1)]  # as home, as guest
            slots = [np.where(b >= 0, slots_of(np.append(high, [0, 0])[b]), 0) for b in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(x, y - x), batch.column(1).slice(x, y - x), pa.array(n.astype(np.int64)),
                 pa.array(class_ids(sets, first).view(np.int64), mask=n == 0),
                 *[pa.array(sketches(sets, first, s), pa.binary()) for s in slots]],
                names=["id", "key", "n", "cls", "home", "guest"])

    feats = cut(rows.mapInArrow(features, "id long, key long, n long, cls long, home binary, guest binary"), "set-sizes")
    classes = cut(feats.where("n > 0").groupBy("cls").agg(
        F.min("id").alias("id"), F.min("key").alias("key"),
        F.max(F.struct("n", "home", "guest")).alias("s")).select("cls", "id", "key", "s.*"), "set-classes")

    # sets per band: as many rows as there are bands, about 22 for each power of ten of the largest size
    largest = classes.agg(F.max("n")).first()[0] or 0
    all_bands = bands(percent, largest)
    floors = np.array([lo for lo, _, _ in all_bands], dtype=np.int64)
    if len(floors):
        counted = classes.where(F.col("n") >= int(floors[0])).groupBy(
            F.expr(f"size(filter(array({','.join(f'{x}L' for x in floors)}), x -> x <= n)) - 1").alias("band")).count()
        homes = {int(r["band"]): r["count"] for r in counted.collect()}
    else:
        homes = {}
    cuts = [allocate((lo + hi) // 2, h, homes.get(k, 0) + homes.get(k + 1, 0))
            for k, (lo, hi, h) in enumerate(all_bands)]
    for (_, _, h), (a, b) in zip(all_bands, cuts, strict=True):
        assert a + 2 * b > h
    plain = np.array([a for a, _ in cuts], dtype=np.int64)
    deleting = np.array([b for _, b in cuts], dtype=np.int64)

    def filed(batches):
        for batch, x, y, sets, first in _sets(batches, 0, shingle):
            n = np.diff(first)
            cls = class_ids(sets, first)
            for home in (True, False):
                band = np.searchsorted(floors, n, side="right") - (1 if home else 2)
                use = np.flatnonzero(band >= 0)
                if not len(use):
                    continue
                mine = np.concatenate([sets[first[i]:first[i + 1]] for i in use])
                own = np.concatenate(([0], np.cumsum(n[use])))
                key, owner = segment_keys(mine, own, band[use], plain[band[use]], deleting[band[use]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(cls[use][owner].view(np.int64)),
                     pa.array(np.full(len(key), home))], names=["sig", "cls", "home"])

    keys = cut(rows.select("text").mapInArrow(filed, "sig long, cls long, home boolean"), "set-keys")
    shared = cut(keys.groupBy("sig").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"),
                                         F.min(F.when(F.col("home"), F.col("cls"))).alias("pivot"))
                 .where("lo <> hi and pivot is not null").select("sig", "pivot"), "shared-keys")
    members = cut(among(keys, shared, key="sig").join(shared, "sig").select("sig", "cls", "home", "pivot").distinct(),
                  "set-members")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """``(cls, tokens)`` of the classes in ``wanted``, each from one row's text; written out."""
        asked = cut(wanted.join(classes.select("cls", "key"), "cls").select("cls", "key"), "sets-asked")
        texts = among(rows.select("key", "text"), asked).join(asked, "key").groupBy("key").agg(
            F.first("cls").alias("cls"), F.first("text").alias("text"))

        def run(batches):
            for batch, x, y, sets, first in _sets(batches, 1, shingle):
                own = [sets[first[i]:first[i + 1]].astype("<u8").tobytes() for i in range(y - x)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(x, y - x), pa.array(own, pa.binary())],
                                                 names=["cls", "tokens"])
        return cut(texts.select("cls", "text").mapInArrow(run, "cls long, tokens binary"), "sets")

    # every member with its key's pivot
    known = classes.select("cls", "n", "home", "guest")
    asked = members.where("cls <> pivot").select(F.greatest("cls", "pivot").alias("cls"), F.least("cls", "pivot").alias("other")).distinct()
    others = known.select(F.col("cls").alias("other"), F.col("n").alias("m"), F.col("home").alias("home2"), F.col("guest").alias("guest2"))
    pairs = cut(asked.join(known, "cls").join(others, "other").where(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
                .select("cls", "other", "n", "home", "guest", "m", "home2", "guest2")
                .mapInArrow(_possible_pairs(percent), "cls long, other long"), "pivot-pairs")
    sets = sets_of(pairs.select("cls").union(pairs.select("other")).distinct())
    stars = cut(pairs.join(sets, "cls").join(sets.select(F.col("cls").alias("other"), F.col("tokens").alias("others")), "other")
                .select("cls", "other", "tokens", "others").mapInArrow(_linked_pairs(percent), "a long, b long"), "pivot-links")
    edges = stars.unionByName(_across(members, stars, known, sets_of, percent, group_tokens))

    roots = components(edges)
    own = classes.select("cls", "id").join(roots.withColumnRenamed("node", "cls"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    least = cut(own.groupBy("root").agg(F.min("id").alias("component")), "least-ids")
    named = cut(own.join(least, "root").select("cls", "component", "root"), "set-components")
    out = feats.join(named, "cls", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"), "root")


def _across(members: DataFrame, stars: DataFrame, known: DataFrame, sets_of, percent: int, group_tokens: int) -> DataFrame:
    """Links between members of a key that the pivots' links leave in different components."""
    roots = components(stars)
    # members are written, so that a hot root or class is split; a key whose members are connected is done
    sketch = F.when(F.col("as_home"), F.col("home")).otherwise(F.col("guest"))
    placed = cut(members.select("sig", "cls", F.col("home").alias("as_home"))
                 .join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
                 .withColumn("root", F.coalesce("root", "cls")).join(known, "cls")
                 .select("sig", "cls", "root", "n", "as_home"), "set-placed")
    once = _once(placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), *_members()).where("lo <> hi"), "sig")
    open_ = cut(placed.join(once, "sig").join(known.select("cls", "home", "guest"), "cls")
                .select("sig", "cls", "root", "n", "tokens", sketch.alias("sketch")), "open-keys")
    small = open_.where(F.col("tokens") <= group_tokens).select(F.col("sig").alias("node"), "cls", "root", "n", "sketch")
    large = open_.where(F.col("tokens") > group_tokens)
    share = large.groupBy("sig", "root").agg(F.sum("n").alias("t"))
    main = cut(share.groupBy("sig").agg(F.max_by("root", F.struct("t", "root")).alias("main"), F.max("t").alias("most")), "main-roots")
    of = large.join(main, "sig").withColumn("few", F.col("tokens") - F.col("most"))
    half = max(1, group_tokens // 2)

    def number(tokens):
        return F.ceil(tokens / half).cast("int")

    def tile(salt: str, tokens):
        return F.pmod(F.xxhash64("cls", F.lit(salt)), number(tokens)).cast("int")

    outside = of.where("root <> main").select("sig", "cls", "root", "n", "sketch", tile("few", F.col("few")).alias("x"),
                                              F.explode(F.sequence(F.lit(0), number(F.col("tokens")) - 1)).alias("y"))
    inside = of.select("sig", "cls", "root", "n", "sketch", F.explode(F.sequence(F.lit(0), number(F.col("few")) - 1)).alias("x"),
                       tile("all", F.col("tokens")).alias("y"))
    tiles = outside.unionByName(inside).select(F.xxhash64("sig", "x", "y").alias("node"), "cls", "root", "n", "sketch") \
        .dropDuplicates(["node", "cls"])
    may = cut(small.unionByName(tiles).groupBy("node").applyInArrow(
        lambda t: _possible(percent, t), "node long, cls long, root long"), "set-nodes")
    only = _once(may.withColumn("n", F.lit(0)).groupBy("node").agg(*_members()), "node")
    nodes = cut(may.join(only.select("node"), "node", "left_semi"), "set-nodes-once")
    sets = sets_of(nodes.select("cls").distinct())
    return cut(nodes.join(sets, "cls").groupBy("node").applyInArrow(lambda t: _compare(percent, t), "a long, b long"),
               "group-links")


def _members() -> list:
    """What tells groups of classes apart, and their tokens in all."""
    return [F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("sum"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens")]


def _once(groups: DataFrame, name: str) -> DataFrame:
    """``(name, tokens)``: of groups with the same members one."""
    return groups.groupBy("sum", "size").agg(F.min(name).alias(name), F.first("tokens").alias("tokens")).select(name, "tokens")
