"""Repeated passages: seed and extend over winnowed anchors.

A window is ``window`` consecutive words of one document; a word goes if it lies in a window whose word
sequence starts somewhere else as well. Every window selects one anchor, the run of ``anchor`` words of
the least hash in it, so equal windows have equal anchors at equal places (the seeds). An anchor's
*reach* is the stretch of words that the windows selecting it cover, before and after it.

Seeds that occur once are dropped. Occurrences with equal reach agree all the way in both directions:
they are one class, and if it has two members all their windows repeat. Where classes of one anchor
differ in reach, one member of each is extended word by word in both directions: the windows of its
reach are compared by hash with those of the other classes. Neighbouring repeated windows join into
maximal repeats.

No pairs of occurrences are formed: a passage that is in a third of all documents is one class inside,
and as many classes as there are different surroundings at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, among, byte_groups, cut, doc_key, gram_hashes, mix64, prepare

WINDOW = 35
ANCHOR = 8  # WINDOW - ANCHOR + 1 places are told apart in a 64-bit mask
GROUP_CHARS = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))


class StretchHashes:
    """Hashes of stretches ``words[a:b]``, each in constant time: a polynomial by prefix sums mod 2**64."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate(([_U(1)], np.full(max(0, n - 1), _BASE))), dtype=np.uint64)[:n]
            self.back = np.cumprod(np.concatenate(([_U(1)], np.full(n, _BASE_INVERSE))), dtype=np.uint64)
            self.sum = np.concatenate(([_U(0)], np.cumsum(words * power, dtype=np.uint64)))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sum[b] - self.sum[a]) * self.back[a] + (b - a).astype(np.uint64))


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` values the place of its least (the first of equal ones)."""
    place, have = np.arange(len(values)), 1
    while have < span:
        step = min(have, span - have)  # runs of have + step from two that may overlap
        left, right = place[:len(place) - step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        have += step
    return place


def _anchors(texts: list[str | None], window: int, anchor: int):
    """Arrays ``text, place, first, last, h, u``: each selected anchor with the windows that select it and
    the hashes of its words and of its reach (places count from the start of its text)."""
    w = Words(texts)
    hashes = w.hashes()
    n = np.diff(w.first)
    empty = [np.zeros(0, dtype=np.int64)] * 4 + [np.zeros(0, dtype=np.uint64)] * 2
    if len(hashes) < window:
        return empty
    grams = gram_hashes(hashes, anchor)
    place = least_places(grams, window - anchor + 1)
    text = np.repeat(np.arange(len(texts)), n)
    start = np.flatnonzero(text[:len(hashes) - window + 1] == text[window - 1:])  # windows inside one text
    if not len(start):
        return empty
    at, own = place[start], text[start]
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (own[1:] != own[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(start)])) - 1
    at, own, first, last = at[first], own[first], start[first], start[last]
    with np.errstate(over="ignore"):
        reach = StretchHashes(hashes).of(first, last + window)
        reach = mix64(reach + (at - first).astype(np.uint64) * _BASE)
    zero = w.first[own]
    return [own, at - zero, first - zero, last - zero, grams[at], reach]


def find_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(key, runs)``: for each document with repeated windows (by :func:`tidemark.llm.common.doc_key`) the
    runs ``first, last, mask``: bit ``i`` of the mask tells whether the window at ``first + i`` repeats."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(doc_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))

    def seeds(batches):
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for a, b in byte_groups(texts, GROUP_CHARS):
                own, place, first, last, h, u = _anchors(texts[a:b], window, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b][own]), *[pa.array(x.astype(np.int32)) for x in (place, first, last)],
                     pa.array(h.view(np.int64)), pa.array(u.view(np.int64))],
                    names=["key", "place", "first", "last", "h", "u"])

    found = cut(rows.mapInArrow(seeds, "key long, place int, first int, last int, h long, u long"), "seeds")
    twice = cut(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "seeds-twice")
    found = cut(found.join(twice, "h", "left_semi"), "seeds-met")

    classes = cut(found.groupBy("h", "u").agg(F.count(F.lit(1)).alias("n"),
                                              F.min(F.struct("key", "place", "first", "last")).alias("one")), "reaches")
    several = cut(classes.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"), "reaches-differ")
    asked = (classes.join(several, "h", "left_semi").select("h", "u", "n", "one.*")
             .groupBy("key").agg(F.collect_list(F.struct("h", "u", "n", "first", "last")).alias("asked")))

    def extend(batches):
        for batch in batches:
            texts, asked = batch.column(0).to_pylist(), batch.column(1)
            offsets, flat = asked.offsets.to_numpy(), asked.flatten()
            h, u, n, first, last = (flat.field(i).to_numpy() for i in range(5))
            offsets = offsets - offsets[0]
            for a, b in byte_groups(texts, GROUP_CHARS):
                w = Words(texts[a:b])
                hashes = StretchHashes(w.hashes())
                sel = np.arange(offsets[a], offsets[b])
                zero = np.repeat(w.first[:-1], np.diff(offsets[a:b + 1]))
                count = (last[sel] - first[sel] + 1).astype(np.int64)
                which = np.repeat(sel, count)
                off = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(zero + first[sel], count) + off
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[which]), pa.array(hashes.of(start, start + window).view(np.int64)),
                     pa.array(u[which]), pa.array(n[which]), pa.array(off.astype(np.int32))],
                    names=["h", "wh", "u", "n", "off"])

    asked = cut(asked, "asked")
    texts = among(rows, asked).join(asked, "key").select("text", "asked")
    windows = cut(texts.mapInArrow(extend, "h long, wh long, u long, n long, off int"), "windows")
    repeated = cut(windows.groupBy("h", "wh").agg(F.sum("n").alias("s")).where("s > 1").select("h", "wh"),
                   "windows-twice")
    bit = F.expr("shiftleft(1L, off)")
    some = (windows.where("n = 1").join(repeated, ["h", "wh"]).groupBy("h", "u")
            .agg(F.bit_or(bit).alias("mask")))
    verdict = cut(classes.where("n > 1").select("h", "u", F.lit(-1).cast("long").alias("mask")).unionByName(some),
                  "verdicts")
    return cut(found.join(verdict, ["h", "u"]).groupBy("key").agg(
        F.collect_set(F.struct("first", "last", "mask")).alias("runs")), "repeats")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, id_col: str = "doc_id",
                   text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``(id, n_words, n_removed, kept, repeats)`` and the columns ``keep`` per row: the kept words joined by
    one blank, and the maximal repeats as ``(start, end)`` in words.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are judged on the input. Null and empty texts, and
    those of fewer than ``window`` words, keep what they have (null: no words, kept is empty). Repeated
    rows are each other's copies and lose all windows. Other columns are not read.
    """
    runs = find_repeats(docs, window, anchor, id_col, text_col)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rows = docs.select(doc_key(id_col, text_col).alias("_key"), F.col(id_col).alias("_id"),
                       F.col(text_col).alias("_text"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    rows = rows.join(runs.withColumnRenamed("key", "_key"), "_key", "left").drop("_key") \
        .select("_id", "_text", "runs", *[f"_keep{i}" for i in range(len(keep))])

    def run(batches):
        for batch in batches:
            ids, texts, runs = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            n_words, n_removed, kept, repeats = [], [], [], []
            for text, own in zip(texts, runs, strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                spans = []
                if own:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    for r in own:
                        for i in range(r["last"] - r["first"] + 1):
                            if r["mask"] >> i & 1:
                                gone[r["first"] + i] += 1
                                gone[r["first"] + i + window] -= 1
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(gone) > 0, [0]))))
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
                left, at = [], 0
                for s in spans:
                    left += words[at:s["start"]]
                    at = s["end"]
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode("utf-8", "surrogatepass"))
                repeats.append(spans)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(repeats, span), *[batch.column(3 + i) for i in range(len(keep))]],
                names=["id", "n_words", "n_removed", "kept", "repeats", *[f"_keep{i}" for i in range(len(keep))]])

    more = "".join(f", _keep{i} {kinds[c]}" for i, c in enumerate(keep))
    out = rows.mapInArrow(run, f"id {kinds[id_col]}, n_words long, n_removed long, kept string, "
                               f"repeats array<struct<start:int,end:int>>{more}")
    return out.select(F.col("id").alias(id_col), "n_words", "n_removed", "kept", "repeats",
                      *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)])
