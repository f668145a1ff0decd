"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

An item is a set of windows of consecutive words, a window a set of shingles of up to three words. As a
window must be contained whole, its rarest shingle alone is a sufficient prefix: a document that has the
window has that shingle, at the same distance from the window's start. So documents are joined on
shingles that are some window's prefix, the window must then fit into the document at that distance
(positional and length bounds), and its words are compared with the document's.

Which positions of a document can matter at all is told by a bit map of the prefixes, 128 KB whatever the
sizes of both tables; beyond it no text and no word is shuffled, only candidate positions with the words
around them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_words, cut, doc_key

WINDOW = 10  # words in a window
SHINGLE = 3  # words in a shingle, at most
#: a word before A-Z is put into lower case
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BITS = 20  # the bit map has 2 ** BITS bits


def _shingle(words: Column, i: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)])


def _range(n: Column) -> Column:
    """0, 1, ... n - 1; empty if ``n`` is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def prefixes(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(h, size, at, length, words, item)``: every window of every item under its rarest shingle ``h``
    (of ``size`` words), which lies ``at`` words after the window's start. Rarity is the number of items
    that have the shingle, ties by its hash."""
    rows = (items.select(F.col(id_col).alias("item"), ascii_words(F.col(text_col)).alias("w"),
                         doc_key(id_col, text_col).alias("key"))
            .where(F.size("w") > 0).dropDuplicates(["key"])
            .withColumn("length", F.least(F.size("w"), F.lit(window))))
    windows = cut(rows.withColumn("start", F.explode(_range(F.size("w") - F.col("length") + 1)))
                  .select("key", "item", "start", "length", F.slice("w", F.col("start") + 1, F.col("length")).alias("words"))
                  .withColumn("size", F.least(F.col("length"), F.lit(SHINGLE))), "windows")

    def shingles_of(s: int) -> Column:
        return F.transform(_range(F.col("length") - F.lit(s - 1)),
                           lambda i: F.struct(_shingle(F.col("words"), i, s).alias("h"), i.alias("at")))

    each = F.coalesce(*[F.when(F.col("size") == s, shingles_of(s)) for s in range(1, SHINGLE + 1)])
    shingles = windows.select("key", "start", F.explode(each).alias("s")).select("key", "start", "s.h", "s.at")
    rarity = shingles.groupBy("h").agg(F.countDistinct("key").alias("items"))
    least = shingles.join(rarity, "h").groupBy("key", "start").agg(
        F.min(F.struct("items", "h", "at")).alias("p")).select("key", "start", "p.h", "p.at")
    return cut(windows.join(least, ["key", "start"]).select("h", "size", "at", "length", "words", "item").distinct(),
               "prefixes")


def _bits(h: Column) -> list[Column]:
    """The two bits of a shingle in the bit map."""
    mask = F.lit((1 << BITS) - 1)
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


def bit_map(prefix: DataFrame) -> str:
    """The bit map of the prefixes as ``2 ** BITS / 64`` integers, comma-joined."""
    spots = prefix.select(F.explode(F.array(*_bits(F.col("h")))).alias("b"))
    found = spots.groupBy(F.shiftright("b", 6).alias("i")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("v")).collect()
    cells = ["0"] * (1 << (BITS - 6))
    for r in found:
        cells[r["i"]] = str(r["v"])
    return ",".join(cells)


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                 with_key: bool = False) -> DataFrame:
    """``(id, n_words, n_hit, n_items, items_sha256, contaminated, spans)`` per document (``with_key``: and
    its :func:`tidemark.llm.common.doc_key` as ``key``): the number of its
    words, of those inside any occurrence of an item's window, of items with occurring windows, the
    SHA-256 of these items' ids (sorted as strings, comma-joined), and the occurring windows as
    ``(start, length)``.

    A window has ``window`` words; an item of fewer words, but not none, is one window. Null texts have no
    words. Windows of an item with a null id are hits, but the item is not counted or listed. Items that
    share an id count once. Repeated documents get a row each. Without items or documents nothing is hit.
    Other columns are not read.
    """
    prefix = prefixes(items, window, item_id_col, item_text_col)
    sizes = sorted(r["size"] for r in prefix.select("size").distinct().collect())  # of 1 to SHINGLE
    cells = F.split(F.lit(bit_map(prefix)), ",").cast("array<bigint>")

    def candidates(size: int) -> Column:
        """Positions that may have a prefix of this size, with the words that a window there could cover."""
        def at(i):
            return F.get(F.col(f"h{size}"), i)

        def bit(b):
            return F.getbit(F.get(cells, F.shiftright(b, 6).cast("int")), b.bitwiseAND(F.lit(63)).cast("int")) == 1

        found = F.filter(_range(F.size(f"h{size}")), lambda i: bit(_bits(at(i))[0]) & bit(_bits(at(i))[1]))
        left = window - size
        return F.transform(found, lambda i: F.struct(
            at(i).alias("h"), i.alias("pos"), F.greatest(i - left, F.lit(0)).alias("from"),
            F.slice("w", F.greatest(i - left, F.lit(0)) + 1, F.lit(window + left)).alias("around")))

    words = docs.select(F.col(id_col).alias("id"), doc_key(id_col, text_col).alias("key"),
                        ascii_words(F.col(text_col)).alias("w"))

    def hashes(s: int) -> Column:
        return F.transform(_range(F.size("w") - F.lit(s - 1)), lambda i: _shingle(F.col("w"), i, s)).alias(f"h{s}")

    hashed = words.select("id", "key", "w", *[hashes(s) for s in sizes])
    none = F.array().cast("array<struct<h:bigint,pos:int,from:int,around:array<string>>>")
    seen = cut(hashed.select("id", "key", F.size("w").alias("n"),
                             reduce(F.concat, [candidates(s) for s in sizes], none).alias("c")), "candidates")

    spots = seen.where(F.size("c") > 0).select("key", "n", F.explode("c").alias("c")).select("key", "n", "c.*")
    start = F.col("pos") - F.col("at")
    hits = (spots.join(prefix, "h")
            .where((start >= 0) & (start + F.col("length") <= F.col("n")))
            .where(F.slice("around", start - F.col("from") + 1, F.col("length")) == F.col("words"))
            .select("key", start.alias("start"), "length", F.col("item").cast("string").alias("item"))
            .groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
                                F.array_sort(F.collect_set("item")).alias("items")))
    # words under the spans, which are sorted by start: each adds what lies beyond the end so far
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, s: F.struct(F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
                              (a["n"] + F.greatest(s["start"] + s["length"] - F.greatest(a["end"], s["start"]),
                                                   F.lit(0))).alias("n")), lambda a: a["n"])
    items_of = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("covered"), F.lit(0))
    return (seen.select("id", "key", "n").join(hits.withColumn("covered", covered), "key", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_words"),
                    n_hit.cast("long").alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", items_of), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
                    *[F.col("key")] * with_key))


def cut_spans(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the words in ``spans_col`` (sorted, as :func:`contaminated` gives them) cut out of
    ``text_col``: the kept runs of words as they are, with what lies between their words, joined by a blank.
    Where the spans are null the text stays as it is. Adds no column."""
    spans, text = F.col(spans_col), F.concat(F.lit("-"), F.col(text_col), F.lit("-"))
    cols = docs.columns
    # columns of their own: what a lambda refers to must not be computed anew for every element
    parts = docs.select(*cols, F.when(spans.isNotNull(), F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("_words"),
                        F.when(spans.isNotNull(), F.split(text, WORD)).alias("_gaps"))
    # neighbouring and overlapping spans become one cut
    cuts = F.aggregate(
        spans, F.array().cast("array<struct<a:int,b:int>>"),
        lambda out, s: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["b"] >= s["start"]),
            F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
                F.element_at(out, -1)["a"].alias("a"),
                F.greatest(F.element_at(out, -1)["b"], s["start"] + s["length"]).alias("b")))))
        .otherwise(F.concat(out, F.array(F.struct(s["start"].alias("a"), (s["start"] + s["length"]).alias("b"))))))
    bounds = parts.withColumn("_bounds", F.concat(
        F.array(F.lit(0)), F.flatten(F.transform(cuts, lambda s: F.array(s["a"], s["b"]))), F.array(F.size("_words"))))
    runs = F.filter(F.transform(
        F.sequence(F.lit(0), (F.size("_bounds") / 2).cast("int") - 1),
        lambda i: F.struct(F.get("_bounds", 2 * i).alias("a"), F.get("_bounds", 2 * i + 1).alias("b"))),
        lambda r: r["b"] > r["a"])
    kept = F.transform(runs, lambda r: F.array_join(F.transform(
        F.sequence(r["a"], r["b"] - 1),
        lambda i: F.concat(F.get("_words", i), F.when(
            (i < r["b"] - 1) & (i + 1 < F.size("_gaps")), F.get("_gaps", i + 1)).otherwise(F.lit("")))), ""))
    new = F.when(spans.isNull(), F.col(text_col)).otherwise(F.array_join(kept, " "))
    return bounds.select(*[new.alias(c) if c == text_col else F.col(c) for c in cols])
