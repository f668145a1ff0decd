"""What the corpus operators share: tables, scratch output, row keys and word tokenization in batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_package

#: bytes of one Arrow batch handed to Python: texts differ in length by four orders of magnitude, so
#: a row count alone does not bound a worker's memory
ARROW_BATCH_BYTES = 8 << 20

#: bytes that separate words (tab, line feed, vertical tab, form feed, carriage return, space)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and bound Arrow batches by bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from the written table: whatever
    reads it later, and however often, the work before it is not repeated after a lost executor."""
    return materialize(df, f"llm-{name}")


def doc_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row from its id and text. Repeated rows share it (and so their result); rows
    that share only the id, or have none, keep results of their own."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def among(rows: DataFrame, keys: DataFrame, key: str = "key", bits: int = 26) -> DataFrame:
    """Rows whose ``key`` (a 64-bit hash) may be among ``keys``: all that are, and few others, so that a join
    with the keys need not shuffle the rest. Told by a bit map of the keys, which is broadcast: at most
    ``2 ** bits`` bits (8 MB), whatever the number of keys; with very many it only lets more rows pass."""
    spot = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    marks = keys.select(spot.alias("_s")).groupBy(F.shiftright("_s", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_s & 63 as int))")).alias("_bits"))
    return (rows.join(F.broadcast(marks), F.shiftright(spot, 6) == F.col("_word"))
            .where(F.getbit("_bits", spot.bitwiseAND(F.lit(63)).cast("int")) == 1).drop("_word", "_bits"))


def not_among(rows: DataFrame, keys: DataFrame, key: str = "key", bits: int = 26) -> DataFrame:
    """The rows that :func:`among` leaves out: their ``key`` is for certain not among ``keys``."""
    spot = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    marks = keys.select(spot.alias("_s")).groupBy(F.shiftright("_s", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_s & 63 as int))")).alias("_bits"))
    return (rows.join(F.broadcast(marks), F.shiftright(spot, 6) == F.col("_word"), "left")
            .where(F.getbit(F.coalesce("_bits", F.lit(0)), spot.bitwiseAND(F.lit(63)).cast("int")) == 0).drop("_word", "_bits"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (xor-shift-multiply) over a uint64 array."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of several texts, as byte ranges of one buffer.

    ``start``/``end``: byte range of each word in ``data``; ``first[i]:first[i + 1]``: the words of
    text ``i``. A null text has none.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(raw) + b"\n"  # a separator, so that no word spans two texts
        a = np.frombuffer(self.data, dtype=np.uint8)
        self.bytes = _LOWER[a] if lower else a
        space = _SPACE[a]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(a) and not space[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        self.bounds = bounds  # text i is data[bounds[i]:bounds[i + 1] - 1]
        self.first = np.searchsorted(self.start, bounds)

    def hashes(self) -> np.ndarray:
        """One well-mixed 64-bit hash per word."""
        return range_hashes(self.bytes, self.start, self.end)


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range of ``data``, taking 8 bytes of every range at a time."""
    n = len(start)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    at8 = np.lib.stride_tricks.sliding_window_view(padded, 8)
    size = (end - start).astype(np.int64)
    out = mix64(size.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    todo, done = np.arange(n), 0
    while len(todo):
        # the next (up to) 8 bytes of each unfinished range as one integer
        block = np.ascontiguousarray(at8[start[todo] + done]).view("<u8").ravel()
        left = np.minimum(size[todo] - done, 8).astype(np.uint64)
        block = np.where(left > 0, block & (~_U(0) >> ((_U(64) - left * _U(8)) & _U(63))), _U(0))
        out[todo] = mix64(out[todo] ^ block)
        done += 8
        todo = todo[size[todo] > done]
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words: entry ``i`` covers ``words[i:i + n]``."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = words[:m].copy()
        for k in range(1, n):
            out = out * _U(0x9E3779B97F4A7C15) + words[k:k + m]
    return mix64(out)


def byte_groups(texts: list[str | None], size: int) -> list[tuple[int, int]]:
    """Cut a list of texts into runs ``[a, b)`` of about ``size`` characters (a longer text is alone)."""
    out, a, total = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if total and total + n > size:
            out.append((a, i))
            a, total = i, 0
        total += n
    if a < len(texts):
        out.append((a, len(texts)))
    return out


# ---- words of letters and digits, as DataFrame expressions ---------------------------------------------
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: what lies between words once A-Z is in lower case: ASCII other than a-z and 0-9
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is (``lower`` alone would change other letters too)."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, UPPER.lower()))


def ascii_words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text in lower case; none of a null text."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), GAP), lambda w: w != "")
