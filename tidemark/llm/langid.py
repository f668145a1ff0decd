"""Language identification as inference of a mixture of languages.

Each language has a distribution over letter trigrams (hashed into a fixed number of buckets), counted
over all training rows. A document is a mixture: expectation-maximisation over its words estimates the
languages' proportions from the words' trigram likelihoods. The set of languages begins with the likeliest
one; the others join it in the order of their proportions for as long as the likelihood less a penalty per
further language rises.

How well the chosen mixture explains a text is held against noise, letters whose trigrams are all equally
likely: the difference of the log likelihoods is the text's evidence for being in any learned language.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import byte_groups, prepare

BUCKETS = 1 << 16
SMOOTHING = 0.1
GROUP_CHARS = 1 << 20  # characters of text worked on at a time
STEPS = 8  # EM steps over all languages
SET_STEPS = 4  # EM steps for a chosen set of languages
PENALTY = 5.0  # times log(words), for every language after the first
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case form of every code point that is a letter, 0 for the others."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


class Trigrams:
    """Trigram buckets of the letters of several texts: the trigram around each letter, with anything
    that is no letter as one boundary sign. ``bucket`` has an entry per letter; words are runs of letters:
    word ``w`` has the letters from ``word[w]`` on, text ``i`` the words ``first[i]:first[i + 1]``."""

    def __init__(self, texts: list[str | None]):
        points = np.frombuffer(("\n" + "\n".join(t or "" for t in texts) + "\n").encode("utf-32-le", "surrogatepass"),
                               dtype="<u4")
        c = _letters()[points]
        at = np.flatnonzero(c)
        with np.errstate(over="ignore"):
            h = (c[at - 1] * np.uint32(0x9E3779B1) + c[at]) * np.uint32(0x85EBCA77) + c[at + 1]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE3D)
        self.bucket = (h >> np.uint32(16)).astype(np.int32)
        self.word = np.flatnonzero(c[at - 1] == 0)
        lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), dtype=np.int64, count=len(texts))
        bounds = 1 + np.concatenate(([0], np.cumsum(lengths)))
        self.first = np.searchsorted(at[self.word], bounds)
        self.letter = np.searchsorted(at, bounds)  # letters before each text


def count_trigrams(rows: DataFrame) -> DataFrame:
    """``(lang, bucket, n)`` over all of ``rows`` (``lang, text``); counts leave a task summed up."""

    def run(batches):
        sums: dict[str, np.ndarray] = {}

        def emit():
            for lang, n in sums.items():
                b = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(b), pa.string()), pa.array(b.astype(np.int32)),
                                                  pa.array(n[b])], names=["lang", "bucket", "n"])
            sums.clear()

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in byte_groups(texts, GROUP_CHARS):
                t = Trigrams(texts[a:b])
                own = np.repeat(np.arange(b - a), np.diff(t.letter))
                for lang in set(langs[a:b]):
                    mine = np.array([x == lang for x in langs[a:b]])
                    n = np.bincount(t.bucket[mine[own]], minlength=BUCKETS)
                    sums[lang] = sums[lang] + n if lang in sums else n
                if len(sums) > 64:
                    yield from emit()
        yield from emit()

    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their log probabilities, ``BUCKETS`` rows by languages, from all rows with
    a text and a language for which ``training`` holds. 256 KB a language reach the driver, whatever the
    size of the corpus."""
    prepare(docs.sparkSession)
    rows = docs.where(training & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counted = count_trigrams(rows).toPandas()
    langs = sorted(counted["lang"].unique())
    n = np.full((BUCKETS, len(langs)), SMOOTHING)
    np.add.at(n, (counted["bucket"].to_numpy(dtype=np.int64), np.searchsorted(langs, counted["lang"])),
              counted["n"].to_numpy(dtype=np.float64))
    return list(langs), np.log(n / n.sum(axis=0)).astype(np.float32) if langs else n.astype(np.float32)


def _em(like: np.ndarray, text: np.ndarray, starts: np.ndarray, share: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` EM steps from the shares ``share`` (texts by languages); ``like``: words by languages."""
    n = np.diff(np.append(starts, len(like)))[:, None]
    for _ in range(steps):
        part = like * share[text]
        part /= part.sum(axis=1, keepdims=True)
        share = np.add.reduceat(part, starts) / n
    return share


def _value(like, text, starts, share) -> np.ndarray:
    return np.add.reduceat(np.log((like * share[text]).sum(axis=1) + 1e-300), starts)


def infer(texts: list[str | None], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shares of the languages in each text (all 0 if it has no letter), whether it has one, and its evidence:
    log likelihood of the mixture less that of noise (0 without a letter)."""
    k = logs.shape[1]
    t = Trigrams(texts)
    out, evidence = np.zeros((len(texts), k)), np.zeros(len(texts))
    known = np.diff(t.first) > 0
    if not known.any() or not k:
        return out, known, evidence
    words = np.add.reduceat(logs[t.bucket], t.word)
    most = words.max(axis=1, keepdims=True)
    like = np.exp(np.maximum(words - most, -60)).astype(np.float64)
    starts = t.first[:-1][known]
    n = np.diff(t.first)[known]
    text = np.repeat(np.arange(len(starts)), n)
    share = _em(like, text, starts, np.full((len(starts), k), 1 / k), STEPS)

    # one language needs no EM; then sets of 2, 3, ... of those of the largest shares, while that is better
    single = np.add.reduceat(np.log(like), starts)
    result = np.zeros_like(share)
    result[np.arange(len(starts)), single.argmax(axis=1)] = 1
    value = single.max(axis=1)
    reached = value.copy()  # without the penalty
    rank = np.argsort(-share, axis=1, kind="stable")
    more = np.arange(len(starts))
    for size in range(2, k + 1):
        pick = np.isin(text, more)
        mask = np.zeros((len(more), k))
        np.put_along_axis(mask, rank[more, :size], 1, axis=1)
        part = (share[more] + 1e-9) * mask
        part /= part.sum(axis=1, keepdims=True)
        sub = np.repeat(np.arange(len(more)), n[more])
        sub_starts = np.concatenate(([0], np.cumsum(n[more])))[:-1]
        part = _em(like[pick], sub, sub_starts, part, SET_STEPS)
        bare = _value(like[pick], sub, sub_starts, part)
        score = bare - PENALTY * (size - 1) * np.log(n[more] + 1)
        better = score > value[more]
        more = more[better]
        if not len(more):
            break
        value[more], reached[more], result[more] = score[better], bare[better], part[better]
    letters = np.diff(t.letter)[known]
    evidence[known] = reached + np.add.reduceat(most[:, 0].astype(np.float64), starts) + letters * np.log(BUCKETS)
    out[known] = result
    return out, known, evidence


def identify(docs: DataFrame, langs: list[str], logs: np.ndarray, id_col: str = "doc_id",
             text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``(id, lang_pred, score, languages, evidence)`` and the columns ``keep``: the language of the largest share, that
    share, all languages of the chosen set with their shares, largest first, and the evidence against noise.

    A null text, one without a letter, or no learned language at all: ``und``, score 0, no languages, evidence 0.
    Equal shares: the first language in order. Null or repeated ids get a row each; an empty table gives
    none. Only the text is looked at. No shuffle. A text is worked on whole: about 40 bytes a letter and 24 a word
    and language.
    """
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast((langs, logs))

    def run(batches):
        langs, logs = model.value
        pairs = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            pred, score, sets, evidence = [], [], [], []
            for a, b in byte_groups(texts, GROUP_CHARS):
                shares, known, told = infer(texts[a:b], logs)
                evidence += told.tolist()
                for row, has in zip(shares, known, strict=True):
                    if not has or not langs:
                        pred.append(UNKNOWN)
                        score.append(0.0)
                        sets.append([])
                        continue
                    order = [i for i in np.argsort(-row, kind="stable").tolist() if row[i] > 0]
                    pred.append(langs[order[0]])
                    score.append(float(min(1.0, row[order[0]])))
                    sets.append([{"lang": langs[i], "share": float(row[i])} for i in order])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pairs),
                 pa.array(evidence, pa.float64()), *[batch.column(2 + i) for i in range(len(more))]],
                names=["id", "lang_pred", "score", "languages", "evidence", *[f"_keep{i}" for i in range(len(more))]])

    more = [c for c in keep if c != id_col]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(more)])
    out = rows.mapInArrow(run, f"id {kinds[id_col]}, lang_pred string, score double, "
                               "languages array<struct<lang:string,share:double>>, evidence double"
                               + "".join(f", _keep{i} {kinds[c]}" for i, c in enumerate(more)))
    return out.select(F.col("id").alias(id_col), "lang_pred", "score", "languages", "evidence",
                      *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(more)])


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Rows kept out of the training: by CRC-32 of the id as text (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))
