import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import documents, empty
from tidemark.llm.langid import Trigrams, fit, held_out, identify, infer

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return fit(docs, ~held_out())


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = identify(docs, *model).withColumn("held_out", held_out()).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r.held_out]
    assert len(test) > 2000
    assert sum(r.lang_pred == r.lang for r in test) / len(test) > 0.995
    assert all(0 <= r.score <= 1 and abs(sum(x.share for x in r.languages) - 1) < 1e-6 for r in got if r.languages)


def test_mixtures_are_told_apart(spark, model):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars between 3000 and 5000")
            .groupBy("lang").agg(F.min("text").alias("text")).collect()}
    langs = sorted(docs)
    for a, b in zip(langs, langs[1:]):
        text = docs[a][:3000] + " " + docs[b][:1500]
        share, _, _ = infer([text, docs[a]], model[1])
        found = {model[0][i]: s for i, s in enumerate(share[0]) if s > 0}
        assert set(found) == {a, b} and abs(found[a] - 2 / 3) < 0.1  # shares of words, not of letters
        assert (share[1] > 0).sum() == 1


def test_edges(spark, model):
    docs = documents(spark)
    rows = identify(docs, *model).collect()
    assert len(rows) == docs.count()
    no_letter = {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == no_letter
    assert all(r.score == 0 and not r.languages for r in rows if r.lang_pred == "und")
    assert identify(empty(spark), *model).count() == 0
    langs, logs = fit(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert langs == [] and {r.lang_pred for r in identify(docs, langs, logs).collect()} == {"und"}


def test_only_marked_rows_teach(spark):
    rows = [(0, "aaa aaa", "x"), (1, "bbb bbb", "y"), (2, "ccc ccc", None), (3, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert fit(docs, F.col("doc_id") != 1)[0] == ["x"]


def test_trigrams_are_counted_per_text():
    texts = ["Ab, cd", None, "", "é", "12 !", "x"]
    t = Trigrams(texts)
    assert np.diff(t.letter).tolist() == [4, 0, 0, 1, 0, 1]
    assert np.diff(t.first).tolist() == [2, 0, 0, 1, 0, 1]
    assert t.bucket[:2].tolist() == Trigrams(["aB"]).bucket.tolist()


def _plain(text, langs, logs):
    """Plain Python twin: (language of the largest share, shares, evidence) of a text."""
    import math

    words, now = [], []
    padded = "\n" + text + "\n"
    for i in range(1, len(padded) - 1):
        if not padded[i].isalpha():
            continue
        if not padded[i - 1].isalpha():
            now = []
            words.append(now)
        now.append(Trigrams([padded[i - 1:i + 2]]).bucket[1 if padded[i - 1].isalpha() else 0])
    if not words:
        return "und", {}, 0.0
    rows = [[sum(float(logs[b, j]) for b in w) for j in range(len(langs))] for w in words]
    like = [[math.exp(max(x - max(r), -60)) for x in r] for r in rows]

    def em(share, steps):
        for _ in range(steps):
            total = [0.0] * len(langs)
            for r in like:
                part = [x * s for x, s in zip(r, share)]
                for j, x in enumerate(part):
                    total[j] += x / sum(part)
            share = [x / len(like) for x in total]
        return share

    def value(share):
        return sum(math.log(sum(x * s for x, s in zip(r, share)) + 1e-300) for r in like)

    share = em([1 / len(langs)] * len(langs), 8)
    single = [sum(math.log(r[j]) for r in like) for j in range(len(langs))]
    j = single.index(max(single))
    best, chosen, bare = single[j], [float(i == j) for i in range(len(langs))], single[j]
    rank = sorted(range(len(langs)), key=lambda i: -share[i])
    for size in range(2, len(langs) + 1):
        part = [(share[i] + 1e-9) if i in rank[:size] else 0.0 for i in range(len(langs))]
        part = em([x / sum(part) for x in part], 4)
        score = value(part) - 5 * (size - 1) * math.log(len(like) + 1)
        if score <= best:
            break
        best, chosen, bare = score, part, value(part)
    evidence = bare + sum(max(r) for r in rows) + sum(map(len, words)) * math.log(1 << 16)
    shares = {langs[i]: s for i, s in enumerate(chosen) if s > 0}
    return max(sorted(shares), key=shares.get), shares, evidence


def _languages(spark, n=6):
    """A small model of ``n`` invented languages, each with an alphabet of its own and some shared letters."""
    import random

    rnd = random.Random(4)
    alphabets = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "zéüßñ"][:n]
    texts = {f"l{i}": " ".join("".join(rnd.choice(a + "aeiou") for _ in range(rnd.randint(3, 8))) for _ in range(400))
             for i, a in enumerate(alphabets)}
    docs = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(texts.items())], "doc_id long, text string, lang string")
    return texts, fit(docs, F.lit(True))


def test_matches_plain_python_and_finds_five_languages(spark):
    texts, (langs, logs) = _languages(spark)
    w = {k: t.split() for k, t in texts.items()}
    five = " ".join(" ".join(w[f"l{i}"][:60]) for i in range(5))
    little = " ".join(w["l0"]) + " " + " ".join(w["l1"][:6])  # under two percent of the words
    tried = [five, little, texts["l2"], " ".join(w["l3"][:3]), "aeiou", "Hello, World!", "qqqq zzzz", "a", "12", "",
             " ".join(w["l0"][:30] + w["l4"][:20] + w["l5"][:10])]
    docs = spark.createDataFrame(list(enumerate(tried)), "doc_id long, text string")
    got = {r.doc_id: r for r in identify(docs, langs, logs).collect()}
    for i, text in enumerate(tried):
        pred, shares, evidence = _plain(text, langs, logs)
        assert got[i].lang_pred == pred and abs(got[i].evidence - evidence) < 1e-2 * max(1, abs(evidence))
        assert {x.lang for x in got[i].languages} == set(shares)
        assert all(abs(x.share - shares[x.lang]) < 1e-3 for x in got[i].languages)
    assert {x.lang for x in got[0].languages} == {f"l{i}" for i in range(5)} and got[0].score < 0.3
    assert {x.lang for x in got[1].languages} == {"l0", "l1"}


def test_evidence_tells_text_from_noise(spark):
    import random

    rnd = random.Random(1)
    texts, (langs, logs) = _languages(spark)
    noise = " ".join("".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(6)) for _ in range(50))
    _, _, evidence = infer([texts["l1"][:500], noise, None], logs)
    assert evidence[0] > 500 and evidence[1] < -10 and evidence[2] == 0
