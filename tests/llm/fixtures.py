"""Small hand-made tables and plain Python twins of the operators."""

import random
import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rnd, n, words=WORDS):
    return " ".join(rnd.choice(words) + (rnd.choice(["", "", ".", ","])) for _ in range(n))


def documents(spark, seed=1, n=60):
    """Rows ``(doc_id, text, id, key, h, n)`` with clashing extra columns: copies, near copies, shared
    passages, null and empty texts, a long text, repeated rows, a null id."""
    rnd = random.Random(seed)
    vocabulary = [a + b for a in WORDS for b in WORDS]
    texts = [prose(rnd, rnd.randint(1, 120), vocabulary) for _ in range(n)]
    passage = prose(rnd, 60, vocabulary)
    for i in range(0, n, 7):
        at = rnd.randint(0, len(texts[i]))
        texts[i] = texts[i][:at] + " " + passage + " " + texts[i][at:]
    for i in range(3, n, 9):
        texts[i] = texts[1]
    for i in range(5, n, 11):
        w = (texts[2] + " " + passage).split()
        w[rnd.randrange(len(w))] = "changed"
        texts[i] = " ".join(w)
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n "), (n + 3, "one"), (n + 4, "ONE two Three"), (n + 5, "...!!!"),
             (n + 6, prose(rnd, 6000)), (n + 7, "word " * 300), (None, texts[1]), (None, "nobody else has this text"),
             (0, texts[0]), (n + 8, "É é ß ñ 中文 words with other space  and   runs"),
             (n + 9, "UPPER lower É <|endoftext|> don't we'll x's!")]
    return spark.createDataFrame([(i, t, "x", -1, "y", 2.0) for i, t in rows],
                                 "doc_id long, text string, id string, key long, h string, n double")


def empty(spark):
    return documents(spark).where("false")


def words(text, lower=False):
    """``[^\\x20\\x09-\\x0D]+`` words; A-Z in lower case if asked."""
    t = text or ""
    if lower:
        t = re.sub("[A-Z]+", lambda m: m[0].lower(), t)
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def plain_words(text):
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words of a text with A-Z in lower case."""
    t = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
