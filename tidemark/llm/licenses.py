"""License scans by ordered signature rules, in DataFrame operations only.

A text is normalized to lower-case words with one blank between them. A cheap test tells the few texts
that speak of a license at all; in those, keywords tell which rules can match, and each such rule's
regular expression is run. Where detections overlap, one that lies inside another of the same or a
higher rank is dropped. The rules are a table of fixed size (a few hundred rows), made from the families
and templates below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import GAP, ascii_lower, cut, doc_key

#: phrases that are counted in every text: label by phrase
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: a text without any of these has no license rule to match: whatever a rule matches holds one of them
GATE = ("licen", "public domain", "spdx", "cc by", "cc0", "creative commons", "copyleft",
        "distributed under", "released under", "made available under", "published under",
        "permission is hereby granted", "redistribution and use", "permission to use copy")

# label, keyword (words that every match contains), names as a regular expression over normalized words
FAMILIES = [
    ("mit", "mit", "mit|mit x11|mit expat"),
    ("mit-0", "mit", "mit 0|mit no attribution"),
    ("apache-1", "apache", "apache(?: software)? 1(?: [01])?|apache license version 1(?: [01])?"),
    ("apache-2", "apache", "apache 2(?: 0)?|apache v2(?: 0)?|apache software 2(?: 0)?"),
    ("bsd-2", "bsd", "bsd 2 clause|2 clause bsd|simplified bsd|freebsd"),
    ("bsd-3", "bsd", "bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd"),
    ("bsd-4", "bsd", "bsd 4 clause|4 clause bsd|original bsd"),
    ("bsd-0", "bsd", "0bsd|zero clause bsd|bsd zero clause"),
    ("bsd", "bsd", "bsd|bsd style"),
    ("isc", "isc", "isc"),
    ("gpl-1", "gpl", "gpl (?:v|version )?1(?: 0)?(?: or later| only)?|gplv1"),
    ("gpl-2", "gpl", "gpl (?:v|version )?2(?: 0)?(?: or later| only)?|gplv2"),
    ("gpl-3", "gpl", "gpl (?:v|version )?3(?: 0)?(?: or later| only)?|gplv3"),
    ("lgpl-2", "lgpl", "lgpl (?:v|version )?2(?: [01])?(?: or later| only)?|lgplv2"),
    ("lgpl-3", "lgpl", "lgpl (?:v|version )?3(?: 0)?(?: or later| only)?|lgplv3"),
    ("agpl-3", "agpl", "agpl (?:v|version )?3(?: 0)?(?: or later| only)?|agplv3"),
    ("gpl", "gpl", "gpl|gnu gpl"),
    ("lgpl", "lgpl", "lgpl|gnu lgpl"),
    ("agpl", "agpl", "agpl|gnu agpl"),
    ("mpl-1", "mpl", "mpl (?:v|version )?1(?: [01])?"),
    ("mpl-2", "mpl", "mpl (?:v|version )?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public"),
    ("epl-1", "epl", "epl (?:v|version )?1(?: 0)?"),
    ("epl-2", "epl", "epl (?:v|version )?2(?: 0)?"),
    ("epl", "eclipse", "eclipse public"),
    ("cddl", "cddl", "cddl(?: 1 [01])?"),
    ("cpl", "cpl", "cpl(?: 1 0)?"),
    ("eupl", "eupl", "eupl(?: 1 [0-2])?"),
    ("osl", "osl", "osl(?: [1-3] [01])?"),
    ("afl", "afl", "afl(?: [1-3] [0-2])?"),
    ("artistic-1", "artistic", "artistic (?:license )?1(?: 0)?"),
    ("artistic-2", "artistic", "artistic (?:license )?2(?: 0)?"),
    ("artistic", "artistic", "artistic"),
    ("zlib", "zlib", "zlib|zlib libpng"),
    ("boost", "boost", "boost software"),
    ("bsl-1", "bsl", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("python-2", "python", "python software foundation|python 2(?: 0)?"),
    ("ruby", "ruby", "ruby"),
    ("php-3", "php", "php(?: 3(?: 0?[01])?)?"),
    ("openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql"),
    ("w3c", "w3c", "w3c software"),
    ("vim", "vim", "vim"),
    ("x11", "x11", "x11"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("odbl", "odbl", "odbl(?: 1 0)?"),
    ("ofl", "ofl", "ofl(?: 1 [01])?"),
    ("ofl", "open font", "sil open font"),
    ("elastic-2", "elastic", "elastic(?: 2 0)?"),
    ("sspl", "sspl", "sspl(?: 1 0)?"),
    ("busl", "busl", "busl(?: 1 1)?"),
]
# what is around a name; {} is the name, and the number is the rank: 1 says it outright, 3 only mentions it
TEMPLATES = [
    (1, "spdx license identifier (?:{})"),
    (1, "(?:is|are) (?:distributed|released|licensed|made available|published) under (?:the )?(?:terms of )?(?:the )?(?:{})(?: license)?"),
    (1, "(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:{})(?: license)?"),
    (2, "under (?:the )?(?:terms of )?(?:the )?(?:{}) licen[cs]e"),
    (3, "(?:{}) licen[cs]ed?"),
]
# label, keyword, rank, expression: rules that no template gives
SPECIAL = [
    ("gpl-1", "general public license", 1, "gnu general public license (?:as published by the free software foundation (?:either )?)?(?:version|v) ?1(?: 0)?"),
    ("gpl-2", "general public license", 1, "gnu general public license (?:as published by the free software foundation (?:either )?)?(?:version|v) ?2(?: 0)?"),
    ("gpl-3", "general public license", 1, "gnu general public license (?:as published by the free software foundation (?:either )?)?(?:version|v) ?3(?: 0)?"),
    ("gpl", "general public license", 3, "(?:gnu )?general public license"),
    ("lgpl-2", "lesser general public license", 1, "(?:gnu )?lesser general public license (?:version|v) ?2(?: [01])?"),
    ("lgpl-2", "library general public license", 1, "(?:gnu )?library general public license (?:version|v) ?2(?: [01])?"),
    ("lgpl-3", "lesser general public license", 1, "(?:gnu )?lesser general public license (?:version|v) ?3(?: 0)?"),
    ("lgpl", "lesser general public license", 2, "(?:gnu )?lesser general public license"),
    ("agpl-3", "affero", 1, "(?:gnu )?affero general public license(?: (?:version|v) ?3(?: 0)?)?"),
    ("apache-1", "apache", 1, "apache (?:software )?license (?:version |v)?1(?: [01])?"),
    ("apache-2", "apache", 1, "apache (?:software )?license (?:version |v)?2(?: 0)?"),
    ("mpl-1", "mozilla", 1, "mozilla public license (?:version |v)?1(?: [01])?"),
    ("mpl-2", "mozilla", 1, "mozilla public license (?:version |v)?2(?: 0)?"),
    ("epl-1", "eclipse", 1, "eclipse public license (?:version |v)?1(?: 0)?"),
    ("epl-2", "eclipse", 1, "eclipse public license (?:version |v)?2(?: 0)?"),
    ("cc0", "cc0", 1, "cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "creative commons", 1, "creative commons (?:cc0|zero)(?: 1 0)?"),
    ("cc-by", "cc by", 1, "cc by(?: [1-4] [05])?(?! n| s)"),
    ("cc-by-sa", "cc by", 1, "cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by", 1, "cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by", 1, "cc by nc(?: [1-4] [05])?(?! n| s)"),
    ("cc-by-nc-sa", "cc by", 1, "cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by", 1, "cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "creative commons", 1, "creative commons attribution(?: [1-4] [05])?(?: (?:international|unported|generic))?(?! n| s)"),
    ("cc-by-sa", "creative commons", 1, "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "creative commons", 1, "creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?"),
    ("cc-by-nc", "creative commons", 1, "creative commons attribution non ?commercial(?: [1-4] [05])?(?! n| s)"),
    ("cc-by-nc-sa", "creative commons", 1, "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative commons", 1, "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?"),
    ("creative-commons", "creative commons", 3, "creative commons licen[cs]e"),
    ("public-domain", "public domain", 2, "(?:in|into|to|is) the public domain"),
    ("public-domain", "public domain", 1, "dedicated to the public domain"),
    ("proprietary", "license", 2, "without a (?:prior |written )?license(?: agreement)?"),
    ("mit", "permission is hereby granted", 1, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use", 1, "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy", 1, "permission to use copy modify and or distribute this software for any purpose"),
    ("copyleft", "copyleft", 3, "copyleft licen[cs]e"),
]
SCORES = {1: 0.9, 2: 0.7, 3: 0.5}  # by rank, where no phrase is found


def rules() -> list[tuple[str, str, int, str]]:
    """``(label, keyword, rank, expression)`` of all rules, in order."""
    made = [(label, word, rank, t.format(names)) for label, word, names in FAMILIES for rank, t in TEMPLATES]
    return SPECIAL + made


def _whole(expression: str) -> str:
    """The expression at whole words of a text that has a blank before and after each word."""
    return f"(?<= )(?:{expression})(?= )"


def _words_in(piece: Column) -> Column:
    """Words of a piece of normalized text, which may begin and end with a blank."""
    t = F.trim(piece)
    return F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1)


def _phrase(text: Column, n_words: Column, phrase: str) -> Column:
    """``(n, first, last)`` of the places of a phrase; null where there is none."""
    parts = F.split(text, _whole(phrase))
    size = len(phrase.split())
    return F.when(F.contains(text, F.lit(f" {phrase} ")), F.struct(
        (F.size(parts) - 1).alias("n"), _words_in(F.get(parts, F.lit(0))).alias("first"),
        (n_words - _words_in(F.element_at(parts, -1)) - size).alias("last")))


def detections(texts: DataFrame) -> DataFrame:
    """``(key, found)`` for rows ``(key, t)`` of normalized texts: the detections that stay, as structs
    ``label, rank, start, end, rule`` (character places in the normalized text), by place."""
    spark: SparkSession = texts.sparkSession
    table = [(i, *r[:3], _whole(r[3])) for i, r in enumerate(rules())]
    rule = spark.createDataFrame(table, "rule int, label string, word string, rank int, expression string")
    words = sorted({r[1] for r in rules()})
    named = texts.select("key", "t", F.explode(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.col("t"), w))).alias("word"))
    # the rules are a few hundred rows, whatever the texts: a broadcast of known size
    tried = named.join(F.broadcast(rule), "word").where(F.rlike("t", F.col("expression")))
    found = (tried.select("key", "rule", "label", "rank", F.split("t", F.col("expression")).alias("gap"),
                          F.regexp_extract_all("t", F.col("expression"), F.lit(0)).alias("hit"))
             # places: each hit begins after the gaps and hits before it
             .select("key", F.aggregate(
                 F.zip_with(F.slice("gap", F.lit(1), F.size("hit")), "hit",
                            lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h"))),
                 F.struct(F.lit(0).alias("end"),
                          F.array().cast("array<struct<start:int,less:int,rank:int,rule:int,label:string>>").alias("out")),
                 lambda a, x: F.struct(
                     (a["end"] + x["g"] + x["h"]).alias("end"),
                     F.concat(a["out"], F.array(F.struct(
                         (a["end"] + x["g"]).alias("start"), (-(a["end"] + x["g"] + x["h"])).alias("less"),
                         F.col("rank"), F.col("rule"), F.col("label")))).alias("out")),
                 lambda a: a["out"]).alias("places"))
             .groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("places")))
    # by start, then the longer first: a detection is inside an earlier one if that ends no sooner. The
    # furthest end so far is kept for each rank; those of the same or a higher rank count
    ranks = sorted(SCORES)

    def step(a: Column, x: Column) -> Column:
        end = -x["less"]
        inside = F.lit(False)
        for r in ranks:
            inside = inside | ((x["rank"] >= r) & (a[f"end{r}"] >= end))
        return F.struct(
            *[F.when(x["rank"] == r, F.greatest(a[f"end{r}"], end)).otherwise(a[f"end{r}"]).alias(f"end{r}") for r in ranks],
            F.when(inside, a["out"]).otherwise(F.concat(a["out"], F.array(F.struct(
                x["label"].alias("label"), x["rank"].alias("rank"), x["start"].alias("start"), end.alias("end"),
                x["rule"].alias("rule"))))).alias("out"))

    start = F.struct(*[F.lit(-1).alias(f"end{r}") for r in ranks], F.array().cast(
        "array<struct<label:string,rank:int,start:int,end:int,rule:int>>").alias("out"))
    return found.select("key", F.aggregate("places", start, step, lambda a: a["out"]).alias("found"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, score, found)`` per row:
    the number of words, the places of the phrases with the first and last of their starts (words from 0),
    the phrases' labels, these and the rules' labels (distinct, sorted, comma-joined; empty if none), the
    certainty (1 with a phrase, else by the best rule's rank, 0 without any), and the rules' detections.

    A null text is empty. Null or repeated ids get a row each; an empty table gives none. Nothing is
    shuffled but the detections of texts that have any. Other columns are not read.
    """
    blanks = F.regexp_replace(F.coalesce(ascii_lower(F.col(text_col)), F.lit("")), GAP, " ")
    rows = docs.select(F.col(id_col).alias("id"), doc_key(id_col, text_col).alias("key"),
                       F.concat(F.lit(" "), F.trim(blanks), F.lit(" ")).alias("t"))
    n_words = F.col("n_words")
    gate = F.lit(False)
    for g in GATE:
        gate = gate | F.contains(F.col("t"), F.lit(g))
    counted = rows.select("id", "key", _words_in(F.col("t")).alias("n_words"), F.when(gate, F.col("t")).alias("t"))
    phrases = [_phrase(F.col("t"), n_words, p) for p in PHRASES]
    seen = cut(counted.select("id", "key", "n_words", "t", *[p.alias(f"p{i}") for i, p in enumerate(phrases)]),
               "license-texts")
    found = detections(seen.where(F.col("t").isNotNull()).select("key", "t").dropDuplicates(["key"]))

    own = [F.col(f"p{i}") for i in range(len(phrases))]
    empty = F.array().cast("array<string>")
    base = F.array_compact(F.array(*[F.when(p.isNotNull(), F.lit(label)) for p, label in zip(own, PHRASES.values(), strict=True)]))
    hits = F.coalesce("found", F.array().cast("array<struct<label:string,rank:int,start:int,end:int,rule:int>>"))
    best = F.array_min(F.transform(hits, lambda x: x["rank"]))
    score = F.when(F.size(base) > 0, F.lit(1.0))
    for rank, s in SCORES.items():
        score = score.when(best == rank, F.lit(s))
    joined = seen.drop("t").join(found, "key", "left")
    return joined.select(
        F.col("id").alias(id_col), n_words.cast("long").alias("n_words"),
        sum((F.coalesce(p["n"], F.lit(0)) for p in own), F.lit(0)).cast("long").alias("n_base"),
        F.least(*[p["first"] for p in own]).cast("long").alias("first_word"),
        F.greatest(*[p["last"] for p in own]).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.coalesce(base, empty))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.transform(hits, lambda x: x["label"])))), ",").alias("labels"),
        score.otherwise(F.lit(0.0)).alias("score"), hits.alias("found"))
