"""License scans and decontamination against plain Python, and their plans."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fixtures import documents, empty, plain_words
from tidemark.llm.decontaminate import contaminated, cut_spans
from tidemark.llm.licenses import GATE, PHRASES, rules, scan


def _license_docs(spark):
    rows = [(1, "This is under the MIT License, you see; under the mit license."), (2, "Apache License, Version 2.0 (cc-by-nc 4.0)"),
            (3, None), (4, ""), (5, "Licensed under the GNU General Public License, version 3"), (6, "no such words"),
            (7, "cc by nc cc by nc-nd"), (8, "SPDX-License-Identifier: MPL-2.0"), (9, "mit license"), (None, "Apache 2.0 license"),
            (1, "This is under the MIT License, you see; under the mit license."), (10, "licénse É"),
            (11, "is released under the BSD 3-Clause License. " * 40), (12, "permitted. submit licenses"),
            (13, "the gnu general public license version 2 or the mit license"), (14, "license")]
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, key string, t int")


def _scan(text):
    w = plain_words(text)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    base = {x[1] for x in places}
    # every rule in a text that passes the gate; inside another of the same or a higher rank: dropped
    t, found = f" {' '.join(w)} ", []
    if any(g in t for g in GATE):
        for n, (label, word, rank, expression) in enumerate(rules()):
            found += [(m.start(), m.end(), rank, n, label) for m in re.finditer(f"(?<= )(?:{expression})(?= )", t) if word in t]
    found.sort(key=lambda x: (x[0], -x[1], x[2], x[3]))
    kept, ends = [], {}
    for a, b, rank, n, label in found:
        if not any(r <= rank and e >= b for r, e in ends.items()):
            kept.append((rank, label))
        ends[rank] = max(ends.get(rank, -1), b)
    score = 1.0 if base else max(({1: 0.9, 2: 0.7, 3: 0.5}[r] for r, _ in kept), default=0.0)
    starts = [x[0] for x in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {x[1] for x in kept})), score)


def test_licenses(spark):
    for docs in (_license_docs(spark), documents(spark), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        got = Counter((r.doc_id, *r[1:8]) for r in scan(docs).collect())
        assert got == Counter((r.doc_id, *_scan(r.text)) for r in docs.collect())
    assert scan(empty(spark)).count() == 0


def test_rules_are_hundreds_and_gated():
    assert len(rules()) > 200
    for label, word, rank, expression in rules():
        re.compile(expression)
        assert rank in (1, 2, 3) and word == word.lower()


def _spelled(expression):
    """Every text that a rule's expression matches: none repeats without end, so they can be listed."""
    def of(items):
        out = {""}
        for op, arg in items:
            kind = str(op)
            if kind == "LITERAL":
                now = {chr(arg)}
            elif kind == "IN":
                now = {chr(c) for k, v in arg for c in (range(v[0], v[1] + 1) if str(k) == "RANGE" else [v])}
            elif kind == "BRANCH":
                now = set().union(*map(of, arg[1]))
            elif kind == "SUBPATTERN":
                now = of(arg[-1])
            elif kind == "MAX_REPEAT":
                assert arg[:2] == (0, 1)
                now = {""} | of(arg[2])
            else:
                assert kind in ("ASSERT", "ASSERT_NOT")
                now = {""}
            out = {a + b for a in out for b in now}
        return out

    return of(re._parser.parse(expression))


def test_gate_is_in_every_match():
    for label, word, rank, expression in rules():
        for text in _spelled(expression):
            assert any(g in f" {text} " for g in GATE), (label, text)


def test_keyword_is_in_every_match():
    for label, word, rank, expression in rules():
        for text in _spelled(expression):
            assert word in text, (label, word, text)


BSD_BODY = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met:")
ISC_BODY = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"


@pytest.mark.parametrize("text,label,score", [
    (BSD_BODY, "bsd", 0.9), (ISC_BODY, "isc", 0.9),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit", 0.9),
    ("This program is released under the GPL v2.", "gpl-2", 0.9), ("distributed under Apache 2.0", "apache-2", 0.9),
    ("It is made available under MIT", "mit", 0.9), ("are published under the terms of the MPL 2.0", "mpl-2", 0.9),
    ("published under pressure", "", 0.0)])
def test_texts_that_never_say_license(spark, text, label, score):
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, row.score) == (label, score)


@pytest.mark.parametrize("text,label", [
    ("licensed under the SIL Open Font License", "ofl"), ("SPDX-License-Identifier: OFL-1.1", "ofl"),
    ("GNU Library General Public License version 2", "lgpl-2"), ("the Lesser General Public License, v2.1", "lgpl-2")])
def test_every_alternative_is_tried(spark, text, label):
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.labels, row.score) == (label, 0.9)


def _untried(text):
    """Labels by all rules on the text, with no gate and no keyword."""
    t, found = f" {' '.join(plain_words(text))} ", []
    for n, (label, _, rank, expression) in enumerate(rules()):
        found += [(m.start(), -m.end(), rank, n, label) for m in re.finditer(f"(?<= )(?:{expression})(?= )", t)]
    kept, ends = set(), {}
    for a, b, rank, n, label in sorted(found):
        if not any(r <= rank and e >= -b for r, e in ends.items()):
            kept.add(label)
        ends[rank] = max(ends.get(rank, -1), -b)
    return kept | {label for phrase, label in PHRASES.items() if f" {phrase} " in t}


def test_licenses_without_gate_and_keywords(spark):
    import random

    rnd = random.Random(4)
    texts = [t for r in rules() for t in rnd.sample(sorted(_spelled(r[3])), k=1)]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in scan(docs).collect()}
    want = {i: ",".join(sorted(_untried(f"before {t} after"))) for i, t in enumerate(texts)}
    assert got == want and all(want.values())


def test_overlaps_are_suppressed(spark):
    found = {r.doc_id: [(x.label, x.rank) for x in r.found] for r in scan(_license_docs(spark)).collect()}
    assert found[5] == [("gpl-3", 1)]  # not also the plain mention of the general public license inside
    assert found[11] == [("bsd-3", 1)] * 40
    assert found[12] == [] and found[14] == []


def _windows(text, n=10):
    w = plain_words(text)
    return [tuple(w[i:i + min(n, len(w))]) for i in range(max(1, len(w) - n + 1))] if w else []


def _contaminated(rows, items, n=10):
    index = {}
    for item, text in items:
        for x in _windows(text, n):
            index.setdefault(x, set()).add(item)
    out = Counter()
    for r in rows:
        w, hit, got = plain_words(r.text), set(), set()
        for size in {len(x) for x in index}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in index:
                    hit |= set(range(i, i + size))
                    got |= index[tuple(w[i:i + size])]
        ids = ",".join(sorted(str(x) for x in got if x is not None))
        out[(r.doc_id, len(w), len(hit), len({x for x in got if x is not None}),
             hashlib.sha256(ids.encode()).hexdigest(), bool(hit))] += 1
    return out


@pytest.mark.parametrize("short", [False, True])
def test_decontamination(spark, short):
    docs = documents(spark)
    rows = docs.collect()
    items = [(0, " ".join(plain_words(rows[0].text)[3:40]).upper()), (1, rows[7].text), (1, rows[14].text), (2, "nothing like it at all"),
             (3, None), (4, ""), (None, " ".join(plain_words(rows[21].text)[:12])), (0, " ".join(plain_words(rows[0].text)[3:40]).upper())]
    if short:
        items += [(5, "one"), (6, "ONE, two!"), (7, "words with other"), (8, "changed")]
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, h int")
    got = Counter(tuple(r) for r in contaminated(docs, bench).drop("spans").collect())
    assert got == _contaminated(rows, items)
    assert contaminated(empty(spark), bench).count() == 0
    assert contaminated(docs, bench.where("false")).where("contaminated or n_hit > 0").count() == 0


def test_cut_spans(spark):
    rows = [("Zero, one two; three (four) five.", [(1, 2), (2, 2)], "Zero four) five"), ("a b c", [(0, 3)], ""),
            ("a b c", [(2, 1)], "a b"), ("A-b  c!", [(1, 1)], "A c"), ("É é x", [(0, 1)], "é x")]
    df = spark.createDataFrame(rows, "text string, spans array<struct<start:int,length:int>>, want string")
    got = cut_spans(df).collect()
    assert [r.text for r in got] == [r.want for r in got]
    assert cut_spans(df.withColumn("spans", F.lit(None).cast("array<struct<start:int,length:int>>"))).first().text == rows[0][0]


@pytest.mark.parametrize("run", [lambda d, b: scan(d), contaminated])
def test_no_python_on_the_main_path(spark, run):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    df = run(docs, bench)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
