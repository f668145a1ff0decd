"""Every stage of the pipeline against a brute-force twin on its own input, and the whole."""

import os
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from fixtures import documents, plain_words, prose, words
from tidemark.llm.common import table
from tidemark.session import scratch_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark):
    """``documents`` and ``benchmark`` in one folder, with nulls in every column."""
    import random

    root = scratch_dir(spark, "test-pipeline")
    rnd = random.Random(9)
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    leak = prose(rnd, 25, [f"item{i}" for i in range(400)])
    rows += [(200, "some words before " + leak + " and some after"), (201, leak), (202, "Le " + leak.upper() + " fin")]
    rows = [(i, t, [None, "en", "fr"][n % 3], [None, "s"][n % 2], None if n % 5 == 0 else len(t or "")) for n, (i, t) in enumerate(rows)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{root}/documents.parquet")
    items = [(0, leak), (1, "short one"), (2, None), (None, prose(rnd, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def _rows(df):
    assert df.columns == COLUMNS
    return Counter(tuple(r) for r in df.collect())


def _stages(spark, root):
    """``name -> (input rows, output)`` of each stage, written and read as the runner does."""
    docs, out = table(spark, root, "documents"), {}
    for name, stage in pipeline.STAGES:
        path = scratch_dir(spark, f"test-{name}")
        stage(spark, docs, root).write.parquet(path)
        out[name] = (docs.collect(), spark.read.parquet(path))
        docs = out[name][1]
    return out


@pytest.fixture(scope="module")
def stages(spark, folder):
    return _stages(spark, folder)


def test_order():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "decontamination", "packing"]


def test_language_stage_rejects_what_is_in_no_learned_language(spark, stages):
    rows, out = stages["language_id"]
    kept, letters = _rows(out), Counter(tuple(r) for r in rows if any(c.isalpha() for c in r.text or ""))
    assert not kept - letters and sum((letters - kept).values()) <= 2
    gone = [r[1] for r in letters - kept]
    assert all(len(t) < 100 for t in gone)  # no prose


def test_language_stage_differs_from_a_letter_filter(spark):
    import random

    rnd = random.Random(5)
    prose_rows = [(i, prose(rnd, 200), "en", None, None) for i in range(20)]
    noise = " ".join("".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(8)) for _ in range(60))
    odd = [(100, noise, None, None, None), (101, "", None, None, None), (None, "1 2 3", "en", None, None), (102, None, "en", None, None)]
    again = [(0, prose_rows[0][1], None, None, None), (None, prose_rows[1][1][:40], None, None, None)]
    docs = spark.createDataFrame([(*r, 7, "z") for r in prose_rows + odd + again],
                                 "doc_id long, text string, lang string, source string, n_chars long, key int, evidence string")
    assert _rows(pipeline.language_id(spark, docs, None)) == Counter(prose_rows + again)


def test_near_dedup_keeps_one_row_of_each_group(stages):
    rows, out = stages["near_dedup"]
    from test_neardup import _set

    sets = [_set(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            near = sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
            if near or (rows[i].doc_id, rows[i].text) == (rows[j].doc_id, rows[j].text):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i])
    kept = _rows(out)
    assert sum(kept.values()) == len(groups)
    for g in groups.values():
        least = min((r.doc_id for r in g if r.doc_id is not None), default=None)
        assert sum(kept[t] for t in {tuple(r) for r in g}) == 1
        assert any(kept[tuple(r)] for r in g if r.doc_id == least)


def test_repeated_rows_leave_one_full_text(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text, "en", None, None)] * 3 + [(1, text, "fr", "s", 5), (2, "other words here", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.near_dedup(spark, docs, None)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, text), (2, "other words here")]
    path = scratch_dir(spark, "test-repeated")
    kept.write.parquet(path)
    assert sorted(r.text for r in pipeline.substring_dedup(spark, spark.read.parquet(path), None).collect()) == ["other words here", text]
    assert pipeline.near_dedup(spark, docs.where("false"), None).count() == 0


def _edited(base, n):
    """The words with ``n`` of them replaced, far apart from each other."""
    w = list(base)
    for i in range(n):
        w[10 + 20 * i] = f"edit{i}"
    return " ".join(w)


def _near_dedup(spark, rows):
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.near_dedup(spark, docs, None)
    assert out.columns == COLUMNS
    return sorted(((r.doc_id, r.text, r.lang) for r in out.collect()), key=repr)


def test_near_dedup_links_at_four_fifths(spark):
    # of 96 shingles, two edits leave 86 of 106 (0.811), three leave 81 of 111 (0.730)
    two, three = [f"a{i}" for i in range(100)], [f"b{i}" for i in range(100)]
    rows = [(1, " ".join(two), "en"), (2, _edited(two, 2), "en"), (3, " ".join(three), "en"), (4, _edited(three, 3), "en")]
    assert _near_dedup(spark, rows) == [rows[0], rows[2], rows[3]]


def test_near_dedup_keeps_one_where_ids_repeat_or_are_null(spark):
    a, b, c, d = ([f"{x}{i}" for i in range(100)] for x in "abcd")
    shared = [(1, " ".join(a), "en"), (1, _edited(a, 1), "en"), (2, " ".join(a), "fr")]
    nameless = [(None, " ".join(b), "en"), (None, " ".join(b), "fr"), (None, _edited(b, 1), "en")]
    # unrelated texts of one id are groups of their own, and so are unrelated texts without one
    apart = [(3, " ".join(c), "en"), (3, " ".join(d), "en"), (None, " ".join(reversed(c)), "en"), (None, " ".join(reversed(d)), "en")]
    got = _near_dedup(spark, shared + nameless + apart)
    assert len([r for r in got if r in shared[:2]]) == 1 and shared[2] not in got
    assert len([r for r in got if r in nameless]) == 1
    assert [r for r in got if r in apart] == sorted(apart, key=repr) and len(got) == 6


def _removed(rows, window=35):
    docs = [words(r.text) for r in rows]
    seen = Counter(tuple(w[i:i + window]) for w in docs for i in range(len(w) - window + 1))
    for r, w in zip(rows, docs):
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for p in range(i, i + window)}
        yield r, w, gone


def test_substring_stage_cuts_repeats(stages):
    rows, out = stages["substring_dedup"]
    expect = Counter()
    for r, w, gone in _removed(rows):
        text = " ".join(x for i, x in enumerate(w) if i not in gone) if gone else r.text
        expect[(r.doc_id, text, r.lang, r.source, len(text))] += 1
    assert _rows(out) == expect and any(gone for _, _, gone in _removed(rows))


def test_decontamination_cuts_items(spark, folder, stages):
    rows, out = stages["decontamination"]
    items = [r.text for r in table(spark, folder, "benchmark").collect()]
    index = set()
    for t in items:
        w = plain_words(t)
        index |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    got = {r.doc_id: r for r in out.collect()}
    cut = 0
    for r in rows:
        w = plain_words(r.text)
        hit = {p for n in {len(x) for x in index} for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in index for p in range(i, i + n)}
        assert plain_words(got[r.doc_id].text) == [x for i, x in enumerate(w) if i not in hit]
        if not hit:
            assert got[r.doc_id].text == r.text
        cut += bool(hit)
        assert got[r.doc_id].n_chars == len(got[r.doc_id].text)
    assert cut >= 2 and out.count() == len(rows)


def test_packing_packs_all(stages):
    rows, out = stages["packing"]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r in rows:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), 2048):
            part = np.array(ids[a:a + 2048], dtype="<u4")
            want[(r.doc_id, a, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out.collect()) == want


def test_run_is_all_stages(spark, folder, stages):
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, pipeline.run(spark, folder).collect())) == Counter(map(key, stages["packing"][1].collect()))


def test_empty_documents(spark, folder):
    root = scratch_dir(spark, "test-pipeline-empty")
    table(spark, folder, "documents").where("false").write.parquet(f"{root}/documents.parquet")
    table(spark, folder, "benchmark").write.parquet(f"{root}/benchmark.parquet")
    assert pipeline.run(spark, root).count() == 0


def test_nothing_else_needs_the_subpackage():
    top = os.path.dirname(os.path.abspath(pipeline.__file__))
    for base, dirs, files in os.walk(os.path.join(top, "tidemark")):
        if os.path.basename(base) == "llm":
            continue
        for f in files:
            if f.endswith(".py") and "llm" not in os.path.relpath(base, top).split(os.sep):
                assert not re.search(r"tidemark\.llm|corpus_pipeline", open(os.path.join(base, f)).read())
