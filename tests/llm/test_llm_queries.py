"""The corpus queries against their DuckDB SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, digest  # noqa: E402
from tidemark.llm.oracle import LLM_ORACLES  # noqa: E402
from tidemark.llm.queries import LLM_QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = LLM_QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(LLM_ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, rows)[0] == digest(cols, res.fetchall())[0]


def test_all_are_registered():
    names = entry.queries()
    assert set(LLM_QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))
    assert set(LLM_ORACLES) <= set(entry.oracle_sql())


# ---- queries without SQL, on whole small tables, against plain Python ----------------------------------
def _docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()


def _library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: lib.encode(text or "", add_special_tokens=False).ids


def _crc(ids):
    import zlib

    import numpy as np

    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_op4_counts_are_the_library_s(spark):
    encode = _library("byte_bpe_50k.json")
    want = {r.doc_id: (len((r.text or "").encode()), len(encode(r.text))) for r in _docs(spark)}
    rows = LLM_QUERIES["op4_token_counts"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in rows} == want and len(rows) == len(want)
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)


def test_op5_holds_every_id_once(spark):
    encode = _library("byte_bpe_50k.json")
    rows = LLM_QUERIES["op5_packing"](spark, SF).collect()
    own, sequences = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    docs = _docs(spark)
    assert set(own) == {r.doc_id for r in docs}
    for r in docs:
        ids, at = encode(r.text) + [1], 0
        for piece in sorted(own[r.doc_id], key=lambda p: p.start):
            part = ids[at:at + piece.length]
            assert (piece.start, piece.doc_tokens, piece.ids_crc32) == (at, len(ids), _crc(part))
            at += piece.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_op6_learns_from_what_is_not_held_out(spark):
    import zlib

    rows = {r.doc_id: r for r in LLM_QUERIES["op6_language_id"](spark, SF).collect()}
    docs = _docs(spark)
    assert set(rows) == {r.doc_id for r in docs}
    langs = {r.lang for r in docs if r.lang} | {"und"}
    for r in docs:
        got = rows[r.doc_id]
        assert got.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert got.lang_pred in langs and 0 <= got.score <= 1
        assert (got.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    told = [rows[r.doc_id].lang_pred == r.lang for r in docs if rows[r.doc_id].held_out and r.lang]
    assert sum(told) >= 0.95 * len(told)


def test_op7_finds_all_base_phrases(spark):
    from fixtures import plain_words

    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    rows = {r.doc_id: r for r in LLM_QUERIES["op7_licenses"](spark, SF).collect()}
    docs = _docs(spark)
    assert set(rows) == {r.doc_id for r in docs}
    for r in docs:
        w, at, labels = plain_words(r.text), [], set()
        for label, phrase in phrases.items():
            p = phrase.split()
            found = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        got = rows[r.doc_id]
        assert (got.n_words, got.n_base, got.first_word, got.last_word, got.base_labels) == (
            len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert labels <= set(got.labels.split(",")) and 0 <= got.score <= 1


def test_op10_files_hold_all_ids_in_order(spark):
    encode = _library("word_bpe_49k.json")
    rows = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in LLM_QUERIES["op10_token_files"](spark, SF).collect()}
    want, at = {}, 0
    for r in sorted(_docs(spark), key=lambda r: r.doc_id):
        ids = encode(r.text) + [2]
        want[r.doc_id] = (at, len(ids), _crc(ids))
        at += len(ids)
    assert rows == want
