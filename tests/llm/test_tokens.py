"""Token counts, packing and token files against the tokenizer itself."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fixtures import documents, empty
from tidemark.llm import chunks
from tidemark.llm.chunks import ChunkEncoder
from tidemark.llm.packing import first_fit_decreasing, pack
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.token_files import read_document, read_token_files, write_token_files
from tidemark.session import scratch_dir

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def _ids(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("path,drops", [(BYTE, False), (WORD, True)])
def test_chunks_give_the_library_s_ids(path, drops):
    rnd = random.Random(3)
    parts = ["a", "b", "word", "Éa", " ", "  ", "\n", "\t", " ", "　", " ", "é", "É", "'s", "'", "12", "½",
             "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "!", "...", "\x1c", "̈", "ß", "Σ", "😀", "\x85", "中", "_", "-", "×"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + ["", None, " ", "\n\n"]
    lib, got = Tokenizer.from_file(path), []
    for a, b, ids, offsets in ChunkEncoder(path, drops).encode(texts):
        got += [ids[offsets[i]:offsets[i + 1]].tolist() for i in range(b - a)]
    assert got == [[] if t is None else lib.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("change", ["", "lower", "no pieces", "added", "normalized", "prefix"])
@pytest.mark.parametrize("path", [BYTE, WORD])
def test_any_file_gives_the_library_s_ids_without_flags(tmp_path, path, change):
    import json

    file = json.load(open(path, encoding="utf-8"))
    if change == "lower":
        file["normalizer"] = {"type": "Lowercase"}
    elif change == "no pieces":
        file["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    elif change == "prefix":
        file["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}
    elif change:
        file["added_tokens"].append({**file["added_tokens"][0], "id": len(file["model"]["vocab"]) + 5, "content": "[x]",
                                     "normalized": change == "normalized"})
    own = str(tmp_path / "own.json")
    json.dump(file, open(own, "w", encoding="utf-8"))
    rnd = random.Random(8)
    parts = ["a", "Word", " ", "  ", "\n", "É", "'s", "12", "<|endoftext|>", "[x]", "[X]", "!", "ß", "中", "\u2003", "x."]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20))) for _ in range(300)] + ["", None]
    got = [x for a, b, ids, at in ChunkEncoder(own).encode(texts) for x in (ids[at[i]:at[i + 1]].tolist() for i in range(b - a))]
    lib = Tokenizer.from_file(own)
    assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert chunks.kind_of(own)[0] == ({BYTE: "bytes", WORD: "words"}[path] if change in ("", "added") else None)


def test_a_flag_that_contradicts_the_file_is_an_error(spark):
    with pytest.raises(ValueError, match="does not fit"):
        ChunkEncoder(WORD, False)
    docs = spark.createDataFrame([(1, "Some words, here"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, WORD).collect()}
    assert got == {1: len(_ids(WORD, "Some words, here")), 2: 0}


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    monkeypatch.setattr(chunks, "GROUP_CHARS", 200)
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["ab", "c.", "déf", "\n", "x" * 300]) for _ in range(400)), "y" * 900, "short", None]
    enc = ChunkEncoder(BYTE, False)
    got = [ids[o[i]:o[i + 1]].tolist() for a, b, ids, o in enc.encode(texts) for i in range(b - a)]
    assert got == [_ids(BYTE, t) for t in texts]
    monkeypatch.setattr(chunks, "CACHE_CHUNKS", 1)  # a full cache starts anew
    assert [len(ids) for _, _, ids, _ in enc.encode(texts[:1])] == [len(got[0])]


def test_the_arrays_of_an_encoder_stay_small():
    import tracemalloc

    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(500)]
    texts = [" ".join(rnd.choices(words, k=1000)) for _ in range(900)]
    assert sum(map(len, texts)) > 3 << 20
    enc = ChunkEncoder(BYTE)
    list(enc.encode(texts[:100]))  # the cache has all chunks
    tracemalloc.start()
    try:
        got = sum(len(ids) for _, _, ids, _ in enc.encode(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got > 900_000
    assert peak < 80e6


def test_token_counts(spark):
    docs = documents(spark)
    got = Counter(tuple(r) for r in count_tokens(docs, BYTE, limit=100).collect())
    expect = Counter((r.doc_id, len((r.text or "").encode()), n := len(_ids(BYTE, r.text)), n > 100)
                     for r in docs.collect())
    assert got == expect
    assert count_tokens(empty(spark), BYTE).count() == 0


def test_tree_packs_as_a_plain_search_does():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 3, 50, 257):
        lengths = rnd.integers(1, 65, n)
        room, expect = [], {}
        for i in np.argsort(-lengths, kind="stable"):
            b = next((j for j, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(64)
            expect[i] = (b, 64 - room[b])
            room[b] -= lengths[i]
        bins, offsets = first_fit_decreasing(lengths, 64)
        assert {i: (bins[i], offsets[i]) for i in range(n)} == expect


def test_packing_holds_every_id_once(spark):
    docs = documents(spark)
    rows = pack(docs, BYTE, capacity=128, end_id=1).collect()
    want = Counter()
    for r in docs.collect():
        ids = _ids(BYTE, r.text) + [1]
        for a in range(0, len(ids), 128):
            part = ids[a:a + 128]
            want[(r.doc_id, a, len(part), _crc(part), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    used = sum(r.length for r in rows)
    assert 128 * len(sequences) - used < 0.05 * used
    assert pack(empty(spark), BYTE).count() == 0


def test_packing_keeps_large_ids_beside_null_ones(spark):
    ids = [2**53 + 1, 2**60 + 7, None, -(2**62) - 1, None, 5]
    docs = spark.createDataFrame([(i, "a few words") for i in ids], "doc_id long, text string")
    assert Counter(r.doc_id for r in pack(docs, BYTE).collect()) == Counter(ids)


def test_token_files_round_trip(spark):
    docs = documents(spark)
    root = scratch_dir(spark, "test-tokens")
    manifest = write_token_files(docs, WORD, root, drops_space=True, end_id=2)
    rows = read_token_files(spark, manifest, root, with_ids=True).collect()
    expect = Counter((r.doc_id, tuple(_ids(WORD, r.text) + [2])) for r in docs.collect())
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, dtype="<u4").tolist())) for r in rows) == expect
    assert all(r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in rows)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    first = manifest.orderBy("shard").first()
    key, ids = read_document(root, first["name"], first["docs"] - 1)
    assert (key, tuple(ids.tolist())) in expect
    none = write_token_files(empty(spark), WORD, root + "-none", drops_space=True)
    assert none.count() == 0 and read_token_files(spark, none, root + "-none").count() == 0


def test_few_texts_have_a_shared_dictionary_too(spark):
    import hashlib

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["some words again", "some words once more", None, ""])],
                                 "doc_id long, text string")
    root = scratch_dir(spark, "test-few")
    manifest = write_token_files(docs, WORD, root, end_id=2)
    assert manifest.first()["dictionary"] != hashlib.sha256(b"").hexdigest()
    got = {r.doc_id: np.frombuffer(r.ids, dtype="<u4").tolist() for r in read_token_files(spark, manifest, root, with_ids=True).collect()}
    assert got == {r.doc_id: _ids(WORD, r.text) + [2] for r in docs.collect()}
    nothing = write_token_files(docs.where("doc_id > 1"), WORD, root + "-empty", end_id=2)
    assert read_token_files(spark, nothing, root + "-empty").count() == 2


def test_token_files_notice_damage(spark):
    import os

    from tidemark.llm.shards import store

    root = scratch_dir(spark, "test-damage")
    manifest = write_token_files(documents(spark), WORD, root, drops_space=True)
    _, base = store(root)
    name = os.path.join(base, manifest.first()["name"])
    data = bytearray(open(name, "rb").read())
    data[60] ^= 255
    open(name, "wb").write(data)
    with pytest.raises(Exception, match="damaged|zstd|decompress|Data corruption"):
        read_token_files(spark, manifest, root).collect()
