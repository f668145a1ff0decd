"""Token-id files: each document compressed by itself with a shared zstandard dictionary.

File layout (little-endian): ``TIDTOK01``, the SHA-256 of the dictionary (32 bytes), one zstandard frame
of uint32 ids per document, then the index (48 bytes a document: id, 1 if the id is null, offset,
compressed size, tokens and a CRC-32 as int64) and a tail of two int64: offset of the index, documents.
A reader that wants one short document reads tail, index entry and frame. The dictionary lies beside the
files under its hash.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import encoder
from tidemark.llm.common import cut, doc_key, prepare
from tidemark.llm.shards import TemporaryFile, batches_of, commit, one_row_tasks, store

MAGIC = b"TIDTOK01"
ENTRY, ENTRY_SIZE = "<6q", 48
TAIL, TAIL_SIZE = "<2q", 16

SAMPLE_DOCS = 1_000  # documents the dictionary is trained on, at most
SAMPLE_BYTES = 16_384  # bytes of ids taken of each of them
DICTIONARY_BYTES = 65_536
SHARD_BYTES = 32 << 20  # bytes of text per file, about
LEVEL = 3


def _ids_rows(docs, path, drops_space, end_id):
    """Iterator of ``(id, ids as little-endian uint32 bytes)`` over Arrow batches of ``(id, text)``."""
    enc = encoder(path, drops_space)
    end = struct.pack("<I", end_id)
    for batch in docs:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b, ids, offsets in enc.encode(texts):
            ids = ids.astype("<u4", copy=False)
            for i in range(a, b):
                yield keys[i], ids[offsets[i - a]:offsets[i - a + 1]].tobytes() + end


def train_dictionary(docs: DataFrame, path: str, drops_space: bool | None, end_id: int,
                     id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """Dictionary fitted on the serialized ids of a bounded sample: about ``SAMPLE_DOCS`` documents, chosen
    by a hash of id and text, the first ``SAMPLE_BYTES`` of each. Where that is too little or too uniform to train
    on, the sample itself is the dictionary (its last ``DICTIONARY_BYTES``, as raw content); empty without a text."""
    import zstandard

    key = F.pmod(doc_key(id_col, text_col), F.lit(max(1, docs.count())))
    sample = docs.where((key < SAMPLE_DOCS) & (F.length(text_col) > 0)).select(
        F.lit(0).alias("id"), F.substring(text_col, 1, SAMPLE_BYTES).alias("text"))

    def run(batches):
        rows = ((x[:SAMPLE_BYTES],) for _, x in _ids_rows(batches, path, drops_space, end_id))
        yield from batches_of(rows, pa.schema([("ids", pa.binary())]), 1_000)

    samples = [bytes(r["ids"]) for r in sample.mapInArrow(run, "ids binary").collect()]
    total = sum(map(len, samples))
    raw = b"".join(samples)[-DICTIONARY_BYTES:]
    if len(samples) < 16 or total < 32_768:
        return raw
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # samples too uniform to train on
        return raw


def write_token_files(docs: DataFrame, path: str, root: str, drops_space: bool | None = None, end_id: int = 2,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id`` and write the files under ``root`` in
    ascending id order (nulls first; rows of one id by the hash of their text). Returns the manifest:
    ``shard, name, temporary, size, docs, tokens, dictionary``.

    One range shuffle of the texts; within a task a document is encoded, compressed and written before
    the next one is looked at. An empty table gives no file. Other columns are not read.
    """
    import zstandard

    spark = docs.sparkSession
    prepare(spark)
    trained = train_dictionary(docs, path, drops_space, end_id, id_col, text_col)
    digest = hashlib.sha256(trained).hexdigest()
    fs, base = store(root)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/{digest}.dict") as f:
        f.write(trained)

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
        out, index, tokens = None, [], 0
        for key, ids in _ids_rows(batches, path, drops_space, end_id):
            if out is None:
                out = TemporaryFile(root, f"tokens-{shard:06d}.bin")
                out.write(MAGIC + bytes.fromhex(digest))
            frame = packer.compress(ids)
            index.append(struct.pack(ENTRY, key or 0, key is None, out.size, len(frame), len(ids) // 4, zlib.crc32(ids)))
            out.write(frame)
            tokens += len(ids) // 4
        if out is not None:
            at = out.size
            for i in range(0, len(index), 4096):
                out.write(b"".join(index[i:i + 4096]))
            out.write(struct.pack(TAIL, at, len(index)))
            out.close()
            yield from batches_of([(shard, out.name, out.temporary, out.size, len(index), tokens, digest)],
                                  pa.schema([("shard", pa.int32()), ("name", pa.string()),
                                             ("temporary", pa.string()), ("size", pa.int64()),
                                             ("docs", pa.int64()), ("tokens", pa.int64()),
                                             ("dictionary", pa.string())]))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = rows.agg(F.sum(F.octet_length("text") + 16).alias("n")).first()["n"] or 0
    dealt = rows.repartitionByRange(max(1, -(-n // SHARD_BYTES)), F.col("id"), F.xxhash64("text")) \
        .sortWithinPartitions("id", F.xxhash64("text"))
    manifest = dealt.mapInArrow(run, "shard int, name string, temporary string, size long, docs long, "
                                     "tokens long, dictionary string")
    return commit(spark, cut(manifest, "token-manifest"), root)


def read_token_files(spark: SparkSession, manifest: DataFrame, root: str, id_col: str = "doc_id",
                     with_ids: bool = False) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` of every document in the manifest's files, from the bytes of
    its frame; ``with_ids`` adds the ids as binary. A file whose dictionary hash, length or checksum does
    not agree is an error."""
    prepare(spark)
    # tokens before each file: one row per file, whatever the number of documents
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("name", "dictionary", "docs", F.coalesce(before, F.lit(0)).alias("start"))

    def run(batches):
        import zstandard

        fs, base = store(root)
        for batch in batches:
            for r in batch.to_pylist():
                with fs.open_input_file(f"{base}/{r['dictionary']}.dict") as f:
                    trained = f.read()
                if hashlib.sha256(trained).hexdigest() != r["dictionary"]:
                    raise OSError(f"{r['dictionary']}: the dictionary does not have this hash")
                reader = zstandard.ZstdDecompressor(
                    dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
                with fs.open_input_file(f"{base}/{r['name']}") as f:
                    yield from batches_of(documents(f, reader, r), schema, 1_000 if with_ids else 10_000)

    def documents(f, reader, r):
        head = f.read(40)
        f.seek(f.size() - TAIL_SIZE)
        at, n = struct.unpack(TAIL, f.read(TAIL_SIZE))
        if head[:8] != MAGIC or head[8:].hex() != r["dictionary"] or n != r["docs"]:
            raise OSError(f"{r['name']}: not the file that the manifest names")
        start = r["start"]
        for a in range(0, n, 4096):
            f.seek(at + a * ENTRY_SIZE)
            entries = [*struct.iter_unpack(ENTRY, f.read(min(4096, n - a) * ENTRY_SIZE))]
            f.seek(entries[0][2])
            for key, null, _, size, tokens, crc in entries:
                ids = reader.decompress(f.read(size), max_output_size=4 * tokens)
                if len(ids) != 4 * tokens or zlib.crc32(ids) != crc:
                    raise OSError(f"{r['name']}: a document's frame is damaged")
                yield (None if null else key, start, tokens, zlib.crc32(ids)) + ((ids,) if with_ids else ())
                start += tokens

    types = [(id_col, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(types + [("ids", pa.binary())] * with_ids)
    return one_row_tasks(files).mapInArrow(
        run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def read_document(root: str, name: str, position: int) -> tuple[int | None, np.ndarray]:
    """One document by its place in a file: reads the tail, one index entry, the dictionary, one frame."""
    import zstandard

    fs, base = store(root)
    with fs.open_input_file(f"{base}/{name}") as f:
        digest = f.read(40)[8:].hex()
        f.seek(f.size() - TAIL_SIZE)
        at, n = struct.unpack(TAIL, f.read(TAIL_SIZE))
        if not 0 <= position < n:
            raise IndexError(position)
        f.seek(at + position * ENTRY_SIZE)
        key, null, offset, size, tokens, _ = struct.unpack(ENTRY, f.read(ENTRY_SIZE))
        f.seek(offset)
        frame = f.read(size)
    with fs.open_input_file(f"{base}/{digest}.dict") as f:
        trained = f.read()
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(trained) if trained else None)
    return None if null else key, np.frombuffer(reader.decompress(frame, max_output_size=4 * tokens), dtype="<u4")
