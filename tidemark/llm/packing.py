"""Packing documents into fixed-length training sequences.

Each document's ids are cut into full sequences and one remainder. The remainders are dealt at random
into groups of bounded size, and in each group are packed first-fit decreasing: a tournament tree over
the bins' free room gives the first bin that a piece fits into in logarithmic time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import encoder
from tidemark.llm.common import cut, prepare
from tidemark.llm.shards import batches_of

GROUP_PIECES = 8_192  # remainders per group, about
GROUP_BITS = 20  # a group makes fewer sequences than 2 ** GROUP_BITS


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (every one at most ``capacity``), longest first, ties in order."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    # node i holds the most room of any bin below it; bins are the leaves, all open from the start
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        node //= 2
        while node:
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
            node //= 2
    return bins, offsets


def cut_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1,
                  drops_space: bool | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens, n)``: the pieces of each document (null text: empty),
    its ids followed by ``end_id``. ``n`` numbers a task's pieces."""
    prepare(docs.sparkSession)
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("n", pa.int64())])

    def pieces(batches):
        enc, n = encoder(path, drops_space), 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b, ids, offsets in enc.encode(texts):
                for i in range(a, b):
                    own = np.concatenate((ids[offsets[i - a]:offsets[i - a + 1]].astype("<u4", copy=False), end))
                    for start in range(0, len(own), capacity):
                        part = own[start:start + capacity]
                        yield keys[i], start, len(part), zlib.crc32(part.tobytes()), len(own), n
                        n += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda b: batches_of(pieces(b), schema),
                           "id long, start long, length long, ids_crc32 long, doc_tokens long, n long")


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, drops_space: bool | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` ids. Per piece: ``id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset``.

    The pieces are written once to the shared folder; only their numbers are shuffled, no ids. A group is
    chosen by hash over id, checksum and the piece's number in its task, so repeated rows, null ids and
    equal texts spread evenly, and a group's size does not depend on the data. Null text or empty text:
    one piece, the end id alone. Empty table: no row. Other columns are not read.
    """
    pieces = cut(cut_documents(docs, path, capacity, end_id, drops_space, id_col, text_col), "pieces")
    full = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, round(rest.count() / GROUP_PIECES))
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("id", "ids_crc32", "n"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        # as Arrow columns: a long beside a null stays the long that it is
        length, crc, number = (table.column(c).to_numpy() for c in ("length", "ids_crc32", "n"))
        key = table.column("id")
        table = table.take(pa.array(np.lexsort((number, crc, pc.fill_null(key, 0).to_numpy(), key.is_null().to_numpy(), length))))
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        if len(bins) and bins.max() >= 1 << GROUP_BITS:
            raise ValueError(f"a group of {len(bins)} pieces needs more than {1 << GROUP_BITS} sequences")
        return table.select(["id", "start", "length", "ids_crc32", "doc_tokens"]) \
            .append_column("sequence_id", pa.array(2 * (table.column("grp").to_numpy() * 2**GROUP_BITS + bins))) \
            .append_column("offset", pa.array(offsets))

    packed = dealt.groupBy("grp").applyInArrow(
        run, "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    # packed sequences have even numbers, sequences of one full piece odd ones
    alone = full.select("id", "start", "length", "ids_crc32", "doc_tokens",
                        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone).withColumnRenamed("id", id_col)
