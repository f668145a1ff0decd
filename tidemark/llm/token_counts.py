"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import encoder
from tidemark.llm.common import prepare


def count_tokens(docs: DataFrame, path: str, limit: int = 512, drops_space: bool | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` per row of ``docs``.

    ``n_tokens`` is what the tokenizer file at ``path`` gives for the whole text without added special
    tokens; ``n_bytes`` is its UTF-8 size. Arrow batches are bounded by bytes, are encoded in groups
    balanced by bytes, and a text longer than a group is cut at safe boundaries (see
    :mod:`tidemark.llm.chunks`). No shuffle: only ids and three numbers a row leave the Python workers.

    Any file of the ``tokenizers`` library will do: how texts may be cut is read from it. A null text counts as empty; null or repeated ids give a row each; an empty table gives none; other
    columns are not read.
    """
    prepare(docs.sparkSession)

    def run(batches):
        enc = encoder(path, drops_space)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [np.diff(offsets) for _, _, _, offsets in enc.encode(texts)]
            n = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n.astype(np.int64)), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean") \
        .withColumnRenamed("id", id_col)
