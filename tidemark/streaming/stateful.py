"""The tracker's rules over a streaming batch log (STR-5, streaming form).

``groupBy(proc).applyInPandasWithState``: the state of a processor is ``(trace, batch_num,
commit_time, dead)``; each micro-batch brings the processor's new log rows, which are applied in
batch-time order. The start state comes from a stream-static join with the start-state table and is
used only when the processor has no state yet. Output (append mode) has the same rows as the batch
replay: ``(proc, batch_time, trace, batch_num, outcome)``. Order across micro-batches must come from
the source (e.g. Kafka offsets, or one file per time range with ``maxFilesPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, BooleanType

from tidemark.operators.replay import LOG_COLUMNS, STATE_COLUMNS, replay_rows
from tidemark.session import ship_package

OUTPUT_SCHEMA = StructType([
    StructField("proc", StringType()),
    StructField("batch_time", LongType()),
    StructField("trace", StringType()),
    StructField("batch_num", IntegerType()),
    StructField("outcome", StringType()),
])
STATE_SCHEMA = StructType([
    StructField("trace", StringType()),
    StructField("batch_num", IntegerType()),
    StructField("commit_time", LongType()),
    StructField("dead", BooleanType()),
])


def _step_group(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    proc = key[0]
    log = pd.concat(list(pdfs), ignore_index=True)
    if state.exists:
        trace, batch_num, commit_time, dead = state.get
        st = {"trace": trace, "batch_num": int(batch_num), "commit_time": int(commit_time), "dead": bool(dead)}
    else:
        first = log.iloc[0]
        if first["trace"] is None or first["trace"] != first["trace"] or first["trace"] == "":
            raise ValueError(f"processor {proc!r} has no date to trace")
        st = {"trace": first["trace"], "batch_num": int(first["batch_num"]),
              "commit_time": int(first["commit_time"]), "dead": False}
    out = replay_rows(proc, log[list(LOG_COLUMNS)], st)
    state.update((st["trace"], int(st["batch_num"]), int(st["commit_time"]), bool(st["dead"])))
    yield out


def replay_stream(log_stream: DataFrame, start_state: DataFrame) -> DataFrame:
    """Streaming replay: ``log_stream(proc, batch_time, num_records, failed, sync)`` joined with the
    static ``start_state(proc, trace, batch_num, commit_time)``."""
    ship_package(log_stream.sparkSession)
    start = start_state.select(*STATE_COLUMNS)
    joined = log_stream.select(*LOG_COLUMNS).join(start, on="proc", how="left")
    return joined.groupBy("proc").applyInPandasWithState(
        _step_group, OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
