"""Send keyed messages to a topic (SNK-1).

The producer settings of the reference map onto the Kafka sink as follows (fixed names):

* ``extension.partitioner``: ``hash`` (default) -> partition = unsigned fingerprint of the key modulo
  the partition count; ``random`` -> no partition (the client picks); a number -> that partition,
  a negative number -> as ``random``
* ``extension.queue.full.waiting.ms`` (default 1000, negative refused) -> ``kafka.max.block.ms``
* ``global.<name>`` and ``topic.<name>`` -> ``kafka.<name>``; other keys are ignored

Delivery is at least once: a failed task is retried by Spark and may send its records again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import PARTITIONER_HASH, partition_for

# ---- fixed values ---------------------------------------------------------------------------
PARTITIONER_KEY = "extension.partitioner"
QUEUE_WAIT_KEY = "extension.queue.full.waiting.ms"
FLUSH_INTERVAL_KEY = "extension.flush.interval.ms"
DEFAULT_QUEUE_WAIT_MS = 1000
PREFIXES = ("topic.", "global.")
# ---------------------------------------------------------------------------------------------


def kafka_sink_options(brokers: str, props: dict[str, str] | None = None) -> dict[str, str]:
    props = dict(props or {})
    wait = props.get(QUEUE_WAIT_KEY, "")
    wait_ms = DEFAULT_QUEUE_WAIT_MS if wait == "" else int(wait)
    if wait_ms < 0:
        raise ValueError(f"{QUEUE_WAIT_KEY} must be >= 0")
    flush = props.get(FLUSH_INTERVAL_KEY, "")
    if flush != "" and int(flush) < 0:
        raise ValueError(f"{FLUSH_INTERVAL_KEY} must be >= 0")
    opts = {"kafka.bootstrap.servers": brokers, "kafka.max.block.ms": str(wait_ms)}
    for k, v in props.items():
        for prefix in PREFIXES:
            if k.startswith(prefix):
                opts[f"kafka.{k[len(prefix):]}"] = str(v)
    return opts


def prepare_messages(df: DataFrame, topic: str | Column, key: str = "key", value: str = "value",
                     partitioner: str | int = PARTITIONER_HASH, num_partitions: int | None = None) -> DataFrame:
    """``(key BINARY, value BINARY, topic STRING, partition INT)`` as the Kafka sink expects."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    out = df.select(
        F.col(key).cast("binary").alias("key"),
        F.col(value).cast("binary").alias("value"),
        t.alias("topic"),
        partition_for(partitioner, F.col(key), num_partitions).alias("partition"),
    )
    return out


def write_messages(df: DataFrame, brokers: str, topic: str, key: str = "key", value: str = "value",
                   props: dict[str, str] | None = None, num_partitions: int | None = None,
                   checkpoint: str | None = None):
    """Write a batch or streaming frame to Kafka; returns the streaming query for a stream.

    ``props`` are the producer settings (see the module docstring). The ``hash`` partitioner needs the
    topic's partition count in ``num_partitions``: partitions are chosen in the query from the key's
    fingerprint, not by the client."""
    props = dict(props or {})
    mode = props.get(PARTITIONER_KEY, PARTITIONER_HASH)
    msgs = prepare_messages(df, topic, key, value, mode, num_partitions)
    if str(mode) != PARTITIONER_HASH and (str(mode) == "random" or int(mode) < 0):
        msgs = msgs.drop("partition")  # no partition column: the Kafka client chooses
    opts = kafka_sink_options(brokers, props)
    if df.isStreaming:
        w = msgs.writeStream.format("kafka").options(**opts)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    msgs.write.format("kafka").options(**opts).save()
    return None
