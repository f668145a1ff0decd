"""Dated topics: which topics a processor reads for a date (SRC-2) and the stream over them (SRC-1).

A producer dataset has a comma list of topics; the topic of a date is ``{topic}-{yyyyMMdd}``. Kafka is
the production source (``startingOffsets=earliest`` when there is no checkpoint, a cap per trigger).
A folder ``dated_topic={topic}-{date}`` per dated topic holding ``(key BINARY, value STRING)`` files is the stand-in used by the
tests: the Kafka connector is not part of this environment.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.enrich import enrich
from tidemark.operators.meta import upstream_names

FOLDER_KEY = "dated_topic"
RECORD_SCHEMA = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("value", T.StringType())])


def dated_topic(topic: Column | str, date: Column | str) -> Column:
    t = F.col(topic) if isinstance(topic, str) else topic
    d = F.col(date) if isinstance(date, str) else date
    return F.concat(t, F.lit("-"), d)


def dated_topics(datasets: DataFrame, requests: DataFrame, ds: str = "ds", topics: str = "topics",
                 producers: str = "producers", date: str = "date") -> DataFrame:
    """``(date, topic, dated_topic)``: the distinct topics of the requested producers for each date.

    ``requests(date, producers)`` holds a comma list of producer names (empty names ignored,
    repeated names collapse); ``datasets(ds, topics)`` holds each producer's comma list of topics.
    """
    wanted = requests.select(F.col(date).alias("date"), F.explode(upstream_names(producers)).alias("_ds")).distinct()
    ds_topics = datasets.select(F.col(ds).alias("_ds"), F.explode(upstream_names(topics)).alias("topic"))
    return (enrich(wanted, ds_topics, on="_ds", how="inner")
            .select("date", "topic").distinct()
            .withColumn("dated_topic", dated_topic("topic", "date")))


def topics_of(datasets: DataFrame, producers: list[str], ds: str = "ds", topics: str = "topics") -> list[str]:
    """The distinct topics of a few producers, sorted: what :func:`dated_topics` gives for one date, for a
    processor's own list of producers (metadata: a handful of names)."""
    lists = datasets.where(F.col(ds).isin(producers)).select(F.explode(upstream_names(topics)).alias("t"))
    return sorted({r["t"] for r in lists.collect()})


def kafka_source_options(brokers: str, topics: list[str], date: str, max_offsets_per_trigger: int | None = None,
                         extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options of the Kafka source for one date: every topic suffixed with the date, earliest offsets
    when the query has no checkpoint yet (Spark ignores them on restart)."""
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(sorted({f"{t}-{date}" for t in topics if t})),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    opts.update(extra or {})
    return opts


def topic_names(topics: DataFrame, date: str) -> list[str]:
    """Topic names of one date from :func:`dated_topics` (metadata: a handful of names), sorted."""
    return sorted(r["topic"] for r in topics.where(F.col("date") == date).select("topic").distinct().collect())


def max_offsets_for_rate(rate_per_partition_sec: int, partitions: int, latency_min: int) -> int:
    """A per-partition-per-second cap turned into Spark's total cap per trigger."""
    return int(rate_per_partition_sec) * int(partitions) * 60 * int(latency_min)


def dated_folders(root: str, topics: list[str], date: str) -> str:
    """Glob over the folders of a date's topics: ``{root}/dated_topic={a-date,b-date}``."""
    names = sorted({f"{t}-{date}" for t in topics if t})
    if not names:
        raise ValueError("no topic to read")
    inner = f"{{{','.join(names)}}}" if len(names) > 1 else names[0]
    return f"{root.rstrip('/')}/{FOLDER_KEY}={inner}"


def files_within(spark: SparkSession, path: str, records: int) -> int:
    """Files that a micro-batch may take so that it holds at most ``records``: by the largest file that is there.
    A file over the cap is an error (it cannot be read in parts; :func:`write_dated_folders` takes a limit), and
    producers must not write larger ones later. Counted from the files' footers, one row per file."""
    if records <= 0:
        raise ValueError("the cap on records must be positive")
    # a pattern that matches nothing yet is no error for a stream, so neither here
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    if not found:
        return 1
    sizes = spark.read.schema(RECORD_SCHEMA).parquet(path).select(F.col("_metadata.file_path").alias("f")) \
        .groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 1
    if largest > records:
        raise ValueError(f"a file under {path} holds {largest} records, more than the {records} of a micro-batch")
    return records // largest


def read_dated_topics(spark: SparkSession, topics: list[str], date: str, brokers: str | None = None,
                      root: str | None = None, max_offsets_per_trigger: int | None = None,
                      max_files_per_trigger: int | None = None, stream: bool = True,
                      max_rate: int | None = None, partitions: int | None = None,
                      latency_min: int | None = None) -> DataFrame:
    """``(key BINARY, value STRING)`` records of the date's topics, as a stream (or a batch read).

    ``brokers``: Kafka. ``root``: one folder of parquet files per dated topic. ``max_rate``: records a second
    and partition; with ``partitions`` (of all topics together) and ``latency_min`` it gives the cap per
    trigger, ``max_offsets_per_trigger`` gives it as it is. For folders the cap is kept by whole files
    (:func:`files_within`)."""
    if max_rate is not None:
        if partitions is None or latency_min is None or max_offsets_per_trigger is not None:
            raise ValueError("max_rate needs partitions and latency_min, and no max_offsets_per_trigger")
        max_offsets_per_trigger = max_offsets_for_rate(max_rate, partitions, latency_min)
    if brokers:
        opts = kafka_source_options(brokers, topics, date, max_offsets_per_trigger)
        reader = spark.readStream if stream else spark.read
        if not stream:
            opts.pop("maxOffsetsPerTrigger", None)
        raw = reader.format("kafka").options(**opts).load()
        # the value decoder replaces invalid UTF-8 bytes, as a Java string decoder does
        return raw.select(F.col("key"), F.expr("make_valid_utf8(cast(value as string))").alias("value"))
    if not root:
        raise ValueError("give brokers or a root folder")
    path = dated_folders(root, topics, date)
    if stream and max_offsets_per_trigger is not None:
        fit = files_within(spark, path, max_offsets_per_trigger)
        max_files_per_trigger = fit if max_files_per_trigger is None else min(fit, max_files_per_trigger)
    if stream:
        if not re.search(r"[{\[*?]", path):
            path = f"{path[:-1]}[{path[-1]}]"  # a pattern: the folder of a date need not be there yet
        r = spark.readStream.schema(RECORD_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
        return r.parquet(path).select("key", "value")
    return spark.read.schema(RECORD_SCHEMA).parquet(path).select("key", "value")


def write_dated_folders(records: DataFrame, root: str, topic: str = "topic", date: str = "date",
                        records_per_file: int | None = None) -> None:
    """Lay records out as the file stand-in of dated topics: ``{root}/dated_topic={topic}-{date}/``.
    Used to feed tests from the driver tables (one write job for all folders). Rows are rebalanced by folder, so
    that a folder gets few files and a large one several tasks. ``records_per_file`` bounds each file."""
    out = records.withColumn("dated_topic", dated_topic(topic, date)).select("key", "value", "dated_topic") \
        .hint("rebalance", "dated_topic").write.mode("overwrite").partitionBy("dated_topic")
    (out.option("maxRecordsPerFile", int(records_per_file)) if records_per_file else out).parquet(root)
