"""Sources and sinks: batch folders and the ledger, counter files, routed output, Kafka options."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.batches import publish_batch, read_by_key, read_ledger, write_batch, write_by_key
from tidemark.sinks.messages import kafka_sink_options, prepare_messages
from tidemark.sources.committed import read_batches, read_committed
from tidemark.sources.counters import encode_counter, read_counters
from tidemark.sources.topics import (dated_folders, dated_topics, kafka_source_options, max_offsets_for_rate,
                                     read_dated_topics, write_dated_folders)


def test_write_batch_and_read_committed(spark, tmp_dir):
    root, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    for b in (0, 1, 2):
        write_batch(df.withColumn("value", F.concat("value", F.lit(str(b)))), root, "20240101", b)
    assert os.path.isdir(f"{root}/20240101/0100/data")
    for b in (0, 2):  # batch 1 was written but never published
        publish_batch(spark, ledger, "proc", "20240101", b, 1000 + b, 2)
    led = read_ledger(spark, ledger)
    # another processor's row for batch 1 in the same ledger does not publish this one's batch 1
    publish_batch(spark, ledger, "other", "20240101", 1, 5000, 2)
    led = read_ledger(spark, ledger)
    got = sorted(tuple(r) for r in read_committed(spark, root, led, proc="proc").collect())
    assert got == [("20240101", 0, "a0"), ("20240101", 0, "b0"), ("20240101", 2, "a2"), ("20240101", 2, "b2")]
    assert read_batches(spark, root).count() == 6
    # overwrite keeps a replayed batch idempotent
    write_batch(df, root, "20240101", 2)
    assert read_committed(spark, root, led, proc="proc", date="20240101").where("batch = 2").count() == 2


def _write(path, data):
    with open(path, "wb") as f:
        f.write(data)


def test_read_counters_edges(spark, tmp_dir):
    d = f"{tmp_dir}/counters"
    os.makedirs(d)
    _write(f"{d}/five", encode_counter(5))
    _write(f"{d}/max", b"\xff\xff\xff\xff")
    _write(f"{d}/empty", b"")
    _write(f"{d}/short", b"\x00\x01\x02")
    _write(f"{d}/tmponly.tmp", encode_counter(7))
    _write(f"{d}/both", encode_counter(9))
    _write(f"{d}/both.tmp", encode_counter(10))
    _write(f"{d}/emptyreal", b"")
    _write(f"{d}/emptyreal.tmp", encode_counter(3))
    names = spark.createDataFrame([("five",), ("fresh",)], "name string")
    got = {r.name: (r.value, r.error) for r in read_counters(spark, d, names).collect()}
    assert got["five"] == (5, None)
    assert got["max"] == (4294967295, None)
    assert got["empty"] == (0, None)
    assert got["short"][0] is None and "3 bytes" in got["short"][1]
    assert got["tmponly"] == (7, None)
    assert got["both"] == (9, None)
    assert got["emptyreal"] == (0, None)
    assert got["fresh"] == (0, None)
    with pytest.raises(ValueError):
        encode_counter(1 << 32)


def test_write_by_key_routes_values(spark, tmp_dir):
    rows = [("k1", "a"), ("k1", "b"), ("x/y", "c"), (None, "d"), ("ключ", "e"), ("\U0001F600", "f")]
    df = spark.createDataFrame(rows, "key string, value string")
    write_by_key(df, f"{tmp_dir}/routed", num_partitions=4)
    got = [(r.key, r.value) for r in read_by_key(spark, f"{tmp_dir}/routed").collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)


def test_dated_topics_and_options(spark):
    datasets = spark.createDataFrame([("ASIA", "t1,t2"), ("EUROPE", "t2,t3,"), ("OTHER", "t9")], "ds string, topics string")
    req = spark.createDataFrame([("20240101", "ASIA,EUROPE,,ASIA")], "date string, producers string")
    got = sorted(r.dated_topic for r in dated_topics(datasets, req).collect())
    assert got == ["t1-20240101", "t2-20240101", "t3-20240101"]
    o = kafka_source_options("b:9092", ["t2", "t1", "", "t1"], "20240101", max_offsets_for_rate(10, 4, 5))
    assert o["subscribe"] == "t1-20240101,t2-20240101" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == str(10 * 4 * 60 * 5)
    s = kafka_sink_options("b:9092", {"topic.acks": "all", "global.linger.ms": "5", "other": "x",
                                      "extension.queue.full.waiting.ms": "2500"})
    assert s == {"kafka.bootstrap.servers": "b:9092", "kafka.max.block.ms": "2500", "kafka.acks": "all",
                 "kafka.linger.ms": "5"}
    with pytest.raises(ValueError):
        kafka_sink_options("b", {"extension.queue.full.waiting.ms": "-1"})
    assert dated_folders("/r", ["a"], "d") == "/r/dated_topic=a-d"


def test_prepare_messages_schema(spark):
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    m = prepare_messages(df, "t", partitioner="hash", num_partitions=3)
    assert [f.dataType.simpleString() for f in m.schema] == ["binary", "binary", "string", "int"]


def test_read_dated_topics_file_source(spark, tmp_dir):
    rec = spark.createDataFrame([("1", "a", "t", "20240101"), ("2", "b", "u", "20240101"), ("3", "c", "t", "20240102")],
                                "k string, value string, topic string, date string") \
        .select(F.col("k").cast("binary").alias("key"), "value", "topic", "date")
    write_dated_folders(rec, f"{tmp_dir}/topics")
    got = sorted(r.value for r in read_dated_topics(spark, ["t", "u"], "20240101", root=f"{tmp_dir}/topics",
                                                    stream=False).collect())
    assert got == ["a", "b"]
    stream = read_dated_topics(spark, ["t"], "20240102", root=f"{tmp_dir}/topics", max_files_per_trigger=1)
    assert stream.isStreaming


def test_kafka_paths_target_the_kafka_format(spark):
    # the connector is not in this environment: both paths must reach the kafka format with their options
    with pytest.raises(Exception, match="(?i)kafka"):
        read_dated_topics(spark, ["t"], "20240101", brokers="localhost:9", stream=True)
    from tidemark.sinks.messages import write_messages
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(Exception, match="(?i)kafka"):
        write_messages(df, "localhost:9", "t-20240101", props={"extension.partitioner": "random"})


def test_write_by_key_gives_every_key_back_as_it_was(spark, tmp_dir):
    rows = [("", "a"), (None, "b"), ("k", "c"), ("007", "d"), ("1.0", "e"), ("2024-01-01", "f"), ("@", "g"), ("@x", "h"),
            ("true", "i"), ("1e3", "j"), ("__HIVE", "k")]
    write_by_key(spark.createDataFrame(rows, "key string, value string"), f"{tmp_dir}/r")
    got = [(r.key, r.value) for r in read_by_key(spark, f"{tmp_dir}/r").collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)


def test_ledger_entry_and_compaction(spark, tmp_dir):
    from tidemark.sinks.batches import compact_ledger, latest_commits, ledger_entry

    path = f"{tmp_dir}/ledger"
    for batch, clock in ((0, 300), (1, 200), (2, 100)):  # a clock that runs backwards
        publish_batch(spark, path, "p", "20240101", batch, clock, 1, query_id="q")
    assert ledger_entry(spark, path, "p", "20240101", 1)["query_id"] == "q"
    assert ledger_entry(spark, path, "p", "20240101", 3) is None
    assert ledger_entry(spark, path, "p", "20240102", 0) is None
    compact_ledger(spark, path, f"{tmp_dir}/compact")
    led = read_ledger(spark, f"{tmp_dir}/compact")
    assert led.count() == 3 and latest_commits(led).first()["commit"] == "20240101/0200/100"


def test_max_rate_sets_the_cap_per_trigger(spark):
    with pytest.raises(ValueError, match="max_rate"):
        read_dated_topics(spark, ["t"], "20240101", root="/nowhere", max_rate=5)
