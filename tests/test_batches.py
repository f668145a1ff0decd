"""Batches as data, sequence numbers, counters, partition append."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.batches import HOUR_US, batch_counts, batch_spine, batchify, failed_outputs, skip_committed
from tidemark.operators.metrics import fail_ratio, with_counters
from tidemark.operators.partitions import append_per_partition, append_rows, constants
from tidemark.operators.resume import resume_after, sequence_numbers


def _events(spark, rows):
    return spark.createDataFrame(rows, "p string, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_batchify_and_spine(spark):
    ev = _events(spark, [("a", "2024-01-01 00:30:00", 1.0), ("a", "2024-01-02 23:59:59", 2.0),
                         ("b", "2024-01-01 05:00:00", 3.0)])
    b = {r.v: (r.date, r.batch, r.batch_time) for r in batchify(ev, "ts", HOUR_US).collect()}
    assert b[1.0] == ("20240101", 0, 1704070800000)
    assert b[2.0][:2] == ("20240102", 23)
    spine = batch_spine(ev, "p", "ts", HOUR_US)
    assert {r.p: r.n for r in spine.groupBy("p").agg(F.count("*").alias("n")).collect()} == {"a": 48, "b": 24}


def test_batch_counts_include_empty(spark):
    ev = _events(spark, [("a", "2024-01-01 00:30:00", 1.0), ("a", "2024-01-01 00:40:00", 500.0),
                         ("a", "2024-01-01 03:00:00", 2.0)])
    c = batch_counts(ev, "p", "ts", HOUR_US, {"failed": F.max(F.when(F.col("v") > 100, 1).otherwise(0))})
    got = {r.batch: (r.num_records, r.failed) for r in c.collect()}
    assert len(got) == 24 and got[0] == (2, 1) and got[1] == (0, 0) and got[3] == (1, 0)


def test_failed_outputs_counts_empty_reason(spark):
    ops = spark.createDataFrame([(1, None), (1, ""), (1, "boom"), (2, None)], "b int, failure_reason string")
    assert {r.b: r.num_failed for r in failed_outputs(ops, ["b"]).collect()} == {1: 2, 2: 0}


def test_skip_committed(spark):
    batches = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1)], "proc string, batch_time long")
    ledger = spark.createDataFrame([("a", 1), ("a", 2)], "proc string, batch_time long")
    assert sorted(tuple(r) for r in skip_committed(batches, ledger).collect()) == [("a", 3), ("b", 1)]


def test_sequence_numbers_and_resume(spark):
    rows = [("a", f"2024-01-0{1 + i % 3} 0{i % 10}:00:00", float(i)) for i in range(30)] + [("b", "2024-01-01 00:00:00", 99.0)]
    ev = _events(spark, rows).withColumn("id", F.col("v").cast("long"))
    seq = sequence_numbers(ev, "p", "ts", ["id"])
    expect = {}
    for p in ("a", "b"):
        mine = sorted((r[1], int(r[2])) for r in rows if r[0] == p)
        for i, (_, mid) in enumerate(mine):
            expect[mid] = (p, i)
    assert {r.id: (r.p, r.seq) for r in seq.collect()} == expect
    counters = spark.createDataFrame([("a", 25)], "name string, value long")
    kept = resume_after(seq, "seq", counters, by="p")
    assert sorted((r.p, r.seq) for r in kept.collect()) == [("a", i) for i in range(25, 30)] + [("b", 0)]


def test_append_per_partition_counts(spark):
    df = spark.createDataFrame([("x",), ("y",)], "value string")
    out = append_per_partition(df, ["end", "checked", None], num_partitions=6)
    got = [r.value for r in out.collect()]
    assert sorted(got, key=repr) == sorted(["x", "y"] + 6 * ["end", "checked", None], key=repr)
    assert append_rows(df, constants(spark, ["end", None])).count() == 4


def test_fail_ratio_and_counters(spark):
    rep = spark.createDataFrame([("d", True), ("d", True), ("e", False)], "day string, failed boolean")
    got = {r.day: r.fail_ratio for r in fail_ratio(rep, ["day"]).collect()}
    assert abs(got["d"] - 2 / 2.01) < 1e-12 and got["e"] == 0.0
    df = spark.createDataFrame([(1,), (2,), (3,)], "b int")
    observed, obs = with_counters(df, "acc_test", acc=F.col("b"))
    observed.collect()
    assert obs.get["acc"] == 6


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_sequence_numbers_beside_payload_columns(spark, reuse):
    from pyspark.sql import Window

    from tidemark.session import session_conf

    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    with session_conf(spark, {"spark.sql.exchange.reuse": reuse}):
        seq = sequence_numbers(events, "event_type", "ts", ["event_id"])
        assert seq.columns == [*events.columns, "seq"]
        w = Window.partitionBy("event_type").orderBy("ts", "event_id")
        expect = events.select("event_id", (F.row_number().over(w) - 1).alias("want"))
        both = seq.join(expect, "event_id")
        assert both.count() == events.count() and both.where("seq <> want").count() == 0


def test_sequence_numbers_hot_key_brute_force(spark):
    import random
    rnd = random.Random(7)
    # one hot key with most rows, many timestamps shared (ties broken by id)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c", None]),
             f"2024-01-0{rnd.randint(1, 3)} {rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}:00", i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "p string, ts string, id long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.id: r.seq for r in sequence_numbers(df, "p", "ts", ["id"], num_partitions=16).collect()}
    expect = {}
    for key in {r[0] for r in rows}:  # a null key is numbered as one more key
        for i, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))):
            expect[r[2]] = i
    assert got == expect
