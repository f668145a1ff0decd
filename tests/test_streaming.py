"""Structured Streaming runner over dated folders built from the driver tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException

from tidemark.operators.metrics import with_counters
from tidemark.operators.partitions import append_per_partition
from tidemark.plans import fixtures as fx
from tidemark.sinks.batches import read_ledger
from tidemark.sources.committed import read_committed
from tidemark.sources.topics import read_dated_topics, write_dated_folders
from tidemark.streaming.algorithm import Algorithm, ValuesAlgorithm
from tidemark.streaming.runner import checkpoint_for, run_day, run_days, run_days_continuous, trigger_for

TOPICS = ["click", "error", "purchase", "signup", "view"]


class Marked(Algorithm):
    """Values with an end mark per partition, a counter per batch, and a failure on demand."""

    name, result = "marked", "marked_result"

    def __init__(self, fail_at=None, partitions=2):
        self.fail_at, self.partitions, self.counters, self.started = fail_at, partitions, {}, []

    def start_day(self, date):
        self.started.append(date)

    def transform(self, date, df):
        return df.select(F.expr("make_valid_utf8(cast(value as string))").alias("value"))

    def per_batch(self, date, batch_id, df):
        if batch_id == self.fail_at:
            raise OSError(f"injected failure in batch {batch_id}")
        out = append_per_partition(df, ["end"], self.partitions)
        observed, self.counters[(date, batch_id)] = with_counters(out, f"acc_{date}_{batch_id}", acc=F.lit(batch_id))
        return observed


@pytest.fixture(scope="module")
def topics_root(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="tidemark-topics-")
    events = fx.table(spark, "/root/testdata/sf0.001", "events")
    write_dated_folders(fx.stream_records(events), root)
    return root


def _source(spark, root):
    return lambda date: read_dated_topics(spark, TOPICS, date, root=root, max_files_per_trigger=1)


def test_trigger_and_checkpoint_paths():
    assert trigger_for(None) == {"availableNow": True}
    assert trigger_for(5) == {"processingTime": "5 minutes"}
    assert checkpoint_for("/c/", "20240101") == "/c/20240101/checkpoint"
    with pytest.raises(ValueError):
        trigger_for(0)


def test_failure_stops_then_rerun_resumes(spark, topics_root, tmp_dir):
    out, ledger, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt"
    algo = Marked(fail_at=3)
    with pytest.raises(StreamingQueryException, match="injected failure in batch 3"):
        run_day(spark, algo, "20240101", _source(spark, topics_root), out, ledger, ckpt)
    led = read_ledger(spark, ledger)
    assert sorted(r.batch for r in led.collect()) == [0, 1, 2]
    # counters: batch number added once per output record (end marks included)
    for b in (0, 1, 2):
        n = [r.num_records for r in led.where(F.col("batch") == b).collect()][0]
        assert algo.counters[("20240101", b)].get["acc"] == b * n
    algo.fail_at = None
    run = run_day(spark, algo, "20240101", _source(spark, topics_root), out, ledger, ckpt)
    assert run.batches == [3, 4]
    led = read_ledger(spark, ledger)
    assert sorted(r.batch for r in led.collect()) == [0, 1, 2, 3, 4]
    committed = read_committed(spark, out, led, proc="marked_result")
    events = fx.table(spark, "/root/testdata/sf0.001", "events").where(F.to_date("ts") == F.lit("2024-01-01"))
    # every record of the day once, plus one end mark per partition (2 partitions) per batch
    assert committed.count() == events.count() + 5 * 2
    assert algo.started == ["20240101"]  # not called again when resumed from the checkpoint
    # a rerun with nothing new runs no batch and writes nothing twice
    again = run_day(spark, algo, "20240101", _source(spark, topics_root), out, ledger, ckpt)
    assert again.batches == [] and read_ledger(spark, ledger).count() == 5


def test_day_loop_stops_on_unfinished_date(spark, topics_root, tmp_dir):
    algo = Marked()
    runs = run_days(spark, algo, "20240101", _source(spark, topics_root), sync=lambda: "20240102",
                    out_root=f"{tmp_dir}/out", ledger_path=f"{tmp_dir}/ledger", checkpoint_base=f"{tmp_dir}/ckpt")
    # finished dates take one pass, begun when upstream was past them; the unfinished date: a data pass
    # and an empty pass that waits (sync 20240102 < 20240103)
    assert [r.date for r in runs] == ["20240101", "20240102", "20240103", "20240103"]
    assert [r.rows > 0 for r in runs] == [True, True, True, False]
    assert [r.finished for r in runs] == [True, True, False, False]
    assert algo.started == ["20240101", "20240102", "20240103"]


def test_day_loop_walks_any_number_of_dates(spark, topics_root, tmp_dir):
    # far more dates than there are folders: a date without records is passed too
    runs = run_days(spark, ValuesAlgorithm(), "20240125", _source(spark, topics_root), sync=lambda: "20240324",
                    out_root=f"{tmp_dir}/out", ledger_path=f"{tmp_dir}/ledger", checkpoint_base=f"{tmp_dir}/ckpt")
    assert [r.finished for r in runs] == [True] * 60 + [False]
    assert (runs[0].date, runs[-1].date) == ("20240125", "20240325")


def test_lookup_refreshed_every_batch(spark, tmp_dir):
    from tidemark.streaming.algorithm import LookupAlgorithm

    root, lookup_path = f"{tmp_dir}/topics", f"{tmp_dir}/lookup"
    rec = lambda rows: spark.createDataFrame(rows, "k string, value string, topic string, date string") \
        .select(F.col("k").cast("binary").alias("key"), "value", "topic", "date")
    spark.createDataFrame([("1", "old")], "key_text string, label string").write.mode("overwrite").parquet(lookup_path)
    write_dated_folders(rec([("1", "a", "t", "20240101")]), root)
    algo = LookupAlgorithm(lookup_fn=lambda: spark.read.parquet(lookup_path))
    src = lambda date: read_dated_topics(spark, ["t"], date, root=root)
    out, ledger, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt"
    run_day(spark, algo, "20240101", src, out, ledger, ckpt)
    # the lookup changes and new records arrive: the next batch sees the new label
    spark.createDataFrame([("1", "new")], "key_text string, label string").write.mode("overwrite").parquet(lookup_path)
    rec([("1", "b", "t", "20240101")]).select("key", "value").write.mode("append") \
        .parquet(f"{root}/dated_topic=t-20240101")
    run_day(spark, algo, "20240101", src, out, ledger, ckpt)
    got = sorted(r.value for r in read_committed(spark, out, read_ledger(spark, ledger), proc="lookup_result").collect())
    assert got == ["a|old", "b|new"]


def test_continuous_day_stops_when_idle_and_upstream_done(spark, topics_root, tmp_dir):
    from tidemark.session import session_conf
    from tidemark.streaming.runner import run_day_continuous

    calls = []

    def sync():
        calls.append(1)
        return "20240101" if len(calls) > 2 else "20231231"  # upstream finishes the day later

    with session_conf(spark, {"spark.sql.streaming.noDataProgressEventInterval": "500ms"}):
        run = run_day_continuous(spark, Marked(), "20240101", _source(spark, topics_root),
                                 sync, f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt",
                                 trigger_seconds=1, poll_sec=0.5, timeout_sec=120)
    assert run.finished and run.batches == [0, 1, 2, 3, 4] and len(calls) >= 3


def test_continuous_days_roll_on(spark, topics_root, tmp_dir):
    from tidemark.session import session_conf

    with session_conf(spark, {"spark.sql.streaming.noDataProgressEventInterval": "500ms"}):
        runs = list(run_days_continuous(spark, ValuesAlgorithm(), "20240101", _source(spark, topics_root),
                                        lambda: "20240102", f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt",
                                        trigger_seconds=1, poll_sec=0.5, timeout_sec=20))
    assert [(r.date, r.finished, r.timed_out) for r in runs] == [
        ("20240101", True, False), ("20240102", True, False), ("20240103", False, True)]


def test_algorithm_transform_same_on_batch_and_stream(spark, topics_root, tmp_dir):
    algo = ValuesAlgorithm()
    batch = algo.transform("20240101", read_dated_topics(spark, TOPICS, "20240101", root=topics_root, stream=False))
    stream = algo.transform("20240101", read_dated_topics(spark, TOPICS, "20240101", root=topics_root))
    q = (stream.writeStream.format("parquet").option("path", f"{tmp_dir}/s")
         .option("checkpointLocation", f"{tmp_dir}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/s").collect())
    assert got == sorted(r.value for r in batch.collect()) and len(got) > 0


def test_progress_table_has_every_batch(spark, topics_root, tmp_dir):
    import time as _time

    from tidemark.streaming.runner import ProgressLog

    log, done = ProgressLog(f"{tmp_dir}/progress"), 0
    spark.streams.addListener(log)
    try:
        run = run_day(spark, Marked(), "20240102", _source(spark, topics_root),
                      f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt")
        deadline = _time.time() + 30  # listener events arrive asynchronously
        while done < len(run.batches) and _time.time() < deadline:
            done += log.flush(spark)
            _time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert log.flush(spark) == 0 or not log.pending
    t = log.table(spark)
    assert t.where("num_input_rows > 0").count() >= len(run.batches) == 5
    assert sorted(r.batch_id for r in t.where("num_input_rows > 0").collect())[:5] == [0, 1, 2, 3, 4]


def test_replayed_batch_after_crash_is_not_written_twice(spark, topics_root, tmp_dir):
    import os

    out, ledger, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt"
    algo = Marked()
    first = run_day(spark, algo, "20240103", _source(spark, topics_root), out, ledger, ckpt)
    assert first.batches == [0, 1, 2, 3, 4]
    # crash simulation: batch 4 was written and published, but its offsets were never committed
    commits = os.path.join(checkpoint_for(ckpt, "20240103"), "commits")
    for name in ("4", ".4.crc"):  # a crash before the commit leaves neither the entry nor its checksum
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))
    again = run_day(spark, algo, "20240103", _source(spark, topics_root), out, ledger, ckpt)
    assert again.skipped == [4] and again.batches == []
    assert sorted(r.batch for r in read_ledger(spark, ledger).collect()) == [0, 1, 2, 3, 4]


def test_new_checkpoint_does_not_skip_unread_batches(spark, tmp_dir):
    root, out, ledger = (f"{tmp_dir}/{n}" for n in ("topics", "out", "ledger"))
    rec = lambda rows: spark.createDataFrame(rows, "k string, value string, topic string, date string") \
        .select(F.col("k").cast("binary").alias("key"), "value", "topic", "date")
    write_dated_folders(rec([("1", "a", "t", "20240101")]), root)
    src = lambda date: read_dated_topics(spark, ["t"], date, root=root)
    run_day(spark, ValuesAlgorithm(), "20240101", src, out, ledger, f"{tmp_dir}/one")
    rec([("2", "b", "t", "20240101")]).select("key", "value").write.mode("append").parquet(f"{root}/dated_topic=t-20240101")
    # batch 0 of a new checkpoint holds other records than the published batch 0: an error, no silent loss
    with pytest.raises(StreamingQueryException, match="is published by checkpoint"):
        run_day(spark, ValuesAlgorithm(), "20240101", src, out, ledger, f"{tmp_dir}/two")
    run = run_day(spark, ValuesAlgorithm(), "20240101", src, out, ledger, f"{tmp_dir}/one")
    assert run.batches == [1]
    got = read_committed(spark, out, read_ledger(spark, ledger), proc="values_result")
    assert sorted(r.value for r in got.collect()) == ["a", "b"]
