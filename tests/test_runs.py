"""What a run keeps beside its values: manifests, counters, routed output, numbers, lookups, caps."""

import os
from dataclasses import dataclass

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.operators.enrich import VersionedLookup
from tidemark.operators.resume import HighWater, number_batch
from tidemark.sinks.batches import (counter_totals, data_files, ledger_entry, publish_batch, read_ledger, write_batch,
                                    write_batch_by_key)
from tidemark.sinks.metalog import MetaLog
from tidemark.sources.committed import CommittedSource, read_committed, read_routed
from tidemark.sources.topics import files_within, read_dated_topics, write_dated_folders
from tidemark.streaming.aggregates import current_rows, fail_ratios, keep_table, windowed_failures
from tidemark.streaming.algorithm import Algorithm, PinnedLookupAlgorithm, ValuesAlgorithm
from tidemark.streaming.processor import run_processor
from tidemark.streaming.runner import checkpoint_for, run_day

DAY = "20240101"


def _records(spark, rows):
    return spark.createDataFrame(rows, "k string, value string, topic string, date string") \
        .select(F.col("k").cast("binary").alias("key"), "value", "topic", "date")


def _arrive(spark, root, values, date=DAY, topic="t"):
    """One more file of a dated topic."""
    rows = _records(spark, [(str(i), v, topic, date) for i, v in enumerate(values)])
    rows.select("key", "value").coalesce(1).write.mode("append").parquet(f"{root}/dated_topic={topic}-{date}")


def _source(spark, root, topic="t"):
    return lambda date: read_dated_topics(spark, [topic], date, root=root, max_files_per_trigger=1)


def _forget_commit(base, batch, date=DAY):
    """As after a crash between the ledger's row and the stream's own commit."""
    commits = os.path.join(checkpoint_for(base, date), "commits")
    for name in (str(batch), f".{batch}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))


@dataclass
class Counted(ValuesAlgorithm):
    result: str = "streams/values"  # a name that a folder's name must escape

    def totals(self, date):
        return {"records": F.lit(1), "letters": F.length("value")}


def test_names_with_a_slash_are_found_on_replay_and_by_another_checkpoint(spark, tmp_dir):
    root, out, ledger = (f"{tmp_dir}/{n}" for n in ("topics", "out", "ledger"))
    _arrive(spark, root, ["a", "b"])
    assert run_day(spark, Counted(), DAY, _source(spark, root), out, ledger, f"{tmp_dir}/one").batches == [0]
    assert ledger_entry(spark, ledger, "streams/values", DAY, 0)["num_records"] == 2
    _forget_commit(f"{tmp_dir}/one", 0)
    assert run_day(spark, Counted(), DAY, _source(spark, root), out, ledger, f"{tmp_dir}/one").skipped == [0]
    with pytest.raises(StreamingQueryException, match="is published by checkpoint"):
        run_day(spark, Counted(), DAY, _source(spark, root), out, ledger, f"{tmp_dir}/two")
    assert read_ledger(spark, ledger).count() == 1


@pytest.mark.parametrize("proc", ["p", "a/b", "x=y", "50%", "", "a b", "é:ü", "[z]{1,2}*"])
def test_any_name_has_its_ledger_rows(spark, tmp_dir, proc):
    publish_batch(spark, f"{tmp_dir}/ledger", proc, DAY, 3, 1, 1, "q", files=["f"], counters={"n": 2}, versions={"l": 0})
    row = ledger_entry(spark, f"{tmp_dir}/ledger", proc, DAY, 3)
    assert row["files"] == ["f"] and row["counters"] == {"n": 2} and row["versions"] == {"l": 0}
    rows = CommittedSource(spark, f"{tmp_dir}/out", f"{tmp_dir}/ledger", proc)(DAY)
    q = rows.writeStream.format("memory").queryName("seen").trigger(availableNow=True) \
        .option("checkpointLocation", f"{tmp_dir}/c").start()
    q.awaitTermination()
    assert [r.batch for r in spark.table("seen").collect()] == [3]


def test_counters_count_a_replayed_batch_once(spark, tmp_dir):
    totals = []
    for crash in (False, True):
        root, out, ledger, ckpt = (f"{tmp_dir}/{crash}/{n}" for n in ("topics", "out", "ledger", "ckpt"))
        for values in (["a", "bb"], ["ccc"], ["", "dddd"]):
            _arrive(spark, root, values)
            run_day(spark, Counted(), DAY, _source(spark, root), out, ledger, ckpt)
        if crash:
            _forget_commit(ckpt, 2)
            assert run_day(spark, Counted(), DAY, _source(spark, root), out, ledger, ckpt).skipped == [2]
        totals.append(sorted(tuple(r) for r in counter_totals(read_ledger(spark, ledger)).collect()))
    assert totals[0] == totals[1] == [("streams/values", "letters", 10), ("streams/values", "records", 5)]


def test_only_published_files_are_opened(spark, tmp_dir):
    root, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    for batch, value in ((0, "a"), (1, "never published"), (2, "c")):
        path = write_batch(spark.createDataFrame([(value,)], "value string"), root, DAY, batch)
        if batch != 1:
            publish_batch(spark, ledger, "p", DAY, batch, 1, 1, "q", data_files(spark, root, path))
    # a file that a crashed attempt left beside a published batch's own
    write_batch(spark.createDataFrame([("stray",)], "value string"), f"{tmp_dir}/stray", DAY, 0)
    stray = data_files(spark, f"{tmp_dir}/stray", f"{tmp_dir}/stray")[0]
    os.link(f"{tmp_dir}/stray/{stray}", f"{root}/{DAY}/0000/data/part-99999-stray.txt.gz")
    got = read_committed(spark, root, read_ledger(spark, ledger), "p")
    assert sorted(tuple(r) for r in got.collect()) == [(DAY, 0, "a"), (DAY, 2, "c")]
    assert all("stray" not in f and "/0100/" not in f for f in got.inputFiles())
    assert read_committed(spark, root, read_ledger(spark, ledger), "nobody").count() == 0


def test_a_follower_gets_each_published_batch_once(spark, tmp_dir):
    root, out, ledger = (f"{tmp_dir}/{n}" for n in ("topics", "out", "ledger"))
    first = Counted()
    source = CommittedSource(spark, out, ledger, first.result, batches_per_trigger=1)
    second = ValuesAlgorithm(name="second", result="second")
    follow = lambda: run_day(spark, second, DAY, source, f"{tmp_dir}/two", ledger, f"{tmp_dir}/ckpt2")
    assert follow().batches == []  # nothing is published yet
    for values in (["a", "b"], ["c"]):
        _arrive(spark, root, values)
        run_day(spark, first, DAY, _source(spark, root), out, ledger, f"{tmp_dir}/ckpt")
    write_batch(spark.createDataFrame([("lost",)], "value string"), out, DAY, 7)  # written, not published
    assert follow().batches == [0, 1]
    _arrive(spark, root, ["d"])
    run_day(spark, first, DAY, _source(spark, root), out, ledger, f"{tmp_dir}/ckpt")
    assert follow().batches == [2] and follow().batches == []
    got = read_committed(spark, f"{tmp_dir}/two", read_ledger(spark, ledger), "second")
    assert sorted(r.value for r in got.collect()) == ["a", "b", "c", "d"]


def test_chained_processors_follow_each_other_by_the_log(spark, tmp_dir):
    root, ledger = f"{tmp_dir}/topics", f"{tmp_dir}/ledger"
    log = MetaLog(spark, f"{tmp_dir}/meta")
    tell = lambda day: log.append(spark.sql(f"SELECT 'up' ds, 'latest' field, '{day}' value, current_timestamp() updated_at"))
    datasets = spark.createDataFrame([("up", "t")], "ds string, topics string")
    first, second = Counted(resource="up"), ValuesAlgorithm(name="second", resource="streams/values", result="second")
    start = spark.createDataFrame([("up", "20231231"), ("streams/values", "20231231")], "ds string, latest string")

    def run():
        one = run_processor(spark, first, None, datasets, lambda t, d: read_dated_topics(spark, t, d, root=root),
                            f"{tmp_dir}/one", ledger, f"{tmp_dir}/c1", latest_at_start=start, log=log)
        two = run_processor(spark, second, None, None, CommittedSource(spark, f"{tmp_dir}/one", ledger, first.result),
                            f"{tmp_dir}/two", ledger, f"{tmp_dir}/c2", latest_at_start=start, log=log)
        return [[r.date for r in x if r.finished] for x in (one, two)]

    _arrive(spark, root, ["a"], "20240101")
    tell("20231231")
    assert run() == [[], []]
    _arrive(spark, root, ["b"], "20240102")
    tell("20240101")
    assert run() == [["20240101"], ["20240101"]]
    tell("20240102")
    assert run() == [["20240102"], ["20240102"]]
    now = {(r.ds, r.field): r.value for r in log.read().collect()}
    assert now["second", "latest"] == "20240102" and now["streams/values", "batch_latest"] == "20240102/0000"
    got = read_committed(spark, f"{tmp_dir}/two", read_ledger(spark, ledger), "second")
    assert sorted((r.date, r.value) for r in got.collect()) == [("20240101", "a"), ("20240102", "b")]


def test_routed_batches_keep_values_and_replace_an_earlier_attempt(spark, tmp_dir):
    rows = [("k", "x\ny"), ("k", None), ("k", ""), ("", "empty key"), (None, "no key"), ("a/b", "é"), ("@", "mark"), ("007", " ")]
    df = spark.createDataFrame(rows, "key string, value string")
    root, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    write_batch_by_key(df.withColumn("key", F.lit("gone")), root, DAY, 0)  # an attempt that was not published
    path = write_batch_by_key(df, root, DAY, 0)
    publish_batch(spark, ledger, "p", DAY, 0, 1, len(rows), "q", data_files(spark, root, path))
    write_batch_by_key(df, root, DAY, 1)  # not published
    got = read_routed(spark, root, read_ledger(spark, ledger), "p")
    assert sorted(((r.key, r.value) for r in got.collect()), key=repr) == sorted(rows, key=repr)
    assert got.select("date", "batch").distinct().collect() == [(DAY, 0)]
    assert read_routed(spark, root, read_ledger(spark, ledger), "nobody").count() == 0


def test_numbers_go_on_over_batches_and_replays(spark, tmp_dir):
    marks = HighWater(spark, f"{tmp_dir}/marks", "k", full_every=2)
    batches = [[("a", 1, 1), ("a", 2, 2), (None, 5, 3)], [("b", 1, 4), ("a", 0, 5)], [(None, 1, 6), ("a", 9, 7)], [("c", 1, 8)],
               [("a", 3, 9), ("b", 7, 10), ("c", 1, 11)]]
    dates = [(DAY, 0), (DAY, 1), (DAY, 10), ("20240102", 0), ("20240103", 0)]
    number = lambda i: sorted(((r.id, r.seq) for r in number_batch(
        spark.createDataFrame(batches[i], "k string, t long, id long"), "k", "t", ["id"], marks, *dates[i]).collect()))
    want, high = [], {}
    for rows in batches:
        out = []
        for k, _, i in sorted(rows, key=lambda r: (r[1], r[2])):
            out.append((i, high.get(k, 0)))
            high[k] = high.get(k, 0) + 1
        want.append(sorted(out))
    got = [number(0), number(1), number(2)]
    assert number(1) == got[1]  # a replay, also of a batch that others have followed
    got += [number(3), number(4)]
    assert got == want and [number(i) for i in (4, 2, 0)] == [want[i] for i in (4, 2, 0)]
    assert any(n.endswith("-all") for n in os.listdir(f"{tmp_dir}/marks"))
    os.makedirs(f"{tmp_dir}/marks/{HighWater.position('20240102', 5)}-all")  # a crash while marks were written
    assert number(4) == want[4]
    with pytest.raises(ValueError):
        HighWater.position("2024", 1)


@pytest.mark.parametrize("refresh", ["batch", "query"])
def test_lookups_are_pinned(spark, tmp_dir, refresh):
    root, ledger = f"{tmp_dir}/topics", f"{tmp_dir}/ledger"
    lookup = VersionedLookup(spark, f"{tmp_dir}/lookup")
    with pytest.raises(ValueError, match="no version"):
        lookup.newest()
    publish = lambda label: lookup.publish(spark.createDataFrame([("0", label)], "key_text string, label string"))
    publish("old")

    class Changing(PinnedLookupAlgorithm):
        def per_batch(self, date, batch_id, df):
            out = super().per_batch(date, batch_id, df)
            publish(f"after {batch_id}")  # a new version while the query runs
            return out

    for value in ("x", "y"):
        _arrive(spark, root, [value])
    algo = Changing(lookup=lookup, refresh=refresh)
    assert run_day(spark, algo, DAY, _source(spark, root), f"{tmp_dir}/out", ledger, f"{tmp_dir}/c").batches == [0, 1]
    used = {r.batch: r.versions for r in read_ledger(spark, ledger).collect()}
    assert used == {0: {"pinned-lookup": 0}, 1: {"pinned-lookup": 0 if refresh == "query" else 1}}
    got = sorted(r.value.split("|")[1] for r in read_committed(spark, f"{tmp_dir}/out", read_ledger(spark, ledger), algo.result).collect())
    assert got == (["old", "old"] if refresh == "query" else ["after 0", "old"])
    assert lookup.read(0).first()["label"] == "old" and lookup.newest() == 2


def test_no_micro_batch_exceeds_the_cap(spark, tmp_dir):
    rows = _records(spark, [(str(i), str(i), "t" if i % 3 else "u", DAY) for i in range(100)])
    write_dated_folders(rows, f"{tmp_dir}/topics", records_per_file=10)
    source = lambda date: read_dated_topics(spark, ["t", "u"], date, root=f"{tmp_dir}/topics", max_rate=1, partitions=1,
                                            latency_min=1)
    run = run_day(spark, ValuesAlgorithm(), DAY, source, f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/c")
    counts = [r.num_records for r in read_ledger(spark, f"{tmp_dir}/ledger").collect()]
    assert run.rows == sum(counts) == 100 and max(counts) <= 60 and len(counts) >= 2
    with pytest.raises(ValueError, match="more than the 5"):
        read_dated_topics(spark, ["t"], DAY, root=f"{tmp_dir}/topics", max_offsets_per_trigger=5)
    assert files_within(spark, f"{tmp_dir}/topics/dated_topic=nothing", 5) == 1
    with pytest.raises(ValueError, match="positive"):
        files_within(spark, f"{tmp_dir}/topics", 0)


def test_streamed_failures_and_late_rows(spark, tmp_dir):
    schema = "at timestamp, kind string, failed boolean"
    src = f"{tmp_dir}/events"

    def arrive(*rows):
        spark.sql("SELECT * FROM VALUES " + ", ".join(f"(TIMESTAMP'{t}', '{k}', {f})" for t, k, f in rows)) \
            .toDF("at", "kind", "failed").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        kept = windowed_failures(stream, "at", F.col("failed"), ["kind"], delay="1 day")
        keep_table(kept, f"{tmp_dir}/table", f"{tmp_dir}/c").awaitTermination()

    arrive(("2024-01-01 05:00:00", "a", "true"), ("2024-01-01 06:00:00", "a", "null"), ("2024-01-02 01:00:00", "b", "false"))
    arrive(("2024-01-05 00:00:00", "a", "false"), ("2024-01-01 07:00:00", "a", "true"))  # within a day of the latest seen so far
    arrive(("2024-01-01 08:00:00", "a", "true"), ("2024-01-05 02:00:00", "a", "true"))  # the first is too late now
    got = current_rows(spark, f"{tmp_dir}/table", ["kind", "start"])
    rows = sorted((r.kind, str(r.start)[:10], r.total, r.failed) for r in got.collect())
    assert rows == [("a", "2024-01-01", 3, 2), ("a", "2024-01-05", 2, 1), ("b", "2024-01-02", 1, 0)]
    ratio = {r.kind: r.fail_ratio for r in fail_ratios(got, ["kind"]).collect()}
    assert ratio["a"] == pytest.approx(3 / 5.01) and ratio["b"] == 0


def test_an_algorithm_without_more_leaves_the_row_bare(spark, tmp_dir):
    _arrive(spark, f"{tmp_dir}/topics", ["a"])
    run_day(spark, ValuesAlgorithm(), DAY, _source(spark, f"{tmp_dir}/topics"), f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/c")
    row = read_ledger(spark, f"{tmp_dir}/ledger").first()
    assert row["counters"] is None and row["versions"] is None and len(row["files"]) == 1
    assert Algorithm().totals(DAY) == {} and Algorithm().versions() == {}


def test_live_asof_answers_what_the_watermark_has_passed(spark, tmp_dir):
    from tidemark.operators.meta import sync_at
    from tidemark.streaming.live import LiveAsof, tagged

    upstreams = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "a")], "proc string, ds string")
    answer = lambda p, h: sync_at(p, h, probe_time="us", upstreams=upstreams, updated_at="at", tiebreak=["seq"])
    live = LiveAsof(spark, f"{tmp_dir}/live", answer, ["ds"], ["at", "seq"], delay_us=10)
    probes, history = "proc string, us bigint, n int", "ds string, value string, at bigint, seq bigint"

    def batch(number, p, h):
        p, h = spark.createDataFrame(p, probes), spark.createDataFrame(h, history)
        live.on_batch(tagged(p, h, F.col("us"), F.col("at")), number)

    told = lambda finished=False: sorted(((r.proc, r.n, r.sync) for r in live.answers(finished).collect()), key=repr)
    assert live.answers() is None and live.late() is None
    batch(0, [("p", 5, 1), ("p", 21, 2), (None, 3, 9)], [("a", "1", 4, 0), ("b", "2", 5, 1), ("a", "3", 20, 2)])
    assert told() == [("p", 1, "1"), (None, 9, None)]  # the watermark is 11
    batch(1, [("q", 15, 3), ("p", 2, 4), ("p", None, 5)], [("b", "0", 14, 3), ("a", "x", 10, 4), ("a", "4", 35, 5)])
    want = [("p", 1, "1"), ("p", 2, "0"), ("q", 3, "1"), (None, 9, None)]
    assert told() == sorted(want, key=repr)
    batch(1, [("q", 30, 7)], [])  # a replay changes nothing
    assert told() == sorted(want, key=repr)
    assert live.late().count() == 2  # a probe and a history row before the watermark of batch 0
    batch(2, [], [])
    rest = [r for r in told(True) if r[1] != 5]  # the probe without a time is answered last, as in a batch
    assert rest == sorted(want, key=repr) and len(told(True)) == len(want) + 1
    carried = live._read(live.log.read(2), "carried")
    assert sorted((r.ds, r.value) for r in carried.collect()) == [("a", "3"), ("b", "0")]  # one row a key
