"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` over the driver tables.

Each query runs an operator of the library over whole tables; :mod:`tidemark.plans.oracle` holds
the matching DuckDB SQL. Column names are the same on both sides. Queries that write files (sinks,
file sources) write to a fresh folder under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import batches as B
from tidemark.operators.enrich import enrich
from tidemark.operators.meta import current_meta, resume_from_ledger, resume_state, sync_at, sync_point
from tidemark.operators.metrics import counter_table, fail_ratio, with_counters
from tidemark.operators.partitions import append_per_partition, append_rows, constants
from tidemark.operators.replay import replay_ledger
from tidemark.operators.resume import resume_after, sequence_numbers
from tidemark.plans import fixtures as fx
from tidemark.session import materialize, scratch_dir, session_conf
from tidemark.sinks.batches import (latest_commits, ledger_from_replay, read_by_key, read_ledger, write_batches,
                                    write_by_key)
from tidemark.sinks.messages import prepare_messages
from tidemark.sinks.metalog import MetaLog
from tidemark.sources.committed import read_committed, read_committed_partitioned
from tidemark.sources.counters import encode_counter, read_counters, write_counter_files
from tidemark.sources.topics import dated_topics, read_dated_topics, topic_names, write_dated_folders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# ---- fixed parameters of the queries ---------------------------------------------------------
HASH_PARTITIONS = (7, 8, 12)
MESSAGE_PARTITIONS = 12
END_MARKS = ("end of partition", "checked")
# -----------------------------------------------------------------------------------------------


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events")


def _minute_of_day(ts: str = "ts"):
    return (F.hour(ts) * 60 + F.minute(ts)).cast("int")


# ---- STR-5 / STR-9 / AGG-4 / AGG-3 / FLT-1 / PRJ-8 ---------------------------------------------

@register("replay_ledger")
def q_replay_ledger(spark, sf_dir):
    """STR-5: batch log of every processor replayed through commit/switch/redo/abort/ignored."""
    return replay_ledger(*fx.replay_inputs(_events(spark, sf_dir)))


@register("batchify")
def q_batchify(spark, sf_dir):
    """STR-9: every event with its 1-hour batch (day, in-day number, batch end time)."""
    b = B.batchify(_events(spark, sf_dir).select("event_id", "event_type", "ts"), "ts", fx.BATCH_WIDTH_US)
    return b.select("event_id", "event_type", "batch_start_us", "date", "batch", "batch_time")


@register("batch_counts")
def q_batch_counts(spark, sf_dir):
    """AGG-4: records per processor batch, empty batches included."""
    c = B.batch_counts(_events(spark, sf_dir).select("event_type", "ts"), "event_type", "ts", fx.BATCH_WIDTH_US)
    return c.select(F.col("event_type").alias("proc"), "date", "batch", "batch_time", "num_records")


@register("batch_log")
def q_batch_log(spark, sf_dir):
    """AGG-4 + JON-2: the replay's input log (counts, failure flag, as-of upstream sync)."""
    return fx.batch_log(_events(spark, sf_dir))


@register("failed_outputs")
def q_failed_outputs(spark, sf_dir):
    """AGG-3: each event is an output operation of its hour batch; an `error` event's props are its
    failure reason."""
    ops = B.batchify(_events(spark, sf_dir).select("event_type", "props", "ts"), "ts", fx.BATCH_WIDTH_US)
    ops = ops.withColumn("failure_reason", F.when(F.col("event_type") == "error", F.col("props")))
    return B.failed_outputs(ops, ["date", "batch"])


@register("skip_committed")
def q_skip_committed(spark, sf_dir):
    """FLT-1: batches after each processor's last committed batch."""
    events = _events(spark, sf_dir)
    hourly = fx.per_batch(events)
    first = hourly.groupBy("proc").agg(F.min("batch_start_us").alias("batch_start_us")) \
        .select("proc", *B.batch_columns("batch_start_us", fx.BATCH_WIDTH_US)).select("proc", "batch_time")
    log = fx.batch_log(events, hourly=hourly).select("proc", "batch_time", "num_records")
    return B.skip_committed(log, first)


@register("batch_outcome")
def q_batch_outcome(spark, sf_dir):
    """PRJ-8: outcome of every logged batch against the processor's start state, and whether an empty
    batch was committed (delayed)."""
    log, start = fx.replay_inputs(_events(spark, sf_dir))
    log = enrich(log, start, on="proc", how="inner")
    out = log.select("proc", "batch_time", "num_records",
                     C.batch_outcome(F.lit(False), "batch_time", "commit_time", "num_records", "sync", "trace",
                                     "failed").alias("outcome"))
    return out.select("proc", "batch_time", "outcome", C.batch_delayed("outcome", "num_records").alias("delayed"))


# ---- PRJ-1..PRJ-7 --------------------------------------------------------------------------------

@register("record_value")
def q_record_value(spark, sf_dir):
    """PRJ-1: stream records with the key dropped and the value decoded."""
    return C.record_value(fx.stream_records(_events(spark, sf_dir)))


@register("sign64")
def q_sign64(spark, sf_dir):
    """PRJ-2: unsigned 64-bit fingerprints of the record key and of the event type."""
    ev = _events(spark, sf_dir)
    return ev.select("event_id", C.sign64(F.col("user_id").cast("string")).alias("key_sign"),
                     C.sign64("event_type").alias("type_sign"))


@register("hash_partition")
def q_hash_partition(spark, sf_dir):
    """PRJ-3: hash partition of the record key for 7, 8 and 12 partitions (unsigned remainder)."""
    key = F.col("user_id").cast("string")
    return _events(spark, sf_dir).select(
        "event_id", *[C.hash_partition(key, n).alias(f"p{n}") for n in HASH_PARTITIONS])


@register("assign_partition")
def q_assign_partition(spark, sf_dir):
    """PRJ-4: partition per partitioner setting: hash, random, a number, a negative number."""
    key = F.col("user_id").cast("string")
    return _events(spark, sf_dir).select(
        "event_id",
        C.partition_for("hash", key, MESSAGE_PARTITIONS).alias("part_hash"),
        C.partition_for("random", key).alias("part_random"),
        C.partition_for("3", key).alias("part_fixed"),
        C.partition_for("-1", key).alias("part_negative"),
    )


@register("parse_commit")
def q_parse_commit(spark, sf_dir):
    """PRJ-5: commit points of 10-minute batches (numbers 100+ cannot be read back) parsed."""
    ev = _events(spark, sf_dir)
    commit = C.commit_point(C.day_text("ts"), (_minute_of_day() / 10).cast("int"), "event_id")
    p = ev.select("event_id", commit.alias("commit")).withColumn("_p", C.parse_commit("commit"))
    return p.select("event_id", "commit", "_p.*")


@register("batch_path")
def q_batch_path(spark, sf_dir):
    """PRJ-6: batch folder and commit point of 1-minute batches (numbers up to 1439)."""
    ev = _events(spark, sf_dir).select("event_id", C.day_text("ts").alias("date"), _minute_of_day().alias("minute"))
    return ev.select("event_id", C.batch_path("date", "minute").alias("path"),
                     C.commit_point("date", "minute", "event_id").alias("commit"))


@register("next_day")
def q_next_day(spark, sf_dir):
    """PRJ-7: next calendar day of each event's date."""
    ev = _events(spark, sf_dir).select("event_id", C.day_text("ts").alias("date"))
    return ev.select("event_id", "date", C.next_day("date").alias("next_date"))


# ---- AGG-1 / AGG-2 / AGG-5 / AGG-6 / JON-2 / JON-3 ---------------------------------------------------

@register("current_meta")
def q_current_meta(spark, sf_dir):
    """AGG-6: current `latest` of every producer, last write wins."""
    return current_meta(fx.meta_history(_events(spark, sf_dir)), seq="seq")


def _user_processors(events: DataFrame) -> DataFrame:
    # each user is a processor whose upstreams are the event types it has (sorted, comma-joined)
    return events.groupBy(F.col("user_id").alias("proc")).agg(
        F.concat_ws(",", F.array_sort(F.collect_set("event_type"))).alias("upstreams"))


@register("sync_point")
def q_sync_point(spark, sf_dir):
    """AGG-1: minimum current `latest` over each user-processor's upstreams."""
    events = _events(spark, sf_dir)
    latest = current_meta(fx.meta_history(events), seq="seq").select("ds", F.col("value").alias("latest"))
    return sync_point(_user_processors(events), latest)


def _sync_at(spark, sf_dir) -> DataFrame:
    events = _events(spark, sf_dir)
    probes = events.select("event_id", F.col("event_type").alias("proc"), F.col("ts").alias("probe_time"))
    names = events.select(F.col("event_type").alias("ds")).distinct()
    upstreams = names.select(F.col("ds").alias("proc")).join(names, F.col("proc") != F.col("ds"))
    return sync_at(probes, fx.meta_history(events), upstreams=upstreams, tiebreak=["seq"])


@register("sync_at")
def q_sync_at(spark, sf_dir):
    """JON-2: at every event, the minimum as-of `latest` of the other processors' producers."""
    return _sync_at(spark, sf_dir)


@register("sync_at_broadcast")
def q_sync_at_broadcast(spark, sf_dir):
    """JON-2, an earlier name of `sync_at`: there is one plan for any probes."""
    return _sync_at(spark, sf_dir)


@register("sync_at_window")
def q_sync_at_window(spark, sf_dir):
    """JON-2, an earlier name of `sync_at`: there is one plan for any probes."""
    return _sync_at(spark, sf_dir)


@register("resume_state")
def q_resume_state(spark, sf_dir):
    """JON-3: start state of every user-processor from its sync point and the commit of its last event;
    users whose last event is a `signup` have committed nothing yet."""
    events = _events(spark, sf_dir)
    procs = _user_processors(events)
    latest = current_meta(fx.meta_history(events), seq="seq").select("ds", F.col("value").alias("latest"))
    sync = sync_point(procs, latest)
    last = events.groupBy(F.col("user_id").alias("proc")).agg(
        F.max_by(F.struct("ts", "event_id", "event_type"), F.struct("ts", "event_id")).alias("s"))
    commits = last.where("s.event_type <> 'signup'").select(
        "proc", C.commit_point(C.day_text("s.ts"), F.hour("s.ts"), "s.event_id").alias("commit"))
    return resume_state(procs, sync, commits)


@register("fail_ratio")
def q_fail_ratio(spark, sf_dir):
    """AGG-2: delivery failure ratio per day (`error` events as failed deliveries)."""
    ev = _events(spark, sf_dir).select(C.day_text("ts").alias("date"), (F.col("event_type") == "error").alias("failed"))
    return fail_ratio(ev, ["date"], "failed")


@register("with_counters")
def q_with_counters(spark, sf_dir):
    """AGG-5: counters observed while the events are written: the batch number added once per record, and
    the records. Read after the write, as a named accumulator would be."""
    b = B.batchify(_events(spark, sf_dir).select("event_type", "ts"), "ts", fx.BATCH_WIDTH_US)
    observed, counters = with_counters(b, "batch-counters", acc=F.col("batch"), records=F.lit(1))
    materialize(observed, "counted")
    got = counters.get
    return spark.createDataFrame([(got["acc"], got["records"])], "acc long, records long")


@register("counter_table")
def q_counter_table(spark, sf_dir):
    """AGG-5 as a table: the same counters per processor."""
    b = B.batchify(_events(spark, sf_dir).select("event_type", "ts"), "ts", fx.BATCH_WIDTH_US)
    return counter_table(b.withColumnRenamed("event_type", "proc"), ["proc"],
                         acc=F.col("batch"), records=F.lit(1))


# ---- JON-1 / FLT-2 / PRT-1 / PRT-2 ---------------------------------------------------------------

@register("enrich")
def q_enrich(spark, sf_dir):
    """JON-1: every event with its customer and nation (left join: unknown users stay)."""
    customer = fx.table(spark, sf_dir, "customer")
    nation = fx.table(spark, sf_dir, "nation")
    lookup = lambda: (customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
                      .select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment", "n_name"))
    return enrich(_events(spark, sf_dir).select("event_id", "user_id"), lookup, on="user_id")


def _counters(events: DataFrame) -> DataFrame:
    # records already sent per producer: those of the producer's first day
    day = F.to_date("ts")
    first = events.groupBy("event_type").agg(F.min(day).alias("_d"))
    # one row per producer: size-checked broadcast, so a hot producer is not one shuffle partition
    sent = enrich(events, first, on="event_type", how="inner").where(day == F.col("_d"))
    return sent.groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("value"))


@register("sequence_numbers")
def q_sequence_numbers(spark, sf_dir):
    """FLT-2: exact per-producer record numbers (0-based, by time then id) beside all columns of the
    events, without a per-key sort."""
    return sequence_numbers(_events(spark, sf_dir), "event_type", "ts", ["event_id"])


@register("resume_after")
def q_resume_after(spark, sf_dir):
    """FLT-2: records (all columns) at or after each producer's stored counter."""
    events = _events(spark, sf_dir)
    seq = sequence_numbers(events, "event_type", "ts", ["event_id"])
    return resume_after(seq, "seq", _counters(events), by="event_type")


@register("append_per_partition")
def q_append_per_partition(spark, sf_dir):
    """PRT-1: record values in as many partitions as the events have days, each with the end marks."""
    events = _events(spark, sf_dir)
    days = events.select(F.to_date("ts").alias("d")).where("d IS NOT NULL").distinct().count()
    return append_per_partition(fx.stream_records(events), END_MARKS, num_partitions=max(1, days))


@register("append_rows")
def q_append_rows(spark, sf_dir):
    """PRT-2: record values followed once by the end marks."""
    vals = C.record_value(fx.stream_records(_events(spark, sf_dir)))
    return append_rows(vals, constants(spark, END_MARKS))


# ---- SRC-1..SRC-4 / SNK-1..SNK-4 -----------------------------------------------------------------

@register("dated_topics")
def q_dated_topics(spark, sf_dir):
    """SRC-2: topics of the requested producers (regions -> their nations) for every event date; a date asks
    for the regions of the users (customers) that have events on it, in a list with an empty and a
    repeated name."""
    region = fx.table(spark, sf_dir, "region")
    nation = fx.table(spark, sf_dir, "nation")
    datasets = (region.join(nation, region.r_regionkey == nation.n_regionkey)
                .groupBy(F.col("r_name").alias("ds"))
                .agg(F.concat_ws(",", F.array_sort(F.collect_list("n_name"))).alias("topics")))
    customer = fx.table(spark, sf_dir, "customer")
    home = (customer.join(nation, customer.c_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey).select(F.col("c_custkey").alias("user_id"), "r_name"))
    requests = (_events(spark, sf_dir).select("user_id", C.day_text("ts").alias("date")).join(home, "user_id")
                .groupBy("date").agg(F.array_sort(F.collect_set("r_name")).alias("r"))
                .select("date", F.concat_ws(",", "r", F.lit(""), F.get("r", F.lit(0))).alias("producers")))
    return dated_topics(datasets, requests)


@register("prepare_messages")
def q_prepare_messages(spark, sf_dir):
    """SNK-1: the frame the Kafka sink receives (key, value, dated topic, hash partition); key and
    value shown decoded."""
    rec = fx.stream_records(_events(spark, sf_dir))
    msgs = prepare_messages(rec, F.concat_ws("-", "topic", "date"), partitioner="hash",
                            num_partitions=MESSAGE_PARTITIONS)
    return msgs.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                       "topic", "partition")


def _datasets(events: DataFrame) -> DataFrame:
    # each producer writes one topic of its own name
    return materialize(events.where("event_type IS NOT NULL").select(
        F.col("event_type").alias("ds"), F.col("event_type").alias("topics")).distinct(), "datasets")


@register("run_days")
def q_run_days(spark, sf_dir):
    """STR-3, STR-4, STR-6, SNK-2, SNK-4, SRC-3, UDF-1: a processor of all producers walks the dates from
    the day after their first announcements to the first date they have not all finished; its published
    batches are read back."""
    from tidemark.streaming.algorithm import ValuesAlgorithm
    from tidemark.streaming.processor import run_processor

    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "run-days")
    out, ledger = f"{base}/out", f"{base}/ledger"
    names, log, at_start = _announced(spark, events, base)
    write_dated_folders(fx.stream_records(events), f"{base}/topics")
    algo = ValuesAlgorithm(resource=names)
    run_processor(spark, algo, None, _datasets(events), lambda t, date: read_dated_topics(spark, t, date, root=f"{base}/topics"),
                  out, ledger, f"{base}/checkpoints", latest_at_start=at_start, log=log)
    return read_committed(spark, out, read_ledger(spark, ledger), proc=algo.result)


def _announced(spark: SparkSession, events: DataFrame, base: str) -> tuple[str, MetaLog, DataFrame]:
    """The producers' names, their announcements in a metadata log, and their first ones."""
    meta = materialize(fx.meta_history(events), "announcements")
    log = MetaLog(spark, f"{base}/meta")
    log.append(meta)
    at_start = materialize(meta.groupBy("ds").agg(F.min_by("value", F.struct("updated_at", "seq")).alias("latest")), "at-start")
    names = meta.agg(F.concat_ws(",", F.array_sort(F.collect_set("ds"))).alias("n")).first()["n"]
    return names, log, at_start


@register("read_dated_topics")
def q_read_dated_topics(spark, sf_dir):
    """SRC-1 (folder stand-in): records laid out per dated topic, read back for all dates; the topics are
    those that the producers' metadata names."""
    root = scratch_dir(spark, "dated-topics")
    events = _events(spark, sf_dir)
    write_dated_folders(fx.stream_records(events), root)
    asked = events.groupBy(F.lit("*").alias("date")).agg(F.concat_ws(",", F.collect_set("event_type")).alias("producers"))
    got = read_dated_topics(spark, topic_names(dated_topics(_datasets(events), asked), "*"), "*", root=root, stream=False)
    return got.select(F.col("key").cast("string").alias("key"), "value")


@register("write_by_key")
def q_write_by_key(spark, sf_dir):
    """SNK-3: values routed to one output per event type, read back with their key."""
    path = scratch_dir(spark, "by-key")
    rec = fx.stream_records(_events(spark, sf_dir)).select(F.col("topic").alias("event_type"), "value")
    write_by_key(rec, path, key="event_type")
    return read_by_key(spark, path, key="event_type")


@register("committed_batches")
def q_committed_batches(spark, sf_dir):
    """SNK-2 + SNK-4 + SRC-3: every hour batch written as gzip text, the replay's commits published
    to a ledger, and only published batches read back."""
    events = _events(spark, sf_dir)
    root = scratch_dir(spark, "batches")
    ledger_path = scratch_dir(spark, "ledger")
    b = B.batchify(events.select(F.col("event_type").alias("proc"), "ts", "value"), "ts", fx.BATCH_WIDTH_US)
    write_batches(b, root, ["proc", "date", "batch"])
    replayed = replay_ledger(*fx.replay_inputs(events))
    # ledger rows name the batch by its hour slot (the folder it was written to): batch end - width
    ledger = (ledger_from_replay(replayed)
              .withColumn("_slot", F.expr(f"batch_time * 1000 - {fx.BATCH_WIDTH_US}"))
              .select("proc", *B.batch_columns("_slot", fx.BATCH_WIDTH_US)[:2], "batch_time"))
    ledger.write.mode("overwrite").parquet(ledger_path)
    return read_committed_partitioned(spark, root, spark.read.parquet(ledger_path))


@register("ledger_latest")
def q_ledger_latest(spark, sf_dir):
    """SNK-4 + AGG-6: ledger of the replay's commits, reduced to each processor's last commit point."""
    events = _events(spark, sf_dir)
    replayed = replay_ledger(*fx.replay_inputs(events))
    return latest_commits(ledger_from_replay(replayed))


@register("resume_from_ledger")
def q_resume_from_ledger(spark, sf_dir):
    """JON-3 from the ledger's integer columns: where each processor restarts after the replayed run."""
    events = _events(spark, sf_dir)
    replayed = replay_ledger(*fx.replay_inputs(events))
    procs = events.select(F.col("event_type").alias("proc")).distinct()
    no_sync = procs.select("proc", F.lit(None).cast("string").alias("sync"))
    return resume_from_ledger(procs, no_sync, ledger_from_replay(replayed))


@register("read_counters")
def q_read_counters(spark, sf_dir):
    """SRC-4: one counter file per producer (records sent) plus a stale `.tmp` twin (one record
    behind); the real file wins."""
    events = _events(spark, sf_dir)
    folder = scratch_dir(spark, "counters")
    # one counter file per producer: a handful of rows reach the driver to be written as files
    totals = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    files = {}
    for row in totals.collect():
        files[row["event_type"]] = encode_counter(row["n"])
        files[row["event_type"] + ".tmp"] = encode_counter(max(0, row["n"] - 1))
    write_counter_files(spark, folder, files)
    names = events.select(F.col("event_type").alias("name")).distinct()
    return read_counters(spark, folder, names)


# ---- STR-5 streaming form --------------------------------------------------------------------------

LOG_STREAM_CHUNK_MS = 10 * 86_400_000  # the log arrives in 10-day files, oldest first
STATE_PARTITIONS = 8  # state-store partitions of the streaming replay (processors spread over them)


@register("replay_ledger_stream")
def q_replay_ledger_stream(spark, sf_dir):
    """STR-5 streaming: the batch log arrives as time-ordered files (one per micro-batch) and is
    replayed with per-processor state; the result equals the batch replay."""
    from tidemark.streaming.stateful import replay_stream

    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "replay-stream")
    staged_path, src, out, ckpt = (f"{base}/{n}" for n in ("staged", "log", "out", "checkpoint"))
    log, start = fx.replay_inputs(events)
    log.withColumn("_chunk", F.floor(F.col("batch_time") / F.lit(LOG_STREAM_CHUNK_MS))) \
        .write.parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    bounds = staged.agg(F.min("_chunk").alias("lo"), F.max("_chunk").alias("hi")).first()
    if bounds["lo"] is not None:
        for c in range(int(bounds["lo"]), int(bounds["hi"]) + 1):
            # one file per time range, appended in time order: the file source reads oldest first
            staged.where(F.col("_chunk") == c).drop("_chunk").coalesce(1).write.mode("append").parquet(src)
    log_schema = staged.drop("_chunk").schema
    stream = spark.readStream.schema(log_schema).option("maxFilesPerTrigger", 1).parquet(src)
    # state partitions are fixed when the query first starts: one group per processor, so size them
    # to the processors rather than to the session's shuffle default
    with session_conf(spark, {"spark.sql.shuffle.partitions": str(STATE_PARTITIONS)}):
        q = (replay_stream(stream, materialize(start, "start-state")).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(
        "proc string, batch_time bigint, trace string, batch_num int, outcome string").parquet(out)


from tidemark.plans import stream_queries  # noqa: E402, F401  (registers the queries that run streams)
