"""Registered queries that run streams: every one reads the whole of ``events``, laid out as dated topics.

Most run one date whose topics hold all events in several files, so that there are several micro-batches; the
chained processors walk all dates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators.batches import day_of_micros
from tidemark.operators.enrich import VersionedLookup
from tidemark.operators.meta import sync_at
from tidemark.operators.resume import HighWater, number_batch
from tidemark.plans import fixtures as fx
from tidemark.plans.queries import _announced, _datasets, _events, register
from tidemark.session import materialize, scratch_dir
from tidemark.sinks.batches import counter_totals, read_ledger
from tidemark.sinks.metalog import MetaLog
from tidemark.sources.committed import CommittedSource, read_committed, read_routed
from tidemark.sources.topics import read_dated_topics, write_dated_folders
from tidemark.streaming.aggregates import current_rows, fail_ratios, keep_table, windowed_failures
from tidemark.streaming.algorithm import Algorithm, PinnedLookupAlgorithm, ValuesAlgorithm
from tidemark.streaming.live import LiveAsof, tagged
from tidemark.streaming.processor import run_processor
from tidemark.streaming.runner import ProgressLog, run_day, run_day_continuous

# ---- fixed parameters of the queries ---------------------------------------------------------
ONE_DAY = "20240101"  # the date under which a query lays out all events
CHUNKS = 4  # parts of the time span, in order, that arrive one after another
FILES = 6  # files of the date's topics, taken a few at a time
# -----------------------------------------------------------------------------------------------


@register("current_meta_log")
def q_current_meta_log(spark, sf_dir):
    """SNK-4, AGG-6: the producers' announcements as deltas of a metadata log; its current values before a
    compaction, after it, and with deltas after the snapshot."""
    history = fx.meta_history(_events(spark, sf_dir))
    log = MetaLog(spark, scratch_dir(spark, "meta-log"))
    for part in range(3):  # a write for each third of the announcements, in no order of time
        log.append(history.where(F.pmod("seq", F.lit(3)) == part))
    before = log.read()
    log.compact()
    after = log.read()
    older = history.where(F.pmod("seq", F.lit(2)) == 0)  # announcements that come again change nothing
    log.append(older)
    frames = [f.select(F.lit(stage).alias("stage"), "ds", "field", "value", "updated_at")
              for stage, f in (("before", before), ("after", after), ("more", log.read()))]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register("chained_processors")
def q_chained_processors(spark, sf_dir):
    """SRC-3, SNK-4, STR-6: a processor of all producers and a second one that follows it: it reads the first
    one's published batches through the ledger and goes on when the metadata log says that a date is finished."""
    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "chained")
    names, log, at_start = _announced(spark, events, base)
    write_dated_folders(fx.stream_records(events), f"{base}/topics")
    first = ValuesAlgorithm(resource=names, result="first/values")
    ledger = f"{base}/ledger"
    run_processor(spark, first, None, _datasets(events), lambda t, date: read_dated_topics(spark, t, date, root=f"{base}/topics"),
                  f"{base}/first", ledger, f"{base}/first-checkpoints", latest_at_start=at_start, log=log)
    second = ValuesAlgorithm(name="second", resource=first.result, result="second/values")
    source = CommittedSource(spark, f"{base}/first", ledger, first.result)
    start = at_start.agg(F.min("latest").alias("latest")).select(F.lit(first.result).alias("ds"), "latest")
    run_processor(spark, second, None, None, source, f"{base}/second", ledger, f"{base}/second-checkpoints",
                  latest_at_start=start, log=log)
    # what the second one has finished: the last date of the first one is still open
    done = log.read().where((F.col("ds") == second.result) & (F.col("field") == "latest")).select(F.col("value").alias("done"))
    got = read_committed(spark, f"{base}/second", read_ledger(spark, ledger), proc=second.result)
    return got.join(done, got.date <= done.done).select("date", "value")


def _as_one_day(spark: SparkSession, records: DataFrame, base: str, files: int = FILES) -> str:
    """All records under one date, its topics in several files; returns the folder."""
    rows = records.select("key", "value").repartition(files)
    rows.write.parquet(f"{base}/topics/dated_topic=all-{ONE_DAY}")
    return f"{base}/topics"


@dataclass
class RoutedValues(Algorithm):
    """Values routed by the record's key, null values and line feeds among them."""

    name: str = "routed"
    result: str = "routed/values"
    route_by: str | None = "key"

    def transform(self, date: str, df: DataFrame) -> DataFrame:
        return df.select(F.col("key").cast("string").alias("key"), "value")


@register("routed_batches")
def q_routed_batches(spark, sf_dir):
    """SNK-3 per micro-batch: values routed to one output per event type under the ledger's commit; large ones
    are null, the others have a line feed."""
    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "routed")
    value = F.when(F.col("value") > 100, None).otherwise(F.concat(F.lit("v\n"), F.col("value").cast("string")))
    topics = _as_one_day(spark, events.select(F.col("event_type").cast("binary").alias("key"), value.alias("value")), base)
    algo = RoutedValues()
    run_day(spark, algo, ONE_DAY, lambda date: read_dated_topics(spark, ["all"], date, root=topics, max_files_per_trigger=2),
            f"{base}/out", f"{base}/ledger", f"{base}/checkpoints")
    return read_routed(spark, f"{base}/out", read_ledger(spark, f"{base}/ledger"), algo.result).select("key", "value")


@dataclass
class NumberedEvents(Algorithm):
    """Numbers the events of each type on from batch to batch."""

    name: str = "numbered"
    result: str = "numbered/events"
    marks: HighWater | None = None

    def transform(self, date: str, df: DataFrame) -> DataFrame:
        return df.select(F.from_json("value", "event_type string, event_id bigint, us bigint").alias("e")).select("e.*")

    def per_batch(self, date: str, batch_id: int, df: DataFrame) -> DataFrame:
        done = number_batch(df, "event_type", "us", ["event_id"], self.marks, date, batch_id)
        return done.select(F.to_json(F.struct("event_type", "event_id", "seq")).alias("value"))


@register("numbered_batches")
def q_numbered_batches(spark, sf_dir):
    """FLT-2 over micro-batches: the events arrive in parts, oldest first; each type's are numbered on from
    batch to batch."""
    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "numbered")
    us = F.expr(C.epoch_micros_sql("ts", events.schema["ts"].dataType))
    rows = events.select(F.lit(None).cast("binary").alias("key"), us.alias("us"),
                         F.to_json(F.struct("event_type", "event_id", us.alias("us"))).alias("value"))
    span = rows.agg(F.min("us").alias("lo"), F.max("us").alias("hi")).first()
    width = ((span["hi"] or 0) - (span["lo"] or 0)) // CHUNKS + 1
    part = F.expr(f"coalesce((us - {span['lo'] or 0}) div {width}, -1)")
    topic = f"{base}/topics/dated_topic=all-{ONE_DAY}"
    rows.withColumn("part", part).hint("rebalance", "part").write.partitionBy("part").parquet(f"{base}/parts")
    algo = NumberedEvents(marks=HighWater(spark, f"{base}/marks", "event_type"))
    for k in range(-1, CHUNKS):  # a part arrives when the one before it has been taken up; rows without a time first
        arrived = spark.read.parquet(f"{base}/parts").where(F.col("part") == k).select("key", "value")
        arrived.write.mode("append").parquet(topic)
        run_day(spark, algo, ONE_DAY, lambda date: read_dated_topics(spark, ["all"], date, root=f"{base}/topics"),
                f"{base}/out", f"{base}/ledger", f"{base}/checkpoints")
    got = read_committed(spark, f"{base}/out", read_ledger(spark, f"{base}/ledger"), algo.result)
    return got.select(F.from_json("value", "event_type string, event_id bigint, seq bigint").alias("e")).select("e.*")


@dataclass
class CountedValues(ValuesAlgorithm):
    """Values with two counters per batch."""

    def totals(self, date: str) -> dict:
        return {"records": F.lit(1), "long": (F.octet_length("value") > 5).cast("int")}


@register("ledger_counters")
def q_ledger_counters(spark, sf_dir):
    """AGG-5 exactly once: counters of each micro-batch in its ledger row, summed over all batches."""
    base = scratch_dir(spark, "counted")
    records = fx.stream_records(_events(spark, sf_dir)).select("key", F.coalesce("value", F.lit("")).alias("value"))
    topics = _as_one_day(spark, records, base)
    run_day(spark, CountedValues(), ONE_DAY,
            lambda date: read_dated_topics(spark, ["all"], date, root=topics, max_files_per_trigger=2),
            f"{base}/out", f"{base}/ledger", f"{base}/checkpoints")
    return counter_totals(read_ledger(spark, f"{base}/ledger"))


@register("pinned_lookup")
def q_pinned_lookup(spark, sf_dir):
    """JON-1 with versions: every event's value with its customer's name, from a lookup pinned by the query."""
    base = scratch_dir(spark, "lookup")
    lookup = VersionedLookup(spark, f"{base}/customers")
    customer = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key_text"),
                                                          F.col("c_name").alias("label"))
    lookup.publish(customer.withColumn("label", F.lit("an old name")))
    lookup.publish(customer)
    topics = _as_one_day(spark, fx.stream_records(_events(spark, sf_dir)), base)
    algo = PinnedLookupAlgorithm(lookup=lookup, refresh="query")
    run_day(spark, algo, ONE_DAY, lambda date: read_dated_topics(spark, ["all"], date, root=topics, max_files_per_trigger=3),
            f"{base}/out", f"{base}/ledger", f"{base}/checkpoints")
    ledger = read_ledger(spark, f"{base}/ledger")
    return read_committed(spark, f"{base}/out", ledger, algo.result).select("value")


@register("stream_fail_ratio")
def q_stream_fail_ratio(spark, sf_dir):
    """AGG-2, AGG-3 over a stream: failures per day kept up to date while the events arrive in no order."""
    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "failures")
    us = C.epoch_micros_sql("ts", events.schema["ts"].dataType)
    rows = events.select("event_type", F.expr(f"timestamp_micros({us})").alias("at"))
    rows.repartition(FILES, "at", "event_type").write.parquet(f"{base}/events")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/events")
    # files hold rows of all times: no row is later than the whole span of an archive
    kept = windowed_failures(stream, "at", F.col("event_type") == "error", [], delay="36500 days")
    query = keep_table(kept, f"{base}/table", f"{base}/checkpoint")
    query.awaitTermination()
    current = current_rows(spark, f"{base}/table", ["start"])
    return fail_ratios(current.withColumn("date", day_of_micros(F.unix_micros("start"))), ["date"])


@register("live_sync")
def q_live_sync(spark, sf_dir):
    """JON-2 live: `sync_at` inside a stream. Events and announcements arrive in micro-batches of a quarter of the
    time span each, in no order within one; answered are the probes that the watermark has passed."""
    events = _events(spark, sf_dir)
    base = scratch_dir(spark, "live")
    us = C.epoch_micros_sql("ts", events.schema["ts"].dataType)
    named = events.select("event_id", F.col("event_type").alias("proc"), F.col("ts").alias("probe_time"), F.expr(us).alias("us"),
                          F.date_format(F.date_sub(F.to_date("ts"), 1), "yyyyMMdd").alias("day_before"))
    span = named.agg(F.min("us").alias("lo"), F.max("us").alias("hi")).first()
    width = ((span["hi"] or 0) - (span["lo"] or 0)) // CHUNKS + 1
    part = F.expr(f"coalesce((us - {span['lo'] or 0}) div {width}, 0)")
    named.withColumn("part", part).hint("rebalance", "part").write.partitionBy("part").parquet(f"{base}/parts")
    names = materialize(named.select(F.col("proc").alias("ds")).where("ds is not null").distinct(), "names")
    upstreams = names.select(F.col("ds").alias("proc")).join(names, F.col("proc") != F.col("ds"))

    def answer(probes, history):
        return sync_at(probes, history, probe_time="us", upstreams=upstreams, updated_at="updated_us", tiebreak=["seq"])

    live = LiveAsof(spark, f"{base}/live", answer, ["ds"], ["updated_us", "seq"], delay_us=width // 2)
    parts = spark.read.parquet(f"{base}/parts")
    schema = parts.drop("part").schema
    for k in range(CHUNKS):
        arrived = parts.where(F.col("part") == k).drop("part")
        arrived.repartition("event_id").write.mode("append").parquet(f"{base}/arrived")  # as many files as its size asks for
        read = spark.readStream.schema(schema).parquet(f"{base}/arrived")
        history = read.select(F.col("proc").alias("ds"), F.col("day_before").alias("value"), F.col("us").alias("updated_us"),
                              F.col("event_id").alias("seq"))
        both = tagged(read.select("event_id", "proc", "probe_time", "us"), history, F.col("us"), F.col("updated_us"))
        live.start(both, f"{base}/checkpoint").awaitTermination()
    done = live.answers(finished=True)
    return done.drop("us")


@dataclass
class FailsOnce(ValuesAlgorithm):
    """Values; one batch fails at its first attempt."""

    result: str = "resumed/values"
    fail_at: int | None = 1

    def per_batch(self, date: str, batch_id: int, df: DataFrame) -> DataFrame:
        if batch_id == self.fail_at:
            self.fail_at = None
            raise OSError(f"batch {batch_id} fails on purpose")
        return df


@register("failed_and_resumed")
def q_failed_and_resumed(spark, sf_dir):
    """STR-7, FLT-1: a batch fails, nothing of it is published and the query ends; the next run goes on from the
    checkpoint. Every event is published once."""
    from pyspark.errors import StreamingQueryException

    base = scratch_dir(spark, "resumed")
    topics = _as_one_day(spark, fx.stream_records(_events(spark, sf_dir)), base)
    algo, failures = FailsOnce(), 0
    for _ in range(2):
        try:
            run_day(spark, algo, ONE_DAY, lambda date: read_dated_topics(spark, ["all"], date, root=topics, max_files_per_trigger=2),
                    f"{base}/out", f"{base}/ledger", f"{base}/checkpoints")
        except StreamingQueryException:
            failures += 1
    got = read_committed(spark, f"{base}/out", read_ledger(spark, f"{base}/ledger"), algo.result)
    return got.select("value", F.lit(failures).alias("failures"))


@register("capped_batches")
def q_capped_batches(spark, sf_dir):
    """STR-2 for files: all events under a cap on the records of a micro-batch."""
    base = scratch_dir(spark, "capped")
    records = fx.stream_records(_events(spark, sf_dir)).withColumn("date", F.lit(ONE_DAY)).withColumn("topic", F.lit("all"))
    count = records.count()
    limit = max(1, count // 5)
    write_dated_folders(records, f"{base}/topics", records_per_file=max(1, limit // 2))
    run_day(spark, ValuesAlgorithm(), ONE_DAY,
            lambda date: read_dated_topics(spark, ["all"], date, root=f"{base}/topics", max_offsets_per_trigger=limit),
            f"{base}/out", f"{base}/ledger", f"{base}/checkpoints")
    ledger = read_ledger(spark, f"{base}/ledger")
    return ledger.agg(F.sum("num_records").alias("records"), (F.max("num_records") <= limit).alias("within_cap"))


@register("continuous_day")
def q_continuous_day(spark, sf_dir):
    """STR-1, STR-6, STR-8: all events by a processing-time query that ends when upstream is done and it is
    idle; the progress records agree with the ledger."""
    import time

    from tidemark.session import session_conf

    base = scratch_dir(spark, "continuous")
    topics = _as_one_day(spark, fx.stream_records(_events(spark, sf_dir)), base)
    log = ProgressLog(f"{base}/progress")
    spark.streams.addListener(log)
    try:
        with session_conf(spark, {"spark.sql.streaming.noDataProgressEventInterval": "500ms"}):
            run = run_day_continuous(
                spark, ValuesAlgorithm(), ONE_DAY,
                lambda date: read_dated_topics(spark, ["all"], date, root=topics, max_files_per_trigger=3),
                lambda: ONE_DAY, f"{base}/out", f"{base}/ledger", f"{base}/checkpoints", trigger_seconds=1, poll_sec=0.5,
                timeout_sec=1800)
        told, until = 0, time.time() + 30
        while told < len(run.batches) and time.time() < until:  # progress events arrive a little later
            told += log.flush(spark)
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    both = log.with_ledger(spark, read_ledger(spark, f"{base}/ledger"))
    return both.agg(F.sum("num_records").alias("records"), F.sum("num_input_rows").alias("num_input_rows")) \
        .withColumn("finished", F.lit(run.finished))
