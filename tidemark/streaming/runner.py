"""Run an algorithm over one date's stream, and over consecutive dates (STR-1..STR-4, STR-6, STR-7).

Per date: one Structured Streaming query with its own checkpoint folder, so ``batch_id`` restarts at
0 and is the in-day batch number. Each micro-batch (``foreachBatch``):

1. is skipped when the ledger already holds it from the same checkpoint (a replay after a crash between
   the ledger append and the offset commit; FLT-1). A ledger row from another checkpoint is an error:
   with a new checkpoint folder batch numbers start again with other records in them, and skipping
   would lose those;
2. is transformed by ``algo.per_batch`` and written as gzip text to ``{out}/{date}/{bb}00/data``
   with ``overwrite`` (a replayed batch rewrites the same folder), or routed by ``algo.route_by`` to
   ``{out}/date=../batch=../{key}=..`` as Parquet (SNK-3);
3. is published with one ledger row (SNK-4) -- data first, ledger last. The row names the batch's files
   (SRC-3) and carries the algorithm's counters, so that each batch counts once (AGG-5), and the versions of
   the lookups that it used (JON-1).

A source may be a function from a date to a stream of records, or another processor's published batches
(:class:`tidemark.sources.committed.CommittedSource`).

An exception in a batch ends the query; ``awaitTermination`` raises it and nothing is published for
that batch (STR-7). A rerun resumes from the checkpoint and replays the failed batch.

Day switch (STR-6): the upstream sync point is read *before* an ``availableNow`` pass; when it is at or
past the date, all its records are there, the pass reads them all, and the date is finished
(:func:`run_days`). A processing-time query (:func:`run_day_continuous`) is finished at an idle event
after such a sync read. Both go on from date to date (:func:`run_days_continuous`).
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.batches import batch_dir
from tidemark.operators.replay import next_day_text
from tidemark.sinks.batches import data_files, ledger_entry, publish_batch, write_batch, write_batch_by_key
from tidemark.streaming.algorithm import Algorithm


def checkpoint_for(base: str, date: str) -> str:
    """One checkpoint folder per date (STR-3)."""
    return f"{base.rstrip('/')}/{date}/checkpoint"


def trigger_for(latency_min: int | None) -> dict:
    """``processingTime`` every ``latency_min`` minutes (STR-1); ``None`` -> ``availableNow``."""
    if latency_min is None:
        return {"availableNow": True}
    if int(latency_min) <= 0:
        raise ValueError("latency must be a positive number of minutes")
    return {"processingTime": f"{int(latency_min)} minutes"}


@dataclass
class DayRun:
    date: str
    batches: list[int] = field(default_factory=list)
    rows: int = 0
    skipped: list[int] = field(default_factory=list)
    finished: bool = False
    timed_out: bool = False


Published = Callable[[str, int, str], None]


def _query_id(spark: SparkSession, ckpt: str) -> str:
    """Id of the streaming query that owns a checkpoint folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ckpt}/metadata")
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))["id"]
    finally:
        stream.close()


def _batch_writer(spark: SparkSession, algo: Algorithm, date: str, out_root: str, ledger_path: str,
                  ckpt: str, run: DayRun, expand: Callable[[DataFrame], DataFrame] | None = None,
                  on_published: Published | None = None) -> Callable[[DataFrame, int], None]:
    owner: list[str] = []

    def on_batch(df: DataFrame, batch_id: int) -> None:
        if not owner:  # the file is there by the first batch
            owner.append(_query_id(spark, ckpt))
        query_id = owner[0]
        have = ledger_entry(spark, ledger_path, algo.result, date, batch_id)
        if have is not None:
            if have["query_id"] != query_id:
                raise RuntimeError(f"batch {batch_id} of {algo.result} on {date} is published by checkpoint "
                                   f"{have['query_id']}; this one is {query_id}")
            run.skipped.append(batch_id)
            if on_published:
                on_published(date, batch_id, have["commit"])
            return
        out = algo.per_batch(date, batch_id, df if expand is None else algo.transform(date, expand(df)))
        obs = Observation(f"rows_{date}_{batch_id}")
        totals = algo.totals(date)
        counted = out.observe(obs, F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"total_{k}") for k, c in totals.items()])
        if algo.route_by:
            path = write_batch_by_key(counted, out_root, date, batch_id, key=algo.route_by)
        else:
            path = write_batch(counted, out_root, date, batch_id)
        got = obs.get
        n = int(got.get("n", 0))
        batch_time = int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1000)
        publish_batch(spark, ledger_path, algo.result, date, batch_id, batch_time, n, query_id,
                      data_files(spark, out_root, path), {k: int(got.get(f"total_{k}") or 0) for k in totals} or None,
                      algo.versions() or None)
        run.batches.append(batch_id)
        run.rows += n
        if on_published:
            on_published(date, batch_id, f"{batch_dir(date, batch_id)}/{batch_time}")
    return on_batch


def _start(spark: SparkSession, algo: Algorithm, date: str, source: Callable[[str], DataFrame], out_root: str,
           ledger_path: str, checkpoint_base: str, trigger: dict, run: DayRun, on_published: Published | None = None):
    ckpt = checkpoint_for(checkpoint_base, date)
    if not _has_checkpoint(spark, ckpt):
        algo.start_day(date)
    algo.start_query(date)
    expand = getattr(source, "expand", None)
    shaped = source(date) if expand else algo.transform(date, source(date))
    writer = _batch_writer(spark, algo, date, out_root, ledger_path, ckpt, run, expand, on_published)
    return (shaped.writeStream.foreachBatch(writer)
            .option("checkpointLocation", ckpt)
            .trigger(**trigger)
            .queryName(f"{algo.name}-{date}".replace("/", "_"))
            .start())


def run_day(spark: SparkSession, algo: Algorithm, date: str, source: Callable[[str], DataFrame],
            out_root: str, ledger_path: str, checkpoint_base: str, latency_min: int | None = None,
            timeout_sec: float | None = None, on_published: Published | None = None) -> DayRun:
    """Process ``date`` until the source has nothing more (``availableNow``) or ``timeout_sec``, which the
    returned run then says (``timed_out``).

    ``source(date)`` returns the streaming ``(key, value)`` DataFrame of the date's topics.
    ``on_published(date, batch, commit)`` is called after each batch is in the ledger, and again when a replay
    finds it there.
    """
    run = DayRun(date)
    q = _start(spark, algo, date, source, out_root, ledger_path, checkpoint_base, trigger_for(latency_min), run, on_published)
    try:
        if timeout_sec:
            run.timed_out = not q.awaitTermination(timeout_sec)
        else:
            q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    return run


class _IdleWatch(StreamingQueryListener):
    """Time (epoch seconds) of the last idle event of each query: a trigger that found no new data."""

    def __init__(self):
        super().__init__()
        self.idle: dict[str, float] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        ts = _dt.datetime.fromisoformat(str(event.timestamp).replace("Z", "+00:00")).timestamp()
        self.idle[str(event.id)] = ts

    def onQueryTerminated(self, event) -> None:
        pass


class ProgressLog(StreamingQueryListener):
    """Per-batch progress records of streaming queries (STR-8) in a table: ``onQueryProgress`` takes each
    record down, :meth:`flush` appends those taken down since to ``path`` (call it after a pass, or every
    so often beside a query that runs on)."""

    SCHEMA = ("query string, query_id string, batch_id bigint, num_input_rows bigint, timestamp string, "
              "observed map<string,bigint>")

    def __init__(self, path: str):
        super().__init__()
        self.path, self.pending = path, deque()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        metrics = {f"{name}.{k}": int(v) for name, row in (p.observedMetrics or {}).items()
                   for k, v in row.asDict().items() if isinstance(v, int)}
        self.pending.append((p.name, str(p.id), int(p.batchId), int(p.numInputRows), str(p.timestamp), metrics))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self, spark: SparkSession) -> int:
        """Append what is pending; returns the number of records."""
        rows = [self.pending.popleft() for _ in range(len(self.pending))]
        if rows:
            spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return len(rows)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(query, query_id, batch_id, num_input_rows, timestamp, observed)`` of all flushed records; ``observed``
        has the whole-number metrics as ``{observation}.{metric}``."""
        return spark.read.schema(self.SCHEMA).parquet(self.path)

    def with_ledger(self, spark: SparkSession, ledger: DataFrame) -> DataFrame:
        """``(proc, date, batch, num_input_rows, num_records)``: each published batch with the records that its
        query read for it, by (query id, batch). A batch that was tried more than once has its last progress."""
        rows = self.table(spark).groupBy("query_id", F.col("batch_id").cast("int").alias("batch")).agg(
            F.max_by("num_input_rows", F.struct("timestamp", "num_input_rows")).alias("num_input_rows"))
        return ledger.join(rows, ["query_id", "batch"], "left").select("proc", "date", "batch", "num_input_rows", "num_records")


def run_day_continuous(spark: SparkSession, algo: Algorithm, date: str, source: Callable[[str], DataFrame],
                       sync: Callable[[], str | None], out_root: str, ledger_path: str, checkpoint_base: str,
                       latency_min: int | None = None, trigger_seconds: int | None = None,
                       poll_sec: float = 1.0, timeout_sec: float | None = None,
                       on_published: Published | None = None) -> DayRun:
    """Process ``date`` with a processing-time trigger and stop once the date is finished (STR-6,
    continuous form): the sync point, read at time T, is at or past the date, and the query reports
    idle (a trigger found no new data) at a time after T. Waiting for an idle event later than the
    sync read closes the window where records land between an empty batch and the sync read.
    Idle events are throttled by ``spark.sql.streaming.noDataProgressEventInterval``."""
    run = DayRun(date)
    trigger = ({"processingTime": f"{int(trigger_seconds)} seconds"} if trigger_seconds
               else trigger_for(latency_min or 1))
    watch = _IdleWatch()
    spark.streams.addListener(watch)
    q = _start(spark, algo, date, source, out_root, ledger_path, checkpoint_base, trigger, run, on_published)
    started = time.time()
    try:
        armed_at = None
        while q.isActive:
            if timeout_sec and time.time() - started > timeout_sec:
                run.timed_out = True
                break
            if armed_at is None:
                mark = time.time()
                s = sync()
                if s is not None and s >= date:
                    armed_at = mark
            elif watch.idle.get(str(q.id), 0.0) > armed_at:
                run.finished = True
                break
            q.awaitTermination(poll_sec)
        if q.exception() is not None:
            raise q.exception()
    finally:
        if q.isActive:
            q.stop()
        spark.streams.removeListener(watch)
    return run


def run_days_continuous(spark: SparkSession, algo: Algorithm, start_date: str, source: Callable[[str], DataFrame],
                        sync: Callable[[], str | None], out_root: str, ledger_path: str, checkpoint_base: str,
                        on_finished: Callable[[str], None] | None = None, **options) -> Iterator[DayRun]:
    """:func:`run_day_continuous` for one date after another, each run given out as its date ends. Stops
    after a date that was not finished (its run says whether it timed out). ``on_finished(date)`` is called
    once a date is."""
    date = start_date
    while True:
        run = run_day_continuous(spark, algo, date, source, sync, out_root, ledger_path, checkpoint_base, **options)
        if run.finished and on_finished:
            on_finished(date)
        yield run
        if not run.finished:
            return
        date = _following(date)


def _has_checkpoint(spark: SparkSession, ckpt: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{ckpt}/offsets")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _following(date: str) -> str:
    nxt = next_day_text(date)
    if nxt is None:
        raise ValueError(f"cannot move past date {date!r}")
    return nxt


def run_days(spark: SparkSession, algo: Algorithm, start_date: str, source: Callable[[str], DataFrame],
             sync: Callable[[], str | None], out_root: str, ledger_path: str, checkpoint_base: str,
             stop_when_waiting: bool = True, poll_sec: float = 10.0, on_published: Published | None = None,
             on_finished: Callable[[str], None] | None = None) -> list[DayRun]:
    """Walk the dates from ``start_date`` with ``availableNow`` passes, as many dates as there are. A date is
    finished by a pass that began with ``sync() >= date``. With ``stop_when_waiting`` the walk returns when
    a pass of an unfinished date found nothing (a scheduler calls it again later); without, it looks again
    after ``poll_sec``. ``on_finished(date)`` is called once a date is finished."""
    date = start_date
    runs: list[DayRun] = []
    while True:
        sync_before = sync()
        run = run_day(spark, algo, date, source, out_root, ledger_path, checkpoint_base, on_published=on_published)
        runs.append(run)
        if sync_before is not None and sync_before >= date:
            run.finished = True
            if on_finished:
                on_finished(date)
            date = _following(date)
        elif not run.batches and not run.skipped:
            if stop_when_waiting:
                return runs
            time.sleep(poll_sec)
