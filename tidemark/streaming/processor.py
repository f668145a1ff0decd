"""A processor from its metadata: where it starts, which topics it reads, when a date is over.

These are the pieces that :mod:`tidemark.streaming.runner` takes as arguments, put together from the
metadata table, the producers' topics and the processor's own ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.batches import batch_dir
from tidemark.operators.meta import resume_from_ledger, sync_point
from tidemark.sinks.batches import LEDGER_SCHEMA, read_ledger
from tidemark.sinks.metalog import LatestReader, MetaLog
from tidemark.sources.topics import topics_of
from tidemark.streaming.algorithm import Algorithm
from tidemark.streaming.runner import DayRun, run_days, run_days_continuous


def upstream_sync(spark: SparkSession, algo: Algorithm, latest: DataFrame) -> str | None:
    """The day that every producer in ``algo.resource`` has finished, by ``latest(ds, latest)``."""
    me = spark.createDataFrame([(algo.result, algo.resource)], "proc string, upstreams string")
    return sync_point(me, latest).first()["sync"]


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return read_ledger(spark, path) if there else spark.createDataFrame([], LEDGER_SCHEMA)


def start_date(spark: SparkSession, algo: Algorithm, latest: DataFrame, ledger_path: str) -> str:
    """The date to go on with: that of the last batch in the ledger, or the day after the upstream sync."""
    me = spark.createDataFrame([(algo.result, upstream_sync(spark, algo, latest))], "proc string, sync string")
    row = resume_from_ledger(me, me, _ledger(spark, ledger_path).where(F.col("proc") == algo.result)).first()
    if row["error"]:
        raise ValueError(f"{algo.result}: {row['error']}")
    return row["trace"]


class Publisher:
    """Puts a processor's progress into the metadata log, so that others can follow it: after each batch
    ``batch_latest`` (``{date}/{bb}00``) and ``commit``, after each finished date ``latest`` (the date). Each is a
    last write, so a replay changes nothing. The log is compacted after every ``compact_every`` deltas."""

    def __init__(self, log: MetaLog, proc: str, compact_every: int = 64):
        self.log, self.proc, self.compact_every = log, proc, compact_every

    def _put(self, **fields: str) -> None:
        number = self.log.put(self.proc, fields)
        if (number + 1) % self.compact_every == 0:
            self.log.compact()

    def published(self, date: str, batch: int, commit: str) -> None:
        self._put(batch_latest=batch_dir(date, batch), commit=commit)

    def finished(self, date: str) -> None:
        self._put(latest=date)


def run_processor(spark: SparkSession, algo: Algorithm, latest: Callable[[], DataFrame] | None, datasets: DataFrame | None,
                  source: Callable[..., DataFrame], out_root: str, ledger_path: str,
                  checkpoint_base: str, latest_at_start: DataFrame | None = None, log: MetaLog | None = None,
                  continuous: bool = False, **options) -> list[DayRun]:
    """:func:`tidemark.streaming.runner.run_days` for one processor; with ``continuous``
    :func:`tidemark.streaming.runner.run_days_continuous` (whose ``timeout_sec`` ends it).

    ``latest()``: the current ``(ds, latest)`` of the producers, read anew for every pass
    (``latest_at_start``: as it was when the processor was first started). ``datasets(ds, topics)``: the
    producers' topics. ``source(topics, date)``: the stream over topics of a date; or another processor's
    batches (:class:`tidemark.sources.committed.CommittedSource`), for which no ``datasets`` are needed.

    ``log``: the metadata as a log. Then ``latest`` may be None: the upstreams' days are followed in the log,
    reading its newest snapshot once and only new deltas after that, and the processor's own progress is
    published there.
    """
    names = sorted({n for n in algo.resource.split(",") if n})
    reader = LatestReader(log, names) if log is not None and latest is None else None
    if latest_at_start is None:
        latest_at_start = latest() if reader is None else spark.createDataFrame(
            list(reader.latest().items()), "ds string, latest string")
    first = start_date(spark, algo, latest_at_start, ledger_path)

    def stream(date: str) -> DataFrame:
        return source(topics_of(datasets, names), date)

    sync = reader.sync if reader else lambda: upstream_sync(spark, algo, latest())
    if log is not None:
        own = Publisher(log, algo.result)
        options = {"on_published": own.published, "on_finished": own.finished, **options}
    walk = run_days_continuous if continuous else run_days
    return list(walk(spark, algo, first, source if hasattr(source, "expand") else stream, sync, out_root, ledger_path,
                     checkpoint_base, **options))
