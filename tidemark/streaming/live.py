"""As-of answers inside a stream (JON-2 live): probes and history arrive together, in any order within a delay.

Each micro-batch moves the watermark to the latest time seen less the delay. Probes before the watermark are
answered, as all history that they may see has come; everything later waits. What is carried from batch to
batch is bounded: the rows that wait (those of the last ``delay``) and the last history row of each key
before the watermark. The join itself is the batch one (:func:`tidemark.operators.meta.sync_at` or another over
:func:`tidemark.operators.asof.asof_join`), on a batch's probes and the history that concerns them; no pairs are
made.

Rows that come with a time before the watermark are late: they are kept apart under ``late/`` and answer or
change nothing. The state and the answers of a batch are published together by one numbered entry, so a
replayed batch is done once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import materialize
from tidemark.sinks.versions import Versions


def tagged(probes: DataFrame, history: DataFrame, probe_us: Column, history_us: Column) -> DataFrame:
    """One stream ``(us, probe, history)`` of two: each row is a probe or a history row, as a struct, with its time in
    epoch microseconds."""
    p, h = F.struct(*probes.columns), F.struct(*history.columns)
    as_sql = [d.schema.simpleString() for d in (probes, history)]
    return probes.select(probe_us.alias("us"), p.alias("probe"), F.lit(None).cast(as_sql[1]).alias("history")).unionByName(
        history.select(history_us.alias("us"), F.lit(None).cast(as_sql[0]).alias("probe"), h.alias("history")))


class LiveAsof:
    """Answers of a tagged stream under ``path``. ``answer(probes, history)`` is the batch join; ``key``: columns of the
    history by which it finds the last row before a time, ``last``: the order of rows of one key (time first)."""

    def __init__(self, spark: SparkSession, path: str, answer: Callable[[DataFrame, DataFrame], DataFrame],
                 key: list[str], last: list[str], delay_us: int):
        if delay_us < 0:
            raise ValueError("the delay must not be negative")
        self.spark, self.path, self.answer, self.key, self.last, self.delay_us = spark, path.rstrip("/"), answer, key, last, delay_us
        self.log = Versions(spark, f"{path}/batches")

    def _read(self, entry: dict, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{entry['data']}/{part}")

    def _split(self, waiting: DataFrame, carried: DataFrame | None, ready: Column) -> tuple[DataFrame, DataFrame]:
        """Probes that are ready, and the history up to then."""
        done = waiting.where(ready)
        history = done.where("history is not null").select("history.*")
        return done.where("probe is not null").select("probe.*"), history if carried is None else history.unionByName(carried)

    def on_batch(self, rows: DataFrame, batch: int) -> None:
        if self.log.numbers(batch - 1)[:1] == [batch]:
            return  # a replay: answers and state are published
        before = self.log.read(batch - 1) if batch else None
        new = materialize(rows, "live-rows")  # a micro-batch is evaluated once
        top = new.agg(F.max("us")).first()[0]
        old = before["watermark"] if before else None
        marks = [w for w in (old, None if top is None else top - self.delay_us) if w is not None]
        watermark = max(marks, default=None)
        data = f"data/{uuid.uuid4().hex}"
        late = F.coalesce(F.col("us") < F.lit(old), F.lit(False))
        new.where(late).write.parquet(f"{self.path}/{data}/late")
        waiting = new.where(~late)
        carried = None
        if before:
            waiting = waiting.unionByName(self._read(before, "waiting"))
            carried = self._read(before, "carried")
        ready = F.coalesce(F.col("us") < F.lit(watermark), F.lit(False))
        probes, history = self._split(waiting, carried, ready)
        self.answer(probes, history).write.parquet(f"{self.path}/{data}/answers")
        waiting.where(~ready).write.parquet(f"{self.path}/{data}/waiting")
        order = F.struct(*self.last)
        columns = [c for c in history.columns if c not in self.key]
        history.groupBy(*self.key).agg(F.max_by(F.struct(*columns), order).alias("_r")).select(*self.key, "_r.*") \
            .select(*history.columns).write.parquet(f"{self.path}/{data}/carried")
        self.log.publish(batch, {"data": data, "watermark": watermark})

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (stream.writeStream.foreachBatch(self.on_batch).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())

    def answers(self, finished: bool = False) -> DataFrame | None:
        """All answers so far; with ``finished`` (nothing more will come) also those of the probes that wait, rows
        without a time among them. None before the first batch."""
        entries = [self.log.read(n) for n in self.log.numbers()]
        if not entries:
            return None
        done = self.spark.read.parquet(*[f"{self.path}/{e['data']}/answers" for e in entries])
        if not finished:
            return done
        probes, history = self._split(self._read(entries[-1], "waiting"), self._read(entries[-1], "carried"), F.lit(True))
        return done.unionByName(self.answer(probes, history))

    def late(self) -> DataFrame | None:
        """Rows that came too late, of all batches."""
        entries = [self.log.read(n) for n in self.log.numbers()]
        return self.spark.read.parquet(*[f"{self.path}/{e['data']}/late" for e in entries]) if entries else None
