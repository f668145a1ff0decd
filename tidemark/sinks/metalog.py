"""Dataset metadata as snapshot and deltas (SNK-4, AGG-6).

A log-structured table of the last value of each ``(ds, field)``: every write is a delta, published under the
next number; a compaction writes the current values as a snapshot and publishes which deltas it covers, last
of all. Readers merge the newest snapshot with the deltas after it, so what they read grows with the number
of datasets and the writes since, not with all history. Writers, readers and a compaction never wait for
each other: a reader that began with the older snapshot reads the same values from it and more deltas.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.versions import Versions

SCHEMA = "ds string, field string, value string, updated_at timestamp, seq bigint"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


class MetaLog:
    """Metadata ``(ds, field, value, updated_at, seq)`` at ``path``; of several writes to one ``(ds, field)`` the
    one with the greatest ``updated_at`` counts, then the greatest ``seq`` (null below all), then the greatest
    value. A null ``updated_at`` is below all; null ``ds`` or ``field`` are keys like others."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.deltas, self.snapshots = Versions(spark, f"{path}/deltas"), Versions(spark, f"{path}/snapshots")

    def _write(self, rows: DataFrame) -> str:
        name = f"data/{uuid.uuid4().hex}"
        rows.select(*COLUMNS).write.parquet(f"{self.path}/{name}")
        return name

    def append(self, rows: DataFrame) -> int:
        """Publish rows (``seq`` may be missing) as the next delta and return its number. Only the last write of
        each key in ``rows`` is kept: the others can never be current."""
        if "seq" not in rows.columns:
            rows = rows.withColumn("seq", F.lit(None).cast("long"))
        return self.deltas.append({"data": self._write(last_writes(rows))})

    def put(self, ds: str, fields: dict[str, str], at: _dt.datetime | None = None) -> int:
        """Publish a few values of one dataset, written now (UTC) or ``at``, in the entry itself; returns its number."""
        at = at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        micros = (at - _dt.datetime(1970, 1, 1)) // _dt.timedelta(microseconds=1)
        return self.deltas.append({"rows": [[ds, field, value, micros, None] for field, value in fields.items()]})

    def _frame(self, entries: list[dict]) -> DataFrame:
        """Rows of entries: those of their folders and those kept in them."""
        folders = [f"{self.path}/{e['data']}" for e in entries if "data" in e]
        rows = [tuple(r) for e in entries for r in e.get("rows", ())]
        kept = self.spark.createDataFrame(rows, "ds string, field string, value string, us bigint, seq bigint") \
            .select("ds", "field", "value", F.timestamp_micros("us").alias("updated_at"), "seq")
        return self.spark.read.schema(SCHEMA).parquet(*folders).unionByName(kept) if folders else kept

    def parts(self) -> tuple[int, list[dict], int]:
        """``(number of the snapshot, entries that hold the current values, last delta)``."""
        snapshot = self.snapshots.last()
        entries, covers = [], -1
        if snapshot >= 0:
            entries = [self.snapshots.read(snapshot)]
            covers = entries[0]["covers"]
        later = self.deltas.numbers(covers)
        return snapshot, entries + [self.deltas.read(n) for n in later], later[-1] if later else covers

    def read(self) -> DataFrame:
        """The current ``(ds, field, value, updated_at, seq)``."""
        return last_writes(self._frame(self.parts()[1]))

    def latest(self) -> DataFrame:
        """``(ds, latest)``: the datasets' finished days."""
        return self.read().where("field = 'latest'").select("ds", F.col("value").alias("latest"))

    def compact(self) -> int:
        """Write the current values as a snapshot that covers all deltas there are now; returns its number (that
        of the last one, if there is nothing after it). Beside another compaction the one that covers more
        counts: it is published later."""
        snapshot, entries, last = self.parts()
        if snapshot >= 0 and len(entries) == 1 or not entries:
            return snapshot
        entry = {"data": self._write(last_writes(self._frame(entries))), "covers": last}
        number = snapshot + 1
        while not self.snapshots.publish(number, entry):
            if self.snapshots.read(number)["covers"] >= last:
                return number
            number += 1
        return number

    def vacuum(self, keep: int = 2) -> int:
        """Remove the entries and data that only snapshots older than the last ``keep`` need; returns the number of
        entries removed. A reader that still holds one of those must read anew."""
        kept = self.snapshots.numbers()[-keep:]
        if not kept:
            return 0
        covers = self.snapshots.read(kept[0])["covers"]
        old = [(self.deltas, n) for n in self.deltas.numbers() if n <= covers]
        old += [(self.snapshots, n) for n in self.snapshots.numbers() if n < kept[0]]
        for log, n in old:
            data = log.read(n).get("data")
            log.remove(n)
            if data:
                log._files.delete(log._hadoop.Path(f"{self.path}/{data}"), True)
        return len(old)


def last_writes(rows: DataFrame) -> DataFrame:
    """The last write of each ``(ds, field)``, all columns; aggregated before the shuffle."""
    order = F.struct("updated_at", "seq", "value")
    return rows.groupBy("ds", "field").agg(F.max(order).alias("_w")).select(
        "ds", "field", "_w.value", "_w.updated_at", "_w.seq")


class LatestReader:
    """The current values of one field for a few datasets, followed as a log grows: the first look reads the
    newest snapshot and the deltas after it, every further one only deltas that are new since. ``opened``
    lists the folders of data read so far."""

    def __init__(self, log: MetaLog, names: list[str], field: str = "latest"):
        self.log, self.names, self.field = log, sorted(set(names)), field
        self.seen, self.opened, self._now = -1, [], {}

    def latest(self) -> dict[str, str]:
        """``{ds: value}`` of the named datasets that have one."""
        if self.seen < 0:
            _, entries, last = self.log.parts()
        else:
            later = self.log.deltas.numbers(self.seen)
            entries, last = [self.log.deltas.read(n) for n in later], later[-1] if later else self.seen
        for ds, field, value, us, seq in (r for e in entries for r in e.get("rows", ())):
            if ds in self.names and field == self.field:
                self._take(ds, value, us, seq)
        folders = [e for e in entries if "data" in e]
        if folders:
            mine = self.log._frame([{"data": e["data"]} for e in folders]).where(
                F.col("ds").isin(self.names) & (F.col("field") == self.field))
            # at most one row for each name asked for
            for r in last_writes(mine).withColumn("us", F.unix_micros("updated_at")).collect():
                self._take(r["ds"], r["value"], r["us"], r["seq"])
            self.opened += [e["data"] for e in folders]
        self.seen = last
        return {ds: key[-1] for ds, key in self._now.items()}

    def _take(self, ds: str, value: str | None, us: int | None, seq: int | None) -> None:
        # nulls below all, as in last_writes
        key = (us is not None, us or 0, seq is not None, seq or 0, value is not None, value)
        if ds not in self._now or key[:5] > self._now[ds][:5] or key[:5] == self._now[ds][:5] and (value or "") > (self._now[ds][5] or ""):
            self._now[ds] = key

    def sync(self) -> str | None:
        """The least of the named datasets' values, a missing one counting as the empty string; null without
        names (see :func:`tidemark.operators.meta.sync_point`)."""
        now = self.latest()
        return min((now.get(n) or "" for n in self.names), default=None)
