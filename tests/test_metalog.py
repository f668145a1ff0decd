"""The metadata log: snapshots, deltas, readers beside writers and compactions."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.meta import current_meta
from tidemark.sinks.metalog import SCHEMA, LatestReader, MetaLog
from tidemark.sinks.versions import Versions


def _rows(spark, rows):
    at = lambda m: None if m is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    return spark.createDataFrame([(ds, f, v, at(m), q) for ds, f, v, m, q in rows], SCHEMA)


def _now(log):
    return sorted(((r.ds, r.field, r.value) for r in log.read().collect()), key=repr)


def test_reads_the_same_before_during_and_after_a_compaction(spark, tmp_dir):
    log, written = MetaLog(spark, f"{tmp_dir}/meta"), []
    for i in range(6):
        written += [("a", "latest", f"2024010{i}", i, i), ("b", "latest", f"v{i}", 10 - i, i), (None, None, "n", None, i)]
        assert log.append(_rows(spark, written[-3:])) == i
    want = sorted(((r.ds, r.field, r.value) for r in current_meta(_rows(spark, written), seq="seq").collect()), key=repr)
    assert _now(log) == want
    _, entries, _ = log.parts()  # a reader that began before the compaction
    log.compact()
    during = sorted(((r.ds, r.field, r.value) for r in current_meta(log._frame(entries), seq="seq").collect()), key=repr)
    assert during == want and _now(log) == want
    assert len(log.parts()[1]) == 1  # the snapshot alone
    assert log.compact() == 0  # nothing after it
    log.append(_rows(spark, [("a", "latest", "20240109", 9, 9), ("b", "latest", "old", 0, 0)]))
    assert ("a", "latest", "20240109") in _now(log) and ("b", "latest", "v0") in _now(log)
    assert len(log.parts()[1]) == 2


def test_equal_times_and_no_rows(spark, tmp_dir):
    log = MetaLog(spark, f"{tmp_dir}/meta")
    assert _now(log) == [] and log.parts() == (-1, [], -1) and log.compact() == -1
    log.append(_rows(spark, []))
    log.append(_rows(spark, [("a", "f", "x", 1, None), ("a", "f", "y", 1, 0), ("b", "f", None, 1, 0), ("c", "f", "p", 1, 1)]))
    log.append(_rows(spark, [("a", "f", "z", None, 5), ("c", "f", "q", 1, 1)]).drop("seq"))
    assert _now(log) == [("a", "f", "y"), ("b", "f", None), ("c", "f", "p")]


def test_a_reader_opens_only_what_is_new(spark, tmp_dir):
    log = MetaLog(spark, f"{tmp_dir}/meta")
    for i in range(5):
        log.append(_rows(spark, [("a", "latest", f"2024010{i}", i, i), ("other", "latest", "x", i, i), ("a", "commit", "c", i, i)]))
    log.compact()
    log.append(_rows(spark, [("b", "latest", "20240101", 7, 7)]))
    reader = LatestReader(log, ["a", "b", "missing"])
    assert reader.latest() == {"a": "20240104", "b": "20240101"} and len(reader.opened) == 2  # snapshot and one delta
    assert reader.sync() == "" and len(reader.opened) == 2
    log.append(_rows(spark, [("missing", "latest", "20240102", 8, 8), ("a", "latest", "late", 0, 0)]))
    assert reader.sync() == "20240101" and len(reader.opened) == 3
    log.compact()
    assert reader.sync() == "20240101" and len(reader.opened) == 3  # a compaction brings nothing new
    log.put("missing", {"latest": "20240109", "commit": "20240109/0000/1"}, dt.datetime(2024, 1, 2))
    assert reader.sync() == "20240101" and reader.latest()["missing"] == "20240109" and len(reader.opened) == 3
    assert ("missing", "commit", "20240109/0000/1") in _now(log)
    assert LatestReader(log, []).sync() is None and LatestReader(log, ["missing"]).sync() == "20240109"


def test_vacuum_removes_what_no_kept_snapshot_needs(spark, tmp_dir):
    log = MetaLog(spark, f"{tmp_dir}/meta")
    for i in range(4):
        log.append(_rows(spark, [("a", "latest", str(i), i, i)]))
        log.compact()
    assert log.vacuum(keep=2) == 3 + 2 and _now(log) == [("a", "latest", "3")]
    assert log.deltas.numbers() == [3] and log.snapshots.numbers() == [2, 3]


def test_one_writer_gets_a_number(spark, tmp_dir):
    one, two = (Versions(spark, f"{tmp_dir}/v") for _ in range(2))
    assert one.publish(0, {"by": 1}) and not two.publish(0, {"by": 2})
    assert two.read(0) == {"by": 1} and two.append({"by": 2}) == 1 and one.append({"by": 1}) == 2
    assert one.numbers() == [0, 1, 2] and one.numbers(1) == [2] and one.last() == 2


def test_a_taken_number_does_not_lose_a_delta(spark, tmp_dir, monkeypatch):
    log, other = MetaLog(spark, f"{tmp_dir}/meta"), MetaLog(spark, f"{tmp_dir}/meta")
    last = Versions.last

    def late(self):  # another writer publishes between this one's look and its write
        number = last(self)
        if self is log.deltas and number < 0:
            other.append(_rows(spark, [("b", "f", "y", 1, 1)]))
        return number

    monkeypatch.setattr(Versions, "last", late)
    assert log.append(_rows(spark, [("a", "f", "x", 1, 1)])) == 1
    assert _now(log) == [("a", "f", "x"), ("b", "f", "y")]
    assert log.read().where(F.col("seq") == 1).count() == 2
