"""The tracker rules replayed per processor."""

import pytest

from tidemark.operators.replay import next_day_text, replay_ledger, step


def test_step_sequence():
    st = {"trace": "20240101", "batch_num": 2, "commit_time": 100, "dead": False}
    seq = [(50, 5, 0, "20240101"), (100, 0, 0, "20240101"), (200, 0, 0, "20240101"), (300, 4, 0, "20240101"),
           (400, 0, 0, "20240101"), (500, 3, 1, "20240102"), (600, 0, 0, "20240105")]
    outs = [step(st, *s) for s in seq]
    assert outs == ["redo", "redo", "switch", "commit", "commit", "abort", "ignored"]
    assert st == {"trace": "20240102", "batch_num": 2, "commit_time": 400, "dead": True}


def test_next_day_text():
    assert next_day_text("20241231") == "20250101"
    assert next_day_text("20240230") is None
    assert next_day_text("20240101/0300") == "20240102"


def test_replay_ledger_per_processor(spark):
    log = spark.createDataFrame([
        ("a", 300, 0, 0, "20240101"), ("a", 100, 3, 0, ""), ("a", 200, 0, 0, ""),
        ("b", 100, 1, 1, ""), ("b", 200, 1, 0, ""),
    ], "proc string, batch_time long, num_records long, failed int, sync string")
    start = spark.createDataFrame([("a", "20240101", 0, 0), ("b", "20240101", 4, 150)],
                                  "proc string, trace string, batch_num int, commit_time long")
    got = sorted(tuple(r) for r in replay_ledger(log, start).collect())
    assert got == [
        ("a", 100, "20240101", 0, "commit"),
        ("a", 200, "20240101", 1, "commit"),  # empty but upstream not done: commits an empty batch
        ("a", 300, "20240101", 2, "switch"),
        ("b", 100, "20240101", 4, "redo"),
        ("b", 200, "20240101", 4, "commit"),
    ]


def test_replay_requires_start_state(spark):
    log = spark.createDataFrame([("x", 1, 1, 0, "")], "proc string, batch_time long, num_records long, failed int, sync string")
    start = spark.createDataFrame([], "proc string, trace string, batch_num int, commit_time long")
    with pytest.raises(Exception, match="no start state"):
        replay_ledger(log, start).collect()


def test_empty_batches_around_the_date_and_failures():
    # empty batch with sync before, at and after the traced date; a failure on an empty batch
    st = {"trace": "20240110", "batch_num": 0, "commit_time": 100, "dead": False}
    assert step(st, 100, 0, 0, "20240110") == "redo"          # batch_time equal to the commit time
    assert step(st, 200, 0, 0, "20240109") == "commit"        # empty, upstream behind: commits (delayed)
    assert st["batch_num"] == 1 and st["commit_time"] == 200
    assert step(st, 300, 0, 1, "20240110") == "switch"        # empty and upstream at the date: switch wins
    assert st == {"trace": "20240111", "batch_num": 0, "commit_time": 200, "dead": False}
    assert step(st, 400, 0, 0, "20240112") == "switch"        # upstream past the date: switch again
    assert step(st, 500, 0, 1, "20240101") == "abort"         # failure on an empty batch, upstream behind
    assert step(st, 600, 5, 0, "20240112") == "ignored"


def test_outcome_counts(spark):
    from tidemark.operators.replay import outcome_counts

    log = spark.createDataFrame([("a", 1, 1, 0, ""), ("a", 2, 1, 1, "")],
                                "proc string, batch_time long, num_records long, failed int, sync string")
    start = spark.createDataFrame([("a", "20240101", 0, 0)], "proc string, trace string, batch_num int, commit_time long")
    got = {(r.proc, r.outcome): r.n for r in outcome_counts(replay_ledger(log, start)).collect()}
    assert got == {("a", "commit"): 1, ("a", "abort"): 1}
