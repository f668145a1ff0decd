"""Replay a batch log through the tracker's rules, one processor at a time (STR-5).

The rules are sequential: whether a batch switches the day depends on the traced date, and the
traced date depends on earlier switches, so no window function expresses them. Each processor's
log is one group of a ``cogroup``: the log is already one row per micro-batch (aggregated from the
events before this step), so a group holds days x batches-per-day rows no matter how many
records flowed.

State per processor: ``trace`` (the date being processed), ``batch_num`` (next batch of that date),
``commit_time`` (batch time of the last commit, ms) and ``dead`` (an abort happened). Each output
row carries the state *before* the batch and the batch's outcome:

* ``ignored`` -- the processor already stopped (after an abort);
* ``redo``    -- ``batch_time <= commit_time``: committed before a restart, nothing changes;
* ``switch``  -- empty batch and ``sync >= trace``: trace moves to the next day, batch_num to 0;
* ``commit``  -- no failed output: commit_time = batch_time, batch_num + 1;
* ``abort``   -- otherwise: the processor stops.
"""

from __future__ import annotations

import datetime as _dt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

LOG_COLUMNS = ("proc", "batch_time", "num_records", "failed", "sync")
STATE_COLUMNS = ("proc", "trace", "batch_num", "commit_time")
REPLAY_SCHEMA = "proc string, batch_time bigint, trace string, batch_num int, outcome string"


def next_day_text(d: str | None) -> str | None:
    """Python twin of :func:`tidemark.functions.next_day`: the first 8 characters must be digits and a day."""
    text = "" if d is None else str(d)[:8]
    if len(text) != 8 or not (text.isascii() and text.isdigit()):
        return None
    try:
        day = _dt.datetime.strptime(text, "%Y%m%d")
    except ValueError:
        return None
    return (day + _dt.timedelta(days=1)).strftime("%Y%m%d")


def step(state: dict, batch_time: int, num_records: int, failed: int, sync: str | None) -> str:
    """Apply one completed batch to ``state`` in place and return its outcome."""
    if state["dead"]:
        return "ignored"
    if batch_time <= state["commit_time"]:
        return "redo"
    trace = state["trace"]
    if num_records == 0 and sync is not None and trace is not None and sync >= trace:
        state["trace"] = next_day_text(trace)
        state["batch_num"] = 0
        return "switch"
    if not failed:
        state["commit_time"] = batch_time
        state["batch_num"] += 1
        return "commit"
    state["dead"] = True
    return "abort"


def replay_rows(proc: str, log: pd.DataFrame, state: dict) -> pd.DataFrame:
    """Replay one processor's log (any order; sorted here by batch time) from ``state``."""
    log = log.sort_values("batch_time", kind="stable")
    times = log["batch_time"].to_numpy()
    counts = log["num_records"].fillna(0).to_numpy()
    fails = log["failed"].fillna(0).to_numpy()
    syncs = log["sync"].tolist()
    traces, nums, outcomes = [], [], []
    for t, n, f, s in zip(times, counts, fails, syncs):
        traces.append(state["trace"])
        nums.append(state["batch_num"])
        outcomes.append(step(state, int(t), int(n), int(f), None if s is None or s != s else s))
    return pd.DataFrame({
        "proc": proc,
        "batch_time": times.astype("int64"),
        "trace": pd.Series(traces, dtype="object"),
        "batch_num": pd.Series(nums, dtype="int32"),
        "outcome": outcomes,
    })


def _fresh_state(row: pd.Series | None) -> dict | None:
    if row is None:
        return None
    return {
        "trace": row["trace"],
        "batch_num": int(row["batch_num"]),
        "commit_time": int(row["commit_time"]),
        "dead": False,
    }


def _replay_group(log: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
    if log.empty:
        return pd.DataFrame(columns=["proc", "batch_time", "trace", "batch_num", "outcome"])
    proc = log["proc"].iloc[0]
    if start.empty:
        raise ValueError(f"processor {proc!r} has no start state")
    state = _fresh_state(start.iloc[0])
    if not state["trace"]:
        raise ValueError(f"processor {proc!r} has no date to trace")
    return replay_rows(proc, log, state)


def replay_ledger(batch_log: DataFrame, start_state: DataFrame) -> DataFrame:
    """``batch_log(proc, batch_time, num_records, failed, sync)`` x ``start_state(proc, trace,
    batch_num, commit_time)`` -> ``(proc, batch_time, trace, batch_num, outcome)``.

    One shuffle by ``proc`` of the (small, per-batch) log and of the start states; processors run in
    parallel. A processor in the log without a start state is an error, as in the reference tracker.
    """
    ship_package(batch_log.sparkSession)
    log = batch_log.select(*LOG_COLUMNS)
    start = start_state.select(*STATE_COLUMNS)
    return log.groupBy("proc").cogroup(start.groupBy("proc")).applyInPandas(_replay_group, REPLAY_SCHEMA)


def outcome_counts(replayed: DataFrame) -> DataFrame:
    """``(proc, outcome, n)``: how many batches of each processor ended each way."""
    return replayed.groupBy("proc", "outcome").agg(F.count(F.lit(1)).alias("n"))
