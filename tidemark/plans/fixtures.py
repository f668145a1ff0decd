"""Inputs of the registered queries, derived by Spark from the driver tables (whole tables).

The reference runs against live topics and a metadata service; here the same shapes are derived
from ``events`` (and ``region``/``nation``/``customer`` for topics and lookups):

* processors are the ``event_type`` values; a processor's upstream is the producer of the same name;
* stream records are ``(key = user_id as text bytes, value = value as text)``;
* the batch log is every 1-hour batch of each processor's whole days (empty batches included) with
  the number of records, ``failed`` = the batch holds a record over :data:`VALUE_LIMIT` (an output
  the sink refuses), and ``sync`` = the as-of ``latest`` of the upstream at the batch time;
* a producer announces day D-1 as finished (``latest = D-1``) when it writes its first record of D,
  so the metadata history is one row per event: ``(ds = event_type, value = yyyyMMdd(ts - 1 day),
  updated_at = ts)``;
* the last commit of a previous run is each processor's first non-empty batch, which makes the
  replay start with redo batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import commit_point, day_text, epoch_micros_sql, floor_sql
from tidemark.operators.batches import DAY_US, HOUR_US, batch_columns
from tidemark.operators.meta import resume_state, sync_at
from tidemark.session import materialize

# ---- fixed parameters of the derived inputs ------------------------------------------------
BATCH_WIDTH_US = HOUR_US
VALUE_LIMIT = 330.0
# --------------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def meta_history(events: DataFrame) -> DataFrame:
    """``(ds, field, value, updated_at, seq)``: each event announces its producer's previous day."""
    return events.select(
        F.col("event_type").alias("ds"),
        F.lit("latest").alias("field"),
        day_text(F.date_sub(F.to_date("ts"), 1)).alias("value"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("seq"),
    )


def per_batch(events: DataFrame, width_us: int = BATCH_WIDTH_US, limit: float = VALUE_LIMIT) -> DataFrame:
    """Everything the batch log needs of the events, in one pass over them, written to the shared folder:
    one row per (processor, non-empty batch) with its count, failure flag, first record, and the
    announcement that is current at its end and right at its start (``latest``, ``latest_at_start``)."""
    us = epoch_micros_sql("ts", events.schema["ts"].dataType)
    e = events.selectExpr("event_type AS proc", "value", f"{us} AS us",
                          f"{floor_sql(us, width_us)} AS batch_start_us", "ts") \
        .withColumn("day_before", day_text(F.date_sub(F.to_date("ts"), 1)))
    return materialize(e.where("us IS NOT NULL").groupBy("proc", "batch_start_us").agg(
        F.count(F.lit(1)).alias("num_records"),
        F.max(F.when(F.col("value") > F.lit(limit), 1).otherwise(0)).alias("failed"),
        F.min("us").alias("first_us"),
        F.max_by("day_before", "us").alias("latest"),
        F.max(F.when(F.col("us") == F.col("batch_start_us"), F.col("day_before"))).alias("latest_at_start"),
    ), "per-batch")


def batch_log(events: DataFrame, width_us: int = BATCH_WIDTH_US, limit: float = VALUE_LIMIT,
              hourly: DataFrame | None = None) -> DataFrame:
    """``(proc, batch_time, date, batch, num_records, failed, sync)`` per processor batch, empty batches of
    every whole day included. One pass over ``events`` (none with ``hourly``, from :func:`per_batch`)."""
    hourly = per_batch(events, width_us, limit) if hourly is None else hourly
    days = hourly.groupBy("proc").agg(F.min("batch_start_us").alias("lo"), F.max("batch_start_us").alias("hi"))
    spine = days.selectExpr("proc", f"explode(sequence({floor_sql('lo', DAY_US)}, {floor_sql('hi', DAY_US)} + "
                                    f"{DAY_US - int(width_us)}, CAST({int(width_us)} AS BIGINT))) AS batch_start_us",
                            "CAST(0 AS BIGINT) AS num_records", "0 AS failed")
    counts = spine.unionByName(hourly.select("proc", "batch_start_us", "num_records", "failed")) \
        .groupBy("proc", "batch_start_us").agg(F.sum("num_records").alias("num_records"), F.max("failed").alias("failed"))
    # a record on a batch's very start is already seen by the probe there, the others by the one at its end
    history = hourly.selectExpr("proc AS ds", "latest AS value", f"batch_start_us + {int(width_us)} AS updated_at", "0 AS late") \
        .unionByName(hourly.where("latest_at_start IS NOT NULL").selectExpr(
            "proc AS ds", "latest_at_start AS value", "batch_start_us AS updated_at", "1 AS late"))
    probes = counts.select("*", *batch_columns("batch_start_us", width_us)) \
        .withColumn("probe_us", F.col("batch_start_us") + F.lit(width_us))
    synced = sync_at(probes, history, proc="proc", probe_time="probe_us", grid_us=width_us, tiebreak=["late"])
    return synced.select("proc", "batch_time", "date", "batch", "num_records",
                         F.col("failed").cast("int").alias("failed"), "sync")


def first_commits(hourly: DataFrame, width_us: int = BATCH_WIDTH_US) -> DataFrame:
    """``(proc, commit)``: commit point of each processor's first non-empty batch."""
    first = hourly.groupBy("proc").agg(F.min("batch_start_us").alias("batch_start_us"))
    b = first.select("proc", *batch_columns("batch_start_us", width_us))
    return b.select("proc", commit_point("date", "batch", "batch_time").alias("commit"))


def start_state(events: DataFrame, width_us: int = BATCH_WIDTH_US, hourly: DataFrame | None = None) -> DataFrame:
    """Start state of every processor from its first commit (see :func:`first_commits`)."""
    commits = first_commits(per_batch(events, width_us) if hourly is None else hourly, width_us)
    no_sync = commits.select("proc", F.lit(None).cast("string").alias("sync"))
    return resume_state(commits.select("proc"), no_sync, commits)


def replay_inputs(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(batch_log, start_state)`` from one pass over the events."""
    hourly = per_batch(events)
    return batch_log(events, hourly=hourly), start_state(events, hourly=hourly)


def stream_records(events: DataFrame) -> DataFrame:
    """``(key BINARY, value STRING)`` plus the record's topic and date."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("event_type").alias("topic"),
        day_text("ts").alias("date"),
        "ts", "event_id",
    )
