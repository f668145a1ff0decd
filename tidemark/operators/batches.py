"""Micro-batches as data: fixed-width batches with their in-day number (STR-9), records per batch
including empty ones (AGG-4), failed outputs per batch (AGG-3), and replay filtering (FLT-1).

Every operator here is a projection or a partially aggregated ``groupBy``: events are reduced
map-side to one row per (key, batch) before anything is shuffled, so a hot key costs one row per
batch in the shuffle, not one row per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (batch_folder, div_floor, div_floor_sql, epoch_micros_sql, floor_sql,
                                        ident)
from tidemark.operators.enrich import enrich
from tidemark.session import materialize

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def _check_width(width_us: int) -> None:
    if width_us <= 0 or DAY_US % width_us:
        raise ValueError("batch width must divide one day (in microseconds)")


def day_of_micros(us: Column | str) -> Column:
    """``yyyyMMdd`` of the UTC day holding an epoch-microsecond value (no time zone involved)."""
    if isinstance(us, str):
        return F.expr(f"date_format(date_add(DATE'1970-01-01', CAST({div_floor_sql(ident(us), DAY_US)} AS INT)),"
                      f" 'yyyyMMdd')")
    days = div_floor(us, DAY_US).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyyMMdd")


def batch_columns(start_us: str, width_us: int) -> list[Column]:
    """Columns describing the batch that starts at the epoch-microsecond column ``start_us``:
    ``date`` (its day), ``batch`` (number within the day) and ``batch_time`` (its end, epoch ms)."""
    q = ident(start_us)
    return [
        day_of_micros(start_us).alias("date"),
        F.expr(f"CAST(pmod({q}, {DAY_US}) DIV {int(width_us)} AS INT)").alias("batch"),
        F.expr(f"({q} + {int(width_us)}) DIV 1000").alias("batch_time"),
    ]


def _start_sql(df: DataFrame, ts: str, width_us: int) -> str:
    return floor_sql(epoch_micros_sql(ts, df.schema[ts].dataType), width_us)


def batchify(df: DataFrame, ts: str, width_us: int) -> DataFrame:
    """Assign each row to its fixed-width batch: ``batch_start_us``, ``date`` (the batch's day),
    ``batch`` (number within the day, from 0) and ``batch_time`` (batch end, epoch ms, the time a
    micro-batch with this interval completes). A projection: no shuffle."""
    _check_width(width_us)
    return (df.withColumn("batch_start_us", F.expr(_start_sql(df, ts, width_us)))
            .select("*", *batch_columns("batch_start_us", width_us)))


def batch_spine(df: DataFrame, by: str, ts: str, width_us: int) -> DataFrame:
    """Every batch of every whole day from each key's first to last day, empty ones included:
    ``(by, batch_start_us, date, batch, batch_time)``. Rows per key = days x batches per day, bounded
    by the time span, not by the data volume."""
    _check_width(width_us)
    us = epoch_micros_sql(ts, df.schema[ts].dataType)
    per_key = df.groupBy(by).agg(F.expr(f"min({us})").alias("lo"), F.expr(f"max({us})").alias("hi"))
    spine = _whole_days(per_key, by, width_us)
    return spine.select("*", *batch_columns("batch_start_us", width_us))


def batch_counts(df: DataFrame, by: str, ts: str, width_us: int,
                 extra_aggs: dict[str, Column] | None = None) -> DataFrame:
    """Records per batch for every batch of the spine (zero for empty batches):
    ``(by, batch_start_us, date, batch, batch_time, num_records, *extra)``.

    ``extra_aggs`` maps a name to an aggregate over the event rows; an empty batch has its value for no
    row's worth of data (a row of nulls). The events are read once: the non-empty batches are written to
    the shared checkpoint folder, and the spine comes from them.
    """
    extra_aggs = extra_aggs or {}
    _check_width(width_us)
    start = F.expr(_start_sql(df, ts, width_us)).alias("batch_start_us")
    events = df.select("*", start).where(F.col("batch_start_us").isNotNull())
    filled = materialize(events.groupBy(by, "batch_start_us").agg(
        F.count(F.lit(1)).alias("num_records"), *[e.alias(name) for name, e in extra_aggs.items()]), "batches")
    spine = _whole_days(filled.groupBy(by).agg(F.min("batch_start_us").alias("lo"), F.max("batch_start_us").alias("hi")),
                        by, width_us)
    counts = filled.select(F.col(by).alias("_by"), F.col("batch_start_us").alias("_start"), "num_records", *extra_aggs)
    joined = spine.join(counts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("batch_start_us") == F.col("_start")), "left")
    none = _of_nulls(df, extra_aggs)
    return joined.select(by, "batch_start_us", *batch_columns("batch_start_us", width_us),
                         F.coalesce("num_records", F.lit(0)).alias("num_records"),
                         *[F.when(F.col("_start").isNull(), F.lit(none[n])).otherwise(F.col(n)).alias(n) for n in extra_aggs])


def _of_nulls(df: DataFrame, aggs: dict[str, Column]) -> dict:
    """Values of the aggregates over one row of nulls."""
    if not aggs:
        return {}
    row = df.sparkSession.createDataFrame([tuple(None for _ in df.columns)],
                                          ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields))
    return row.agg(*[e.alias(n) for n, e in aggs.items()]).first().asDict()


def _whole_days(per_key: DataFrame, by: str, width_us: int) -> DataFrame:
    """Every batch of the whole days from each key's ``lo`` to its ``hi`` (epoch microseconds)."""
    first = floor_sql("lo", DAY_US)
    last = f"({floor_sql('hi', DAY_US)} + {DAY_US - int(width_us)})"
    return per_key.where("lo IS NOT NULL").selectExpr(
        ident(by), f"explode(sequence({first}, {last}, CAST({int(width_us)} AS BIGINT))) AS batch_start_us")


def failed_outputs(op_log: DataFrame, batch_cols: list[str], reason: str = "failure_reason") -> DataFrame:
    """Failed output operations per batch: an operation fails when it has a failure reason, even an
    empty one. ``(*batch_cols, num_ops, num_failed)``."""
    return op_log.groupBy(*batch_cols).agg(
        F.count(F.lit(1)).alias("num_ops"),
        F.count_if(F.col(reason).isNotNull()).cast("bigint").alias("num_failed"),
    )


def skip_committed(batches: DataFrame, ledger: DataFrame, by: str = "proc",
                   batch_time: str = "batch_time") -> DataFrame:
    """Drop batches that the ledger already holds: keep ``batch_time > last committed time`` per key
    (0 when the key has none). The ledger is reduced to one row per key before the join."""
    last = ledger.groupBy(by).agg(F.max(batch_time).alias("_last_commit"))
    return (enrich(batches, last, on=by, how="left")
            .where(F.col(batch_time) > F.coalesce(F.col("_last_commit"), F.lit(0)))
            .drop("_last_commit"))


def batch_dir(date: str, batch: int) -> str:
    """Python twin of :func:`tidemark.functions.batch_path` for building paths on the driver."""
    return f"{date}/{batch:0,d}00" if batch >= 10 else f"{date}/0{batch}00"


__all__ = [
    "DAY_US", "HOUR_US", "MINUTE_US", "batchify", "batch_spine", "batch_counts", "failed_outputs",
    "skip_committed", "day_of_micros", "batch_columns", "batch_dir", "batch_folder",
]
