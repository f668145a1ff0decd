"""Aggregates kept up to date over a stream (AGG-2, AGG-3): watermarked state, changes into a keyed table.

The stream is aggregated per key and time window with a watermark, so that state is bounded: a window's state
is dropped once the watermark has passed its end. Output mode is ``update``: each micro-batch gives the new
totals of the windows that it changed. They are written under the batch's number (a replay overwrites them);
the table's current rows are those of the greatest batch for each key and window.

Late rows: a row that is later than the watermark when its micro-batch begins is left out by Spark and counted
in the progress record (``numRowsDroppedByWatermark``); one within ``delay`` of the latest time seen always
counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.metrics import RATIO_EPSILON


def windowed_failures(stream: DataFrame, ts: str, failed: Column, by: list[str], width: str = "1 day",
                      delay: str = "1 day") -> DataFrame:
    """``(by..., start, total, failed)`` per window of ``width``: rows, and rows that failed. A null ``failed`` is no
    failure; rows with a null time belong to no window."""
    window = F.window(F.col(ts), width)
    return (stream.withWatermark(ts, delay).where(F.col(ts).isNotNull())
            .groupBy(window.alias("_w"), *by)
            .agg(F.count(F.lit(1)).alias("total"), F.sum(F.coalesce(failed.cast("int"), F.lit(0))).cast("long").alias("failed"))
            .select(*by, F.col("_w.start").alias("start"), "total", "failed"))


def keep_table(aggregate: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start the query that keeps the changes of a streaming aggregate under ``{path}/batch=..``."""
    def on_batch(changes: DataFrame, batch: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")

    return (aggregate.writeStream.outputMode("update").foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def current_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The table's current rows: the last change of each key."""
    changes = spark.read.parquet(path)
    others = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_last")).select(*keys, "_last.*")


def fail_ratios(current: DataFrame, by: list[str]) -> DataFrame:
    """``(by..., failed, total, fail_ratio)`` from current rows, the ratio as in
    :func:`tidemark.operators.metrics.fail_ratio`."""
    return current.groupBy(*by).agg(F.sum("failed").alias("failed"), F.sum("total").alias("total")) \
        .withColumn("fail_ratio", F.col("failed") / (F.col("total") + F.lit(RATIO_EPSILON).cast("double")))
