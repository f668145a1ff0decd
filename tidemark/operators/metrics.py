"""Delivery-failure ratio (AGG-2) and named counters (AGG-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# fixed value: added to the denominator so that 0/0 never happens (all-failed is slightly under 1)
RATIO_EPSILON = 0.01


def fail_ratio(reports: DataFrame, by: list[str], failed: Column | str = "failed") -> DataFrame:
    """``(by..., failed, total, fail_ratio)`` with ``fail_ratio = failed / (total + 0.01)`` as a double."""
    f = F.col(failed) if isinstance(failed, str) else failed
    return reports.groupBy(*by).agg(
        F.count_if(f).cast("bigint").alias("failed"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("fail_ratio", F.col("failed") / (F.col("total") + F.lit(RATIO_EPSILON).cast("double")))


def with_counters(df: DataFrame, name: str, **exprs: Column) -> tuple[DataFrame, Observation]:
    """Attach named long counters (``sum`` of each expression over the rows that pass) to a frame.

    The values are read from the returned :class:`Observation` after the first action, like a named
    accumulator, but without double counting on task retries: Spark collects observed metrics from
    the successful attempt only.
    """
    obs = Observation(name)
    observed = df.observe(obs, *[F.sum(e).cast("bigint").alias(k) for k, e in exprs.items()])
    return observed, obs


def counter_table(df: DataFrame, by: list[str], **exprs: Column) -> DataFrame:
    """The same counters as a table, grouped by ``by`` (partially aggregated map-side)."""
    return df.groupBy(*by).agg(*[F.sum(e).cast("bigint").alias(k) for k, e in exprs.items()])
