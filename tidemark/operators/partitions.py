"""Append constants after the records (PRT-1 per partition, PRT-2 once)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_per_partition(df: DataFrame, values: Sequence[str], num_partitions: int, column: str = "value") -> DataFrame:
    """The rows of ``column`` in ``num_partitions`` partitions, and every constant once for each of them (an
    empty partition has the constants too): ``rows + num_partitions x len(values)`` rows. A union of two
    JVM-side frames; the rows themselves are not touched."""
    spark = df.sparkSession
    own = df.select(F.col(column).cast("string").alias("value")).repartition(num_partitions)
    marks = spark.range(0, num_partitions, 1, num_partitions).select(
        F.explode(F.array(*[F.lit(v).cast("string") for v in values])).alias("value"))
    return own.unionByName(marks)


def append_rows(df: DataFrame, values: DataFrame) -> DataFrame:
    """Partition-independent form: the records followed by the constants once (``UNION ALL``)."""
    return df.unionByName(values)


def constants(spark: SparkSession, values: Sequence[str], column: str = "value") -> DataFrame:
    return spark.createDataFrame([(None if v is None else str(v),) for v in values], f"{column} string")
