"""Give every record a shared lookup (JON-1).

The reference broadcasts a named value once and keeps it until the application ends. Here the lookup
is a DataFrame produced by ``lookup_fn``, built anew on every call (inside ``foreachBatch`` that is once
per micro-batch, so it never goes stale), and joined by an ordinary join: Spark broadcasts it where its
statistics, or the size it turns out to have at run time, allow that, and splits skewed keys otherwise.

:class:`VersionedLookup` keeps a lookup as numbered versions instead: a reader pins one for a batch or for a
whole query, and can name the one that it used.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.versions import Versions


def enrich(df: DataFrame, lookup: DataFrame | Callable[[], DataFrame], on: str | list[str] | object,
           how: str = "left") -> DataFrame:
    """``df`` joined with the lookup (left join by default, so records without a match stay)."""
    return df.join(lookup() if callable(lookup) else lookup, on=on, how=how)


class VersionedLookup:
    """A lookup table at ``path``, published as numbered versions (0, 1, ...), each whole and never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._log = Versions(spark, f"{path}/versions")

    def publish(self, rows: DataFrame) -> int:
        """Write ``rows`` as the next version; its number is returned once readers can see it."""
        data = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{data}")
        return self._log.append({"data": data, "schema": rows.schema.json()})

    def newest(self) -> int:
        """Number of the newest version; an error if there is none."""
        number = self._log.last()
        if number < 0:
            raise ValueError(f"no version of the lookup {self.path} is published")
        return number

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version (the newest one by default)."""
        import json

        from pyspark.sql.types import StructType

        entry = self._log.read(self.newest() if number is None else number)
        return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(f"{self.path}/{entry['data']}")
