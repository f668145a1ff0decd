"""The algorithm contract (UDF-1) and two small algorithms.

An algorithm names its input producers (``resource``, a comma list) and its result dataset, and
turns one date's records into output rows. ``transform`` works on the streaming DataFrame (any
DataFrame operation is allowed); ``per_batch`` sees each micro-batch as a static DataFrame with
its in-day batch number, for logic that needs the batch (the runner writes what it returns).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.enrich import VersionedLookup, enrich


class Algorithm:
    name: str = "algorithm"
    resource: str = ""
    result: str = ""

    def transform(self, date: str, df: DataFrame) -> DataFrame:
        """Streaming (or batch) DataFrame of ``(key, value)`` -> output DataFrame with ``value``."""
        return df

    def per_batch(self, date: str, batch_id: int, df: DataFrame) -> DataFrame:
        return df

    def start_day(self, date: str) -> None:
        """Called once when a date's stream is created (not when it is resumed from a checkpoint)."""

    def start_query(self, date: str) -> None:
        """Called whenever a date's query starts, also when it is resumed."""

    def totals(self, date: str) -> dict[str, Column]:
        """Named counters: each column is summed over the output rows of a batch and kept with its ledger row."""
        return {}

    def versions(self) -> dict[str, int]:
        """Numbers of the lookups that the batch just made used, for its ledger row."""
        return {}

    #: column of the output that names where each row goes; without it a batch is one set of text files
    route_by: str | None = None


@dataclass
class ValuesAlgorithm(Algorithm):
    """The smallest algorithm: the records' values, decoded, as they come."""

    name: str = "values"
    resource: str = ""
    result: str = "values_result"

    def transform(self, date: str, df: DataFrame) -> DataFrame:
        return df.select(F.expr("make_valid_utf8(cast(value as string))").alias("value"))


@dataclass
class LookupAlgorithm(Algorithm):
    """Records joined with a small shared lookup, rebuilt for every micro-batch (JON-1).

    ``lookup_fn()`` returns ``(key_text, label)`` rows; it is called inside each batch, so a changed
    lookup is seen by the next batch (the reference kept a broadcast value until the application
    ended)."""

    name: str = "lookup"
    result: str = "lookup_result"
    lookup_fn: object = None
    key_col: str = "key_text"
    label_col: str = "label"

    def transform(self, date: str, df: DataFrame) -> DataFrame:
        return df.select(F.col("key").cast("string").alias(self.key_col),
                         F.expr("make_valid_utf8(cast(value as string))").alias("value"))

    def per_batch(self, date: str, batch_id: int, df: DataFrame) -> DataFrame:
        joined = enrich(df, self.lookup_fn, on=self.key_col, how="left")
        return joined.select(F.concat_ws("|", "value", F.coalesce(F.col(self.label_col), F.lit(""))).alias("value"))


@dataclass
class PinnedLookupAlgorithm(Algorithm):
    """Records joined with a versioned lookup (JON-1). ``refresh="batch"``: each micro-batch pins the newest
    version when it begins; ``"query"``: the query pins it when it starts and keeps it until it ends. The number
    is recorded in the batch's ledger row."""

    name: str = "pinned-lookup"
    resource: str = ""
    result: str = "pinned_lookup_result"
    lookup: VersionedLookup | None = None
    refresh: str = "batch"
    key_col: str = "key_text"
    label_col: str = "label"
    _pinned: int | None = None

    def __post_init__(self):
        if self.refresh not in ("batch", "query"):
            raise ValueError("refresh is 'batch' or 'query'")

    def start_query(self, date: str) -> None:
        self._pinned = self.lookup.newest()

    def transform(self, date: str, df: DataFrame) -> DataFrame:
        return df.select(F.col("key").cast("string").alias(self.key_col),
                         F.expr("make_valid_utf8(cast(value as string))").alias("value"))

    def per_batch(self, date: str, batch_id: int, df: DataFrame) -> DataFrame:
        if self.refresh == "batch":
            self._pinned = self.lookup.newest()
        joined = enrich(df, self.lookup.read(self._pinned), on=self.key_col, how="left")
        return joined.select(F.concat_ws("|", "value", F.coalesce(F.col(self.label_col), F.lit(""))).alias("value"))

    def versions(self) -> dict[str, int]:
        return {self.name: self._pinned}
