"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The edges written out, and their number and checksum, observed while they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    out = cut(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), name)
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``: long) but the roots themselves; the root is
    the least node of the component.

    Each round hangs every node below the least of its neighbours, first its larger neighbours, then the
    smaller ones. Only minima are aggregated and edges joined with them, so a node with very many
    neighbours is never gathered in one place. The number of rounds grows with the logarithm of the
    longest chain. Every round is written to the shared folder.
    """
    now, state = _written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while state != before and state[0]:
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are written before they are joined: Spark can then broadcast them, or split a hot node
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = cut(both.where("b > a").join(least, "a").where("b <> m")
                    .select(F.col("b").alias("a"), F.col("m").alias("b")), "large-star")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b") \
            .unionByName(least.select("a", F.col("m").alias("b")))
        now, state = _written(small.distinct(), "small-star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
