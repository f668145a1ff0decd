"""Read only the batches that were published (SRC-3).

Batches live under ``{root}/{yyyyMMdd}/{bb}00/data`` (gzip text). A batch directory can exist without
being published (a crash between writing and the ledger append), so the ledger is the truth: its rows name
the files of each batch, and readers open those. An empty ``@ready`` marker file
would not do: Spark's file sources skip zero-length files.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import batch_path
from tidemark.operators.enrich import enrich
from tidemark.session import session_conf
from tidemark.sinks.batches import EMPTY_KEY, LEDGER_PARTITIONS, LEDGER_SCHEMA, ledger_folder

# fixed value: folder layout of a batch, read back from the file path
BATCH_PATH_PATTERN = r"/([0-9]{8})/([0-9,]+)00/data/[^/]*$"


def batch_number(folder: Column) -> Column:
    """``0300`` -> 3, ``10000`` -> 100, ``1,00000`` -> 1000 (the text before the trailing ``00``)."""
    return F.regexp_replace(folder, ",", "").cast("int")


def read_batches(spark: SparkSession, root: str, dates: list[str] | None = None) -> DataFrame:
    """``(date, batch, value)`` of every batch folder under ``root`` (or of some dates)."""
    globs = [f"{root.rstrip('/')}/{d}/*/data" for d in (dates or ["[0-9]*"])]
    df = spark.read.text(globs).select("value", F.col("_metadata.file_path").alias("_path"))
    return df.select(
        F.regexp_extract("_path", BATCH_PATH_PATTERN, 1).alias("date"),
        batch_number(F.regexp_extract("_path", BATCH_PATH_PATTERN, 2)).alias("batch"),
        "value",
    )


def published_paths(ledger: DataFrame, root: str) -> list[str]:
    """Paths of the ledger's batches: the files of their manifests, or the folder of a batch without one (each
    holds one published batch). As many names reach the driver as Spark's own file index would hold."""
    root = root.rstrip("/")
    folder = F.concat(batch_path("date", "batch"), F.lit("/data"))
    names = ledger.select(F.explode(F.coalesce("files", F.array(folder))).alias("f")).distinct()
    return sorted(f"{root}/{r['f']}" for r in names.collect())


def _values(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], "date string, batch int, value string")
    df = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_path"))
    return df.select(F.regexp_extract("_path", BATCH_PATH_PATTERN, 1).alias("date"),
                     batch_number(F.regexp_extract("_path", BATCH_PATH_PATTERN, 2)).alias("batch"), "value")


def read_committed(spark: SparkSession, root: str, ledger: DataFrame, proc: str, date: str | None = None) -> DataFrame:
    """Rows of the batches that ``proc`` has published under ``root``: ``(date, batch, value)``. The ledger
    may hold other processors' batches too: only those of ``proc`` count. Only files of published batches are
    opened (those of the ledger's manifests)."""
    own = ledger.where(F.col("proc") == proc)
    return _values(spark, published_paths(own.where(F.col("date") == date) if date else own, root))


def read_routed(spark: SparkSession, root: str, ledger: DataFrame, proc: str, key: str = "key",
                schema: str = "value string") -> DataFrame:
    """``(date, batch, key, value)`` of the published batches that
    :func:`tidemark.sinks.batches.write_batch_by_key` wrote under ``root``, by the ledger's manifests."""
    paths = published_paths(ledger.where((F.col("proc") == proc) & F.col("files").isNotNull()), root)
    if not paths:
        return spark.createDataFrame([], f"date string, batch int, `{key}` string, {schema}")
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        data = spark.read.schema(f"{schema}, date string, batch string, `{key}` string") \
            .option("basePath", root).parquet(*paths)
    k = F.col(f"`{key}`")
    return data.select("date", F.col("batch").cast("int").alias("batch"),
                       F.when(k.startswith(EMPTY_KEY), F.expr(f"substring(`{key}`, {len(EMPTY_KEY) + 1})"))
                       .otherwise(k).alias(key), "value")


class CommittedSource:
    """A processor's published batches as a stream: each batch exactly once, in the order of publication, by the
    ledger alone. Calling it with a date gives the stream of that date's ledger rows; :meth:`expand` turns the
    rows of a micro-batch into ``(key, value)`` records, opening the files of their manifests and no others.

    The runner takes it as a ``source``. ``batches_per_trigger`` bounds a micro-batch by published batches.
    """

    def __init__(self, spark: SparkSession, root: str, ledger_path: str, proc: str, batches_per_trigger: int | None = None):
        self.spark, self.root, self.ledger_path, self.proc = spark, root, ledger_path, proc
        self.batches_per_trigger = batches_per_trigger

    def __call__(self, date: str) -> DataFrame:
        own = ", ".join(c for c in LEDGER_SCHEMA.split(", ") if c.split()[0] not in LEDGER_PARTITIONS)
        rows = self.spark.readStream.schema(own)
        if self.batches_per_trigger:
            rows = rows.option("maxFilesPerTrigger", int(self.batches_per_trigger))
        folder = ledger_folder(self.spark, self.ledger_path, self.proc, date)
        # as a pattern: the folder need not be there yet
        pattern = re.sub(r"([\[\]{}*?\\])", r"\\\1", folder[:-1]) + f"[{folder[-1]}]"
        return rows.parquet(pattern).withColumn("proc", F.lit(self.proc)).withColumn("date", F.lit(date))

    def expand(self, rows: DataFrame) -> DataFrame:
        """Records of a micro-batch of ledger rows; the key is null, as published batches have none."""
        return _values(self.spark, published_paths(rows, self.root)).select(
            F.lit(None).cast("binary").alias("key"), "value")


def read_committed_partitioned(spark: SparkSession, root: str, ledger: DataFrame,
                               keys: tuple[str, ...] = ("proc", "date", "batch")) -> DataFrame:
    """Published batches of a backfill written by :func:`tidemark.sinks.batches.write_batches`
    (``{root}/proc=../date=../batch=..``): ``(keys..., value)``, semi-joined with the ledger's keys.
    Partition values are read as text and cast like the ledger's columns."""
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        data = spark.read.text(root)
    types = {f.name: f.dataType for f in ledger.schema.fields}
    # join on the raw (text) folder values; the ledger's keys are cast to text, the result cast back
    published = ledger.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()
    kept = enrich(data, published, on=list(keys), how="left_semi")
    return kept.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], "value")
