"""Batch output and the ledger of published batches (SNK-2, SNK-3, SNK-4).

* :func:`write_batch`   -- one micro-batch as gzip text under ``{root}/{date}/{bb}00/data``;
  ``overwrite`` makes a replayed batch idempotent.
* :func:`write_by_key`  -- route each record to an output named by its key (the key is not written);
  a salt spreads a hot key over several tasks, each writing its own file in the key's folder.
* :func:`write_batch_by_key` -- the same for one micro-batch, as Parquet (line feeds and nulls stay).
* ledger               -- one appended row per published batch ``(proc, date, batch, batch_time,
  num_records, commit, published_at, query_id, files, counters, versions)``; readers take its files (SRC-3) and
  ``latest`` is an aggregate over it. ``query_id`` names the checkpoint whose query wrote the batch, ``files``
  the files that hold it, below the output's root; ``counters`` what the algorithm counted while it was written,
  and ``versions`` the lookups that it used.
  One row replaces the reference's three steps (ready marker, commit point, latest), so there is no
  window in which data is ready but the commit is missing.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import batch_path, commit_point
from tidemark.operators.batches import batch_dir
from tidemark.session import session_conf

LEDGER_PARTITIONS = ("proc", "date")
LEDGER_SCHEMA = ("proc string, date string, batch int, batch_time bigint, num_records bigint, "
                 "commit string, published_at timestamp, query_id string, files array<string>, "
                 "counters map<string,bigint>, versions map<string,bigint>")
LEDGER_COLUMNS = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
# fixed value: stands for the empty key in folder names; keys that begin with it get one more
EMPTY_KEY = "@"


def batch_location(root: str, date: str, batch: int) -> str:
    return f"{root.rstrip('/')}/{batch_dir(date, batch)}/data"


def write_batch(df: DataFrame, root: str, date: str, batch: int, value: str = "value") -> str:
    path = batch_location(root, date, batch)
    (df.select(F.col(value).cast("string").alias("value"))
     .write.mode("overwrite").option("compression", "gzip").text(path))
    return path


def write_by_key(df: DataFrame, path: str, key: str = "key", value: str = "value",
                 num_partitions: int | None = None) -> None:
    """``{path}/{key}={k}/part-*.gz`` text files of the values (the key is not written).

    ``REBALANCE(key)`` clusters each key into few tasks so a folder gets few files, and lets AQE
    split a key holding a third of the rows over several tasks (several files in its folder)
    instead of one. A folder name cannot be empty, so the empty key is written as :data:`EMPTY_KEY`; null
    keys go to Spark's default partition folder. :func:`read_by_key` gives every key back as it was."""
    k = F.col(key).cast("string")
    marked = F.when((k == "") | k.startswith(EMPTY_KEY), F.concat(F.lit(EMPTY_KEY), k)).otherwise(k)
    routed = df.select(marked.alias(key), F.col(value).cast("string").alias("value"))
    hint = (num_partitions, key) if num_partitions else (key,)
    (routed.hint("rebalance", *hint)
     .write.mode("overwrite").partitionBy(key).option("compression", "gzip").text(path))


def routed_location(root: str, date: str, batch: int) -> str:
    return f"{root.rstrip('/')}/date={date}/batch={int(batch)}"


def write_batch_by_key(df: DataFrame, root: str, date: str, batch: int, key: str = "key", value: str = "value") -> str:
    """One micro-batch routed by key: ``{root}/date=../batch=../{key}=../part-*.parquet`` with the values as they
    are (any type; line feeds, null and empty values stay). The batch's folder is replaced as a whole, so a
    replay leaves nothing of an earlier attempt, also where a key is gone. Keys as in :func:`write_by_key`."""
    k = F.col(key).cast("string")
    marked = F.when((k == "") | k.startswith(EMPTY_KEY), F.concat(F.lit(EMPTY_KEY), k)).otherwise(k)
    path = routed_location(root, date, batch)
    (df.select(marked.alias(key), F.col(value).alias("value")).hint("rebalance", key)
     .write.mode("overwrite").partitionBy(key).parquet(path))
    return path


def data_files(spark: SparkSession, root: str, path: str) -> list[str]:
    """Data files under ``path``, named from ``root``, sorted: the manifest of a batch that was just written."""
    jvm = spark.sparkContext._jvm
    base, top = jvm.org.apache.hadoop.fs.Path(root.rstrip("/")), jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = fs.makeQualified(base).toString().rstrip("/") + "/"
    found, listed = [], fs.listFiles(top, True)
    while listed.hasNext():
        f = listed.next().getPath()
        if not f.getName().startswith(("_", ".")):
            found.append(f.toString()[len(prefix):])
    return sorted(found)


def write_batches(df: DataFrame, root: str, partition_cols: list[str], value: str = "value") -> None:
    """Backfill many batches in one job: ``{root}/{col}={v}/.../part-*.gz`` per batch, rebalanced
    on the batch columns (AQE splits an oversized batch, merges tiny ones)."""
    out = (df.select(*partition_cols, F.col(value).cast("string").alias("value"))
           .hint("rebalance", *partition_cols))
    # many small folders: coalescing by bytes would hand thousands of folders to one task, so keep
    # the shuffle's parallelism for this write (skewed partitions are still split)
    with session_conf(df.sparkSession, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        out.write.mode("overwrite").partitionBy(*partition_cols).option("compression", "gzip").text(root)


def read_by_key(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """Values routed by :func:`write_by_key` with their key: the folder name as text, so that ``007`` and
    ``1.0`` stay what they are."""
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        data = spark.read.text(path)
    k = F.col(key)
    return data.select(F.when(k.startswith(EMPTY_KEY), F.expr(f"substring(`{key}`, {len(EMPTY_KEY) + 1})"))
                       .otherwise(k).alias(key), "value")


def ledger_rows(spark: SparkSession, proc: str, date: str, batch: int, batch_time: int, num_records: int,
                query_id: str | None = None, files: list[str] | None = None, counters: dict[str, int] | None = None,
                versions: dict[str, int] | None = None) -> DataFrame:
    # one row from one literal: no Python rows are shipped to the executors for it
    row = {"proc": proc, "date": date, "batch": int(batch), "batch_time": int(batch_time), "num_records": int(num_records),
           "commit": f"{batch_dir(date, batch)}/{int(batch_time)}", "query_id": query_id, "files": files,
           "counters": counters, "versions": versions}
    now = int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1_000_000)
    made = spark.range(0, 1, 1, 1).select(F.from_json(F.lit(json.dumps(row)), LEDGER_SCHEMA).alias("r")).select("r.*")
    return made.withColumn("published_at", F.timestamp_micros(F.lit(now))).select(*LEDGER_COLUMNS)


def append_ledger(rows: DataFrame, ledger_path: str) -> None:
    """Append ledger rows, partitioned by processor and date: a lookup of one batch (the replay check
    of every micro-batch) reads one folder, not the whole history."""
    (rows.select(*LEDGER_COLUMNS).hint("rebalance", *LEDGER_PARTITIONS).write.mode("append").partitionBy(*LEDGER_PARTITIONS).parquet(ledger_path))


def publish_batch(spark: SparkSession, ledger_path: str, proc: str, date: str, batch: int, batch_time: int,
                  num_records: int, query_id: str | None = None, files: list[str] | None = None,
                  counters: dict[str, int] | None = None, versions: dict[str, int] | None = None) -> None:
    """Append the batch's ledger row (after its data is written): one small file, no shuffle."""
    rows = ledger_rows(spark, proc, date, batch, batch_time, num_records, query_id, files, counters, versions)
    rows.write.mode("append").partitionBy(*LEDGER_PARTITIONS).parquet(ledger_path)


def compact_ledger(spark: SparkSession, ledger_path: str, to: str) -> None:
    """Copy the ledger to a new folder with few files per processor and date (one row is one file as
    published); readers switch to the new folder."""
    append_ledger(read_ledger(spark, ledger_path), to)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger with the columns of :data:`LEDGER_SCHEMA`; filters on ``proc``/``date`` prune folders."""
    with session_conf(spark, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        led = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    return led.select(*LEDGER_COLUMNS)


def ledger_folder(spark: SparkSession, ledger_path: str, proc: str, date: str) -> str:
    """The folder of a processor's date, its names escaped as Spark's own writer does it."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([ledger_path.rstrip("/"), names.getPartitionPathString("proc", proc),
                     names.getPartitionPathString("date", date)])


def ledger_entry(spark: SparkSession, ledger_path: str, proc: str, date: str, batch: int):
    """The ledger row of ``(proc, date, batch)`` or ``None``: lists and reads the one folder of the
    processor's date, whatever else the ledger holds."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger_folder(spark, ledger_path, proc, date))
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    own = ", ".join(c for c in LEDGER_SCHEMA.split(", ") if c.split()[0] not in LEDGER_PARTITIONS)
    return spark.read.schema(own).parquet(folder.toString()).where(F.col("batch") == batch).first()


def ledger_from_replay(replayed: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Ledger rows of the ``commit`` outcomes of a replay (the batches that would be published)."""
    commits = replayed.where(F.col("outcome") == "commit")
    if log is not None:
        commits = commits.join(log.select("proc", "batch_time", "num_records"), on=["proc", "batch_time"], how="left")
    else:
        commits = commits.withColumn("num_records", F.lit(None).cast("bigint"))
    return commits.select(
        "proc", F.col("trace").alias("date"), F.col("batch_num").alias("batch"), "batch_time",
        F.col("num_records").cast("bigint").alias("num_records"),
        commit_point("trace", "batch_num", "batch_time").alias("commit"),
        F.timestamp_millis("batch_time").alias("published_at"),
        F.lit(None).cast("string").alias("query_id"),
        F.lit(None).cast("array<string>").alias("files"),
        F.lit(None).cast("map<string,bigint>").alias("counters"),
        F.lit(None).cast("map<string,bigint>").alias("versions"),
    )


def latest_commits(ledger: DataFrame) -> DataFrame:
    """``(proc, commit, latest, batches)``: the last commit point of each processor (by date and batch: a
    clock may run backwards) and its ``latest`` (``{date}/{bb}00``); one partially aggregated ``groupBy``."""
    order = F.struct("date", "batch")
    return ledger.groupBy("proc").agg(
        F.max_by("commit", order).alias("commit"),
        F.max_by(batch_path("date", "batch"), order).alias("latest"),
        F.count(F.lit(1)).alias("batches"),
    )


def counter_totals(ledger: DataFrame) -> DataFrame:
    """``(proc, name, value)``: the counters of all published batches, summed (AGG-5). A batch has one ledger row,
    however often it was replayed, so each counts once."""
    each = ledger.select("proc", F.explode("counters").alias("name", "value"))
    return each.groupBy("proc", "name").agg(F.sum("value").alias("value"))
