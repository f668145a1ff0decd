"""Resume a keyed sequence after a stored counter (FLT-2), with an exact per-key sequence number
that does not put a whole key into one task.

``row_number() OVER (PARTITION BY key ORDER BY t)`` sorts every row of a key in one task; with one
key holding a third of the data that task is the job. :func:`sequence_numbers` splits a key over
range partitions instead and adds per-partition offsets from a small count table.

:class:`HighWater` keeps how far each key has got after a batch, and :func:`number_batch` numbers the next
batch on from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.enrich import enrich
from tidemark.session import materialize
from tidemark.sinks.versions import WIDTH


def sequence_numbers(df: DataFrame, by: str, ts: str, tiebreak: list[str], out: str = "seq",
                     num_partitions: int | None = None) -> DataFrame:
    """``df`` (all its columns) plus ``out``: 0-based position of each row within its key in
    ``(ts, *tiebreak)`` order, which must be unique within a key.

    Rows are range-partitioned on ``(by, ts, *tiebreak)``, sorted inside partitions and written once to the
    shared checkpoint folder with their partition and position. Range partitions are drawn by sampling, so
    a second evaluation could cut them elsewhere; positions and counts are therefore both read from that
    one table. A row's number is its position plus the rows of its key in earlier partitions, taken from a
    table with one row per (partition, key).
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(by), F.col(ts), *[F.col(c) for c in tiebreak]]
    ranged = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id()), "sequence")
    stats = ranged.groupBy("_pid", by).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    # null-safe on the key, so rows with a null key are numbered too (as one more key)
    o = offsets.select(F.col("_pid").alias("_opid"), F.col(by).alias("_okey"), "_first", "_off")
    cond = (F.col("_pid") == F.col("_opid")) & F.col(by).eqNullSafe(F.col("_okey"))
    return (ranged.join(o, on=cond, how="inner")
            .withColumn(out, (F.col("_off") + F.col("_pos") - F.col("_first")).cast("bigint"))
            .drop("_pid", "_pos", "_first", "_off", "_opid", "_okey"))


def resume_after(df: DataFrame, seq: str, counters: DataFrame, by: str, name: str = "name",
                 value: str = "value") -> DataFrame:
    """Rows whose 0-based ``seq`` is at or after the key's counter (the number of records already
    sent); a key without a counter starts at 0."""
    c = counters.select(F.col(name).alias(by), F.col(value).alias("_resume_at"))
    return (enrich(df, c, on=by, how="left")
            .where(F.col(seq) >= F.coalesce(F.col("_resume_at"), F.lit(0)))
            .drop("_resume_at"))


class HighWater:
    """Records numbered so far per key, as marks at ``path``: one folder ``{position}-{kind}`` per batch, where the
    position orders the batches. A batch writes the marks of the keys it has (``part``), every ``full_every``-th
    one those of all keys (``all``). What holds before a batch is read from the last full folder before it and the
    parts in between, whatever later batches have written: a replay numbers as the first attempt did and writes
    the same marks again."""

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str = "string", full_every: int = 16):
        self.spark, self.path, self.key, self.full_every = spark, path.rstrip("/"), key, full_every
        self.schema = f"`{key}` {key_type}, mark bigint"

    @staticmethod
    def position(date: str, batch: int) -> str:
        """Place of a batch among all: by date (eight digits), then by number."""
        if len(date) != 8 or not date.isdigit():
            raise ValueError(f"a date has eight digits: {date!r}")
        return f"{date}.{int(batch):0{WIDTH}d}"

    def _folders(self, before: str) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(top):
            return []
        names = sorted(s.getPath().getName() for s in fs.listStatus(top) if s.isDirectory())
        # only folders that were written to the end
        names = [n for n in names if n.split("-")[0] < before and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        last = max((i for i, n in enumerate(names) if n.endswith("-all")), default=0)
        return names[last:]

    def before(self, date: str, batch: int) -> DataFrame:
        """``(key, mark)`` before a batch: the number that a key's next record gets; keys not seen yet are absent."""
        names = self._folders(self.position(date, batch))
        if not names:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{n}" for n in names])
        return rows.groupBy(self.key).agg(F.max("mark").alias("mark"))  # marks only rise

    def save(self, date: str, batch: int, marks: DataFrame) -> None:
        """Write the marks after a batch: ``(key, mark)`` of its keys."""
        at = self.position(date, batch)
        full = len(self._folders(at)) >= self.full_every
        if full:
            marks = marks.unionByName(self.before(date, batch)).groupBy(self.key).agg(F.max("mark").alias("mark"))
        marks.select(self.key, "mark").write.mode("overwrite").parquet(f"{self.path}/{at}-{'all' if full else 'part'}")


def number_batch(df: DataFrame, by: str, ts: str, tiebreak: list[str], marks: HighWater, date: str, batch: int,
                 out: str = "seq") -> DataFrame:
    """One micro-batch numbered on from the batches before it: ``df`` plus ``out``, the 0-based number of each
    row within its key, by batch and within the batch by ``(ts, *tiebreak)``, which must be unique there. The
    marks after the batch are saved; numbering a batch again gives the same numbers. A null key is a key."""
    numbered = sequence_numbers(df, by, ts, tiebreak, out="_in_batch")
    high = marks.before(date, batch).select(F.col(marks.key).alias("_key"), F.col("mark").alias("_mark"))
    done = materialize(numbered.join(high, F.col(by).eqNullSafe(F.col("_key")), "left")
                       .withColumn(out, F.col("_in_batch") + F.coalesce("_mark", F.lit(0)))
                       .drop("_key", "_mark", "_in_batch"), "numbered")
    marks.save(date, batch, done.groupBy(F.col(by).alias(marks.key)).agg((F.max(out) + 1).alias("mark")))
    return done
