"""Read a folder of counter files as a table (SRC-4).

Fixed format of a counter file: one unsigned 32-bit number, 4 bytes, big-endian (network order); an
empty file means 0; any other length is an error. ``{name}.tmp`` is an update in progress and is
used only when ``{name}`` itself is missing.

Spark's file sources skip zero-length files, so the (few) empty ones are found by listing the
folder's file metadata through the Hadoop file system of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TMP_SUFFIX = ".tmp"
COUNTER_BYTES = 4


def _empty_files(spark: SparkSession, folder: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return [st.getPath().getName() for st in fs.listStatus(path) if st.isFile() and st.getLen() == 0]


def read_counters(spark: SparkSession, folder: str, names: DataFrame | None = None) -> DataFrame:
    """``(name, value BIGINT, error STRING)`` -- one row per counter name; ``names(name)`` adds
    names that have no file at all (value 0, as a fresh counter)."""
    files = (spark.read.format("binaryFile").load(folder)
             .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("_file"), "length", "content"))
    decoded = files.select(
        "_file",
        F.when(F.col("length") == COUNTER_BYTES, F.conv(F.hex("content"), 16, 10).cast("bigint")).alias("value"),
        F.when(F.col("length") != COUNTER_BYTES,
               F.format_string("counter file of %d bytes", F.col("length"))).alias("error"),
    )
    empties = _empty_files(spark, folder)
    if empties:
        decoded = decoded.unionByName(spark.createDataFrame(
            [(n, 0, None) for n in empties], "_file string, value bigint, error string"))
    is_tmp = F.col("_file").endswith(TMP_SUFFIX)
    tagged = decoded.select(
        F.when(is_tmp, F.expr(f"substring(_file, 1, length(_file) - {len(TMP_SUFFIX)})"))
        .otherwise(F.col("_file")).alias("name"),
        is_tmp.alias("_tmp"), "value", "error")
    # the real file wins over its .tmp twin (false < true)
    best = tagged.groupBy("name").agg(F.min_by(F.struct("value", "error"), "_tmp").alias("_c"))
    out = best.select("name", F.col("_c.value").alias("value"), F.col("_c.error").alias("error"))
    if names is not None:
        out = (names.select("name").distinct().join(out, on="name", how="full")
               .select("name", F.when(F.col("error").isNull(), F.coalesce("value", F.lit(0).cast("bigint")))
                       .alias("value"), "error"))
    return out


def encode_counter(value: int) -> bytes:
    """Bytes of a counter file (for writers and tests)."""
    if not 0 <= value < 1 << 32:
        raise ValueError("counter out of the unsigned 32-bit range")
    return int(value).to_bytes(COUNTER_BYTES, "big")


def write_counter_files(spark: SparkSession, folder: str, counters: dict[str, bytes]) -> None:
    """Write small counter files through the session's Hadoop file system (works on any shared FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, data in counters.items():
        p = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        fs = p.getFileSystem(conf)
        out = fs.create(p, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
