"""Column expressions: all JVM-side built-ins, so they stay inside whole-stage codegen.

Fixed values that must match the producer/consumer contract:

* commit point text: ``{yyyyMMdd}/{bb}00/{ms}``, read back with the whole-string pattern
  ``([0-9]{8})/([0-9]{2})00/([0-9]*)``; ``ms`` equal to the text ``0`` means "restart that date at batch 0"
* batch folder number: Java format ``%0,2d`` followed by the text ``00`` (3 -> ``0300``, 1000 -> ``1,00000``)
* dates: ``yyyyMMdd`` strings, ordered as strings
* partitioner names: ``hash`` (the default), ``random``, otherwise a partition number
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------------------------
COMMIT_PATTERN = r"^([0-9]{8})/([0-9]{2})00/([0-9]*)$"
BATCH_FORMAT = "%0,2d00"
DATE_FORMAT = "yyyyMMdd"
PARTITIONER_HASH = "hash"
PARTITIONER_RANDOM = "random"
RESTART_MS = "0"
# -------------------------------------------------------------------------------------------

_EPOCH_NTZ = _dt.datetime(1970, 1, 1)
_TWO_POW_64 = 1 << 64

OUTCOMES = ("ignored", "redo", "switch", "commit", "abort")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def epoch_micros_sql(name: str, data_type: T.DataType | None = None) -> str:
    """SQL text of :func:`epoch_micros` for a named column (one expression, one plan call)."""
    q = ident(name)
    if isinstance(data_type, T.TimestampType):
        return f"unix_micros({q})"
    return (f"(CAST(datediff(to_date({q}), DATE'1970-01-01') AS BIGINT) * 86400000000"
            f" + CAST(hour({q}) * 3600 + minute({q}) * 60 AS BIGINT) * 1000000"
            f" + CAST(extract(SECOND FROM {q}) * 1000000 AS BIGINT))")


def epoch_micros(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """Microseconds since 1970-01-01 of a timestamp column.

    Zoned timestamps: ``unix_micros``. ``timestamp_ntz`` (the driver tables): built from the calendar
    day and the time of day, which involves no time zone -- a cast to a zoned timestamp would shift
    wall-clock times across daylight-saving changes of the session time zone."""
    if isinstance(c, str):
        return F.expr(epoch_micros_sql(c, data_type))
    col = c
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(col)
    days = F.datediff(F.to_date(col), F.lit(_EPOCH_NTZ.date()))
    clock = (F.hour(col) * 3600 + F.minute(col) * 60).cast("bigint") * F.lit(1_000_000)
    frac = (F.extract(F.lit("SECOND"), col) * F.lit(1_000_000)).cast("bigint")
    return days.cast("bigint") * F.lit(86_400_000_000) + clock + frac


def epoch_micros_of(df: DataFrame, name: str) -> Column:
    return epoch_micros(name, df.schema[name].dataType)


def floor_sql(q: str, width: int) -> str:
    """SQL text: ``q`` rounded down to a multiple of ``width`` (exact long arithmetic)."""
    return f"({q} - pmod({q}, {int(width)}))"


def div_floor_sql(q: str, width: int) -> str:
    """SQL text: ``floor(q / width)`` (integral ``DIV`` of an exact multiple)."""
    return f"({floor_sql(q, width)} DIV {int(width)})"


def floor_to(us: Column | str, width: int) -> Column:
    """``us`` rounded down to a multiple of ``width`` in exact long arithmetic."""
    if isinstance(us, str):
        return F.expr(floor_sql(ident(us), width))
    return (us - F.pmod(us, F.lit(width))).cast("bigint")


def div_floor(us: Column | str, width: int) -> Column:
    """``floor(us / width)`` in exact long arithmetic."""
    if isinstance(us, str):
        return F.expr(div_floor_sql(ident(us), width))
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("bigint")


# PRJ-1 ---------------------------------------------------------------------------------------
def record_value(df: DataFrame, value: str = "value") -> DataFrame:
    """Drop the key and keep the value decoded as UTF-8; invalid bytes become U+FFFD as a
    Java string decoder would do."""
    return df.select(F.expr(f"make_valid_utf8(cast(`{value}` as string))").alias("value"))


# PRJ-2 ---------------------------------------------------------------------------------------
def _md5_head(c: Column) -> Column:
    # first 64 bits of the MD5 digest as 16 hex digits; md5() hashes the UTF-8 bytes of a string
    return F.substring(F.md5(c), 1, 16)


def sign64(c: Column | str, algo: str = "md5") -> Column:
    """Unsigned 64-bit fingerprint as a decimal string (Java and Spark have no unsigned long).
    Null in, null out. ``algo``: ``md5`` (first 8 bytes of MD5) or ``xxhash64`` (Spark's, seed 42)."""
    col = _c(c)
    if algo == "md5":
        return F.conv(_md5_head(col), 16, 10)
    if algo == "xxhash64":
        return F.when(col.isNull(), F.lit(None)).otherwise(F.conv(F.hex(F.xxhash64(col)), 16, 10))
    raise ValueError(f"unknown fingerprint algorithm {algo!r}")


def sign64_signed(c: Column | str, algo: str = "md5") -> Column:
    """The same fingerprint as a signed ``bigint`` (two's complement of the unsigned value)."""
    col = _c(c)
    if algo == "md5":
        return F.conv(_md5_head(col), 16, -10).cast("bigint")
    if algo == "xxhash64":
        return F.when(col.isNull(), F.lit(None)).otherwise(F.xxhash64(col))
    raise ValueError(f"unknown fingerprint algorithm {algo!r}")


# PRJ-3 ---------------------------------------------------------------------------------------
def unsigned_mod(signed: Column, n: int) -> Column:
    """``(signed as unsigned 64-bit) % n`` in long arithmetic.

    For a negative ``s`` the unsigned value is ``s + 2**64``, so the remainder is
    ``pmod(pmod(s, n) + (2**64 % n), n)``; both terms are below ``n``, so nothing overflows.
    ``pmod`` on the signed value alone is wrong unless ``n`` is a power of two.
    """
    if n <= 0:
        raise ValueError("partition count must be positive")
    wrap = _TWO_POW_64 % n
    return F.pmod(F.pmod(signed, F.lit(n)) + F.when(signed < 0, F.lit(wrap)).otherwise(F.lit(0)), F.lit(n)).cast("int")


def hash_partition(c: Column | str, n: int, algo: str = "md5") -> Column:
    """Partition of a key: unsigned fingerprint modulo the partition count; null key -> null."""
    return unsigned_mod(sign64_signed(c, algo), n)


# PRJ-4 ---------------------------------------------------------------------------------------
def partition_for(mode: str | int, key: Column | str = "key", num_partitions: int | None = None) -> Column:
    """Partition column for a partitioner setting: ``hash`` (default), ``random`` (null: the client
    picks), or a number (a negative number behaves like ``random``)."""
    if mode == PARTITIONER_HASH:
        if not num_partitions:
            raise ValueError("hash partitioning needs num_partitions")
        return hash_partition(key, num_partitions)
    if mode == PARTITIONER_RANDOM:
        return F.lit(None).cast("int")
    k = int(mode)
    return F.lit(k if k >= 0 else None).cast("int")


def assign_partition(df: DataFrame, mode: str | int = PARTITIONER_HASH, key: str = "key",
                     num_partitions: int | None = None, out: str = "partition") -> DataFrame:
    return df.withColumn(out, partition_for(mode, key, num_partitions))


# PRJ-5 ---------------------------------------------------------------------------------------
def parse_commit(c: Column | str) -> Column:
    """Parse a commit point ``{date}/{bb}00/{ms}`` into
    ``struct(commit_date, commit_batch, commit_ms, next_batch, valid)``.

    ``ms`` equal to ``0``: restart that date at batch 0 with commit time 0. Otherwise the next
    batch is ``bb + 1``. An empty or out-of-range ``ms`` or a text that does not match the whole
    pattern is invalid; invalid rows carry nulls. Null in -> invalid.
    """
    if isinstance(c, str):
        return F.expr(parse_commit_sql(ident(c)))
    col = c
    matched = col.rlike(COMMIT_PATTERN)
    date = F.regexp_extract(col, COMMIT_PATTERN, 1)
    batch = F.regexp_extract(col, COMMIT_PATTERN, 2).cast("int")
    ms_text = F.regexp_extract(col, COMMIT_PATTERN, 3)
    restart = ms_text == F.lit(RESTART_MS)
    ms = F.when(restart, F.lit(0).cast("bigint")).otherwise(ms_text.try_cast("bigint"))
    valid = matched & ms.isNotNull()
    return F.struct(
        F.when(valid, date).alias("commit_date"),
        F.when(valid, batch).alias("commit_batch"),
        F.when(valid, ms).alias("commit_ms"),
        F.when(valid, F.when(restart, F.lit(0)).otherwise(batch + 1)).alias("next_batch"),
        valid.alias("valid"),
    )


def parse_commit_sql(q: str) -> str:
    """SQL text of :func:`parse_commit` for the SQL expression ``q`` (one plan call)."""
    pat = COMMIT_PATTERN
    ms_text = f"regexp_extract({q}, '{pat}', 3)"
    ms = f"(CASE WHEN {ms_text} = '{RESTART_MS}' THEN CAST(0 AS BIGINT) ELSE try_cast({ms_text} AS BIGINT) END)"
    valid = f"(({q} RLIKE '{pat}') AND {ms} IS NOT NULL)"
    batch = f"CAST(regexp_extract({q}, '{pat}', 2) AS INT)"
    return ("named_struct("
            f"'commit_date', CASE WHEN {valid} THEN regexp_extract({q}, '{pat}', 1) END, "
            f"'commit_batch', CASE WHEN {valid} THEN {batch} END, "
            f"'commit_ms', CASE WHEN {valid} THEN {ms} END, "
            f"'next_batch', CASE WHEN {valid} THEN (CASE WHEN {ms_text} = '{RESTART_MS}' THEN 0 ELSE {batch} + 1 END) END, "
            f"'valid', {valid})")


# PRJ-6 ---------------------------------------------------------------------------------------
def batch_folder(batch: Column | str) -> Column:
    """In-day batch folder name: 3 -> ``0300``, 12 -> ``1200``, 100 -> ``10000``; null -> null."""
    b = _c(batch)
    return F.when(b.isNotNull(), F.format_string(BATCH_FORMAT, b))


def batch_path(date: Column | str, batch: Column | str) -> Column:
    """``{date}/{bb}00`` (null when either part is null)."""
    return F.concat(_c(date), F.lit("/"), batch_folder(batch))


def commit_point(date: Column | str, batch: Column | str, batch_time_ms: Column | str) -> Column:
    """``{date}/{bb}00/{ms}`` (null when any part is null)."""
    return F.concat(_c(date), F.lit("/"), batch_folder(batch), F.lit("/"), _c(batch_time_ms).cast("string"))


# PRJ-7 ---------------------------------------------------------------------------------------
def to_day(c: Column | str) -> Column:
    """Date of a ``yyyyMMdd`` text (first 8 characters); impossible dates are null."""
    return F.try_to_date(F.substring(_c(c), 1, 8), DATE_FORMAT)


def next_day(c: Column | str) -> Column:
    """Next calendar day of a ``yyyyMMdd`` string; null for an impossible date."""
    return F.date_format(F.date_add(to_day(c), 1), DATE_FORMAT)


def day_text(c: Column | str) -> Column:
    """``yyyyMMdd`` of a timestamp/date column."""
    return F.date_format(_c(c), DATE_FORMAT)


# PRJ-8 ---------------------------------------------------------------------------------------
def batch_outcome(notified: Column | str, batch_time: Column | str, commit_time: Column | str,
                  num_records: Column | str, sync: Column | str, trace: Column | str,
                  failed: Column | str) -> Column:
    """What the tracker does with one completed batch, given its state.

    Checked in order: already notified -> ``ignored``; not newer than the last commit -> ``redo``;
    empty while every upstream is at or past the traced date -> ``switch``; no failed output ->
    ``commit``; else ``abort``. A missing sync (no upstream) never switches.
    """
    n = _c(num_records)
    return (
        F.when(_c(notified), F.lit("ignored"))
        .when(_c(batch_time) <= _c(commit_time), F.lit("redo"))
        .when((n == 0) & F.coalesce(_c(sync) >= _c(trace), F.lit(False)), F.lit("switch"))
        .when(F.coalesce(_c(failed), F.lit(0)) == 0, F.lit("commit"))
        .otherwise(F.lit("abort"))
    )


def batch_delayed(outcome: Column | str, num_records: Column | str) -> Column:
    """An empty batch that was committed (its upstream not yet past the date): the batch probably
    arrived late. The reference only logs it; here it is a column."""
    return (_c(outcome) == F.lit("commit")) & (_c(num_records) == 0)
