"""WARC archives: a deterministic sharded writer and a streaming reader.

The writer cuts the ids, in order, into shards of about equal bytes, sorts each by id, and rolls a file once its
compressed size passes a bound, so that names and bytes of the files depend on the rows alone. Headers
and digests are made anew from the rows. Of equal payloads of some size, the one of the largest id is
written as ``response`` and the others as ``revisit`` records that refer to it. Files are committed
through temporary names and a manifest (:mod:`tidemark.llm.shards`).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare
from tidemark.llm.shards import TemporaryFile, batches_of, commit, one_row_tasks, store

# ---- fixed values: names and lines of the WARC 1.1 format ---------------------------------------------
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
# --------------------------------------------------------------------------------------------------------
DATE = "2024-01-01T00:00:00Z"  # records carry no time of their own
SHARD_BYTES = 32 << 20  # payload bytes per shard, about
FILE_BYTES = 8 << 20  # a file is closed at the first record that takes it over this compressed size
REVISIT_FROM = 1_000  # smaller payloads are never revisits
LEVEL = 5


def _base32(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One gzip member with a WARC record. Line breaks in values become blanks; null values are left out."""
    lines = [VERSION, f"WARC-Type: {kind}"]
    lines += [f"{k}: {re.sub('[\r\n]+', ' ', v)}" for k, v in headers if v is not None]
    lines += [f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def record_id(page: int | None, digest: str, nth: int) -> str:
    """``nth``: 1 for the first row of an id, 2 for the second, ... (null ids: of a digest)."""
    name = f"null-{digest}" if page is None else str(page)
    return f"<urn:page:{name}>" if nth == 1 else f"<urn:page:{name}:{nth}>"


def _page_of(urn: str) -> int | None:
    return int(m[1]) if (m := re.match(r"<urn:page:(-?\d+)[:>]", urn)) else None


def shard_bounds(sizes: DataFrame, shard_bytes: int) -> np.ndarray:
    """The least id of each shard, ascending: ids in order, a new shard after every ``shard_bytes`` of records. Exact
    running sums, so the bounds depend on the rows alone, wherever ids are dense or far off. ``sizes(id, bytes)``
    is shuffled by itself; one number per shard reaches the driver (3 million for 100 TB: 25 MB)."""
    ids = sizes.groupBy("id").agg(F.sum(F.col("bytes") + 512).alias("bytes"))
    sorted_ids = cut(ids.repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id()), "id-bytes")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    parts = sorted_ids.groupBy("part").agg(F.sum("bytes").alias("all")).select(
        "part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"))
    running = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    reached = sorted_ids.join(F.broadcast(parts), "part").select(
        "id", F.floor((F.col("offset") + F.coalesce(F.sum("bytes").over(running), F.lit(0))) / F.lit(shard_bytes)).alias("shard"))
    first = reached.groupBy("shard").agg(F.min("id").alias("id")).toPandas()["id"]
    return np.sort(first.to_numpy(dtype=np.int64))


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row under ``root``; returns the manifest ``name, temporary, size, records``.

    Shards are runs of ids of about ``shard_bytes`` of records (:func:`shard_bounds`), one task each; all rows of
    one id are in one. The payload goes through one shuffle (by shard); which rows are revisits is found from ids and
    digests alone and travels with them. A task holds one record at a time.

    Null payloads are empty. A null id never is the largest; its rows go to shards by digest. Rows of one
    id are all written, in order of digest and url; if the largest id of a payload has it twice, both are
    responses. A null url leaves its header out. An empty table gives no file. Other columns are not read.
    """
    spark = pages.sparkSession
    prepare(spark)
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        body.alias("payload"), F.sha1(body).alias("digest"))
    narrow = rows.select("id", "url", "digest", F.length("payload").alias("bytes"))
    kept = cut(narrow.where(F.col("bytes") >= REVISIT_FROM).groupBy("digest")
               .agg(F.max("id").alias("target"), F.max_by("url", "id").alias("target_url"),
                    F.count(F.lit(1)).alias("n"))
               .where((F.col("n") > 1) & F.col("target").isNotNull()).drop("n"), "payloads")
    revisits = (narrow.where(F.col("bytes") >= REVISIT_FROM).select("id", "digest").join(kept, "digest")
                .where(~F.col("id").eqNullSafe(F.col("target"))))

    null_ids = narrow.where("id is null").limit(1).count()
    bounds = spark.sparkContext.broadcast(shard_bounds(narrow.where("id is not null"), shard_bytes))
    shards = max(1, len(bounds.value))

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        first = bounds.value
        return pd.Series(np.searchsorted(first, ids.fillna(0).to_numpy(dtype=np.int64), side="right") - 1)

    # a null beside longs would make floating point numbers of them, so it is told apart here
    shard = F.when(F.col("id").isNull(), -1 - F.pmod(F.xxhash64("digest"), F.lit(shards))) \
        .otherwise(place(F.coalesce("id", F.lit(0))))

    both = rows.select(shard.alias("shard"), "id", "digest", F.lit(1).alias("kind"), "url", "payload",
                       F.lit(None).cast("long").alias("target")) \
        .unionByName(revisits.select(shard.alias("shard"), "id", "digest", F.lit(0).alias("kind"),
                                     F.col("target_url").alias("url"), F.lit(None).cast("binary").alias("payload"),
                                     "target"))
    # a row's notice that it is a revisit (kind 0) sorts right before it
    # one task per shard, those of null ids after the others
    dealt = both.repartitionById(shards * (2 if null_ids else 1), F.when(
        F.col("shard") < 0, F.lit(shards - 1) - F.col("shard")).otherwise(F.col("shard")).cast("int")) \
        .sortWithinPartitions("shard", "id", "digest", "kind", "url")

    def run(batches):
        yield from batches_of(files(batches), pa.schema([("name", pa.string()), ("temporary", pa.string()),
                                                         ("size", pa.int64()), ("records", pa.int64())]))

    def files(batches):
        out, here, part, records = None, None, 0, 0
        notice, last, nth = None, None, 0
        for batch in batches:
            cols = [batch.column(i) for i in range(7)]
            for i in range(batch.num_rows):
                number, page, digest, kind, url, payload, target = (c[i].as_py() for c in cols)
                if not kind:
                    notice = (page, digest, target, url)
                    continue
                if out is not None and (number != here or out.size >= file_bytes):
                    out.close()
                    yield out.name, out.temporary, out.size, records
                    out = None
                if number != here:
                    here, part = number, 0
                if out is None:
                    label = f"n{-1 - here:08d}" if here < 0 else f"{here:08d}"
                    out, records = TemporaryFile(root, f"pages-{label}-{part:04d}.warc.gz"), 0
                    out.write(record("warcinfo", [("WARC-Record-ID", f"<urn:file:{out.name}>"), ("WARC-Date", DATE),
                                                  ("WARC-Filename", out.name),
                                                  ("Content-Type", "application/warc-fields")],
                                     b"format: WARC File Format 1.1\r\n"))
                    part += 1
                same = (page, None if page is not None else digest)
                nth = nth + 1 if same == last else 1
                last = same
                head = HTTP_HEAD.format(len(payload)).encode()
                common = [("WARC-Record-ID", record_id(page, digest, nth)), ("WARC-Date", DATE),
                          ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"),
                          ("WARC-Payload-Digest", _base32(bytes.fromhex(digest)))]
                if notice is not None and notice[:2] == (page, digest):
                    out.write(record("revisit", common + [
                        ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(notice[2], digest, 1)),
                        ("WARC-Refers-To-Target-URI", notice[3]), ("WARC-Refers-To-Date", DATE)], head))
                else:
                    out.write(record("response", common, head + payload))
                records += 1
        if out is not None:
            out.close()
            yield out.name, out.temporary, out.size, records

    manifest = dealt.mapInArrow(run, "name string, temporary string, size long, records long")
    return commit(spark, cut(manifest, "warc-manifest"), root)


def members(stream, chunk: int = 1 << 18):
    """Yield ``(offset, length, bytes)`` of each gzip member, holding one member at a time."""
    offset, data = 0, b""
    while True:
        data = data or stream.read(chunk)
        if not data:
            return
        reader, parts, length = zlib.decompressobj(31), [], 0
        while True:
            parts.append(reader.decompress(data))
            length += len(data) - len(reader.unused_data)
            if reader.eof:
                break
            data = stream.read(chunk)
            if not data:
                raise OSError(f"the gzip member at {offset} is cut short")
        yield offset, length, b"".join(parts)
        offset, data = offset + length, reader.unused_data


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record; a wrong length or block digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(headers["content-length"])
    block = rest[:size]
    if not lines[0].startswith("WARC/1.") or rest[size:] != b"\r\n\r\n":
        raise OSError("not a WARC record, or not of the length that it states")
    if headers.get("warc-block-digest", "") != _base32(hashlib.sha1(block).digest()):
        raise OSError(f"{headers.get('warc-record-id')}: wrong block digest")
    return headers, block


def read_warc(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """One row per page record of the manifest's files: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to, url, payload, file, offset, length`` (``payload`` null for a revisit). Size and
    digest of a response are taken from its bytes and must agree with its headers."""
    prepare(spark)
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                        ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64()),
                        ("length", pa.int64())])

    def records(fs, path, name, expected):
        n = 0
        with fs.open_input_stream(path, compression=None) as f:
            for offset, length, raw in members(f):
                headers, block = parse(raw)
                kind = headers["warc-type"]
                if kind not in ("response", "revisit"):
                    continue
                n += 1
                head, _, payload = block.partition(b"\r\n\r\n")
                stated = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
                digest = base64.b32decode(headers["warc-payload-digest"][5:]).hex()
                if kind == "response" and (len(payload) != stated or hashlib.sha1(payload).hexdigest() != digest):
                    raise OSError(f"{name}, {headers['warc-record-id']}: the payload is damaged")
                yield (_page_of(headers["warc-record-id"]), stated, digest, kind,
                       _page_of(headers["warc-refers-to"]) if kind == "revisit" else None,
                       headers.get("warc-target-uri"), payload if kind == "response" else None, name, offset, length)
        if n != expected:
            raise OSError(f"{name}: {n} records; the manifest has {expected}")

    def run(batches):
        fs, base = store(root)
        for batch in batches:
            for r in batch.to_pylist():
                yield from batches_of(records(fs, f"{base}/{r['name']}", r["name"], r["records"]), schema, 100)

    return one_row_tasks(manifest.select("name", "records")).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
             "url string, payload binary, file string, offset long, length long")
