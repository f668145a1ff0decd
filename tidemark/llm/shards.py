"""Files that tasks write themselves (archives, token files): temporary names, manifest, commit.

A task writes under a temporary name of its own and returns a manifest row. Spark keeps the rows of one
successful attempt of each task, so the manifest names every file once, whatever was lost or run twice
on the way. Only then are the named files moved to their final names, by a job that may be repeated.
Readers go by the manifest. Paths may be in any store that ``pyarrow.fs`` reaches.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPORARY = "_temporary"
MANIFEST = "_manifest"


def store(uri: str):
    """``(filesystem, path)`` of a folder's or file's URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class TemporaryFile:
    """A new file in the temporary folder of ``root``; ``name`` is what it is to be called."""

    def __init__(self, root: str, name: str):
        self.fs, base = store(root)
        folder = f"{base}/{TEMPORARY}"
        self.fs.create_dir(folder, recursive=True)
        self.name, self.temporary = name, f"{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(f"{folder}/{self.temporary}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()


def commit(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    """Move the files that ``manifest`` (``name``, ``temporary``, ``size`` and more columns) names to
    their final names, write the manifest beside them and return it. May be repeated."""

    def run(batches):
        fs, base = store(root)
        for batch in batches:
            for r in batch.to_pylist():
                old, new = f"{base}/{TEMPORARY}/{r['temporary']}", f"{base}/{r['name']}"
                have = fs.get_file_info([old, new])
                if have[0].size == r["size"]:
                    fs.move(old, new)
                elif have[1].size != r["size"]:
                    raise OSError(f"{new}: neither it nor its temporary file has {r['size']} bytes")
            yield batch

    done = manifest.mapInArrow(run, manifest.schema)
    done.write.mode("overwrite").parquet(f"{root}/{MANIFEST}")
    return spark.read.schema(manifest.schema).parquet(f"{root}/{MANIFEST}")


def one_row_tasks(manifest: DataFrame) -> DataFrame:
    """One file per task, dealt evenly."""
    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, F.col("name"))


def batches_of(rows, schema: pa.Schema, size: int = 10_000):
    """Record batches of at most ``size`` rows from an iterator of tuples."""
    part = []
    for r in rows:
        part.append(r)
        if len(part) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*part, strict=True), schema.types, strict=True)], schema=schema)
