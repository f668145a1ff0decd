"""Numbered entries in a shared folder: what a table's writers publish and its readers list.

An entry is one small text file ``{path}/{number}``, written beside and moved into place with a rename that
fails where the number is taken (the rename with which Structured Streaming publishes its offsets). So an
entry is there as a whole or not at all, and of several writers one gets the number. Entries name the data
they publish; the data are written before. Like Spark's own checkpoints, this needs a file system whose rename
is atomic (HDFS, local disks).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

WIDTH = 20  # digits of a number in a file's name, so that names sort as numbers do


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._folder = self._hadoop.Path(self.path)
        self._files = self._folder.getFileSystem(self._conf)
        self._known = -1  # a number that is taken, as all below it are

    def numbers(self, after: int = -1) -> list[int]:
        """Numbers of the entries above ``after``, ascending."""
        if not self._files.exists(self._folder):
            return []
        names = (s.getPath().getName() for s in self._files.listStatus(self._folder))
        return sorted(int(n) for n in names if n.isdigit() and int(n) > after)

    def last(self) -> int:
        return max(self.numbers(), default=-1)

    def read(self, number: int) -> dict:
        stream = self._files.open(self._hadoop.Path(self._folder, f"{number:0{WIDTH}d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def publish(self, number: int, entry: dict) -> bool:
        """Publish an entry under a number; False if it is taken."""
        final = self._hadoop.Path(self._folder, f"{number:0{WIDTH}d}")
        if self._files.exists(final):
            return False
        beside = self._hadoop.Path(self._folder, f".{number}-{uuid.uuid4().hex}.tmp")
        out = self._files.create(beside, False)
        out.write(bytearray(json.dumps(entry).encode("utf-8")))
        out.close()
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        keep = gateway.new_array(self._hadoop.Options.Rename, 1)
        keep[0] = getattr(self._hadoop.Options.Rename, "NONE")
        place = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        try:
            place.rename(self._files.makeQualified(beside), self._files.makeQualified(final), keep)
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            self._files.delete(beside, False)
            return False
        return True

    def append(self, entry: dict) -> int:
        """Publish an entry under the next free number, which is returned."""
        number = (self._known if self._known >= 0 else self.last()) + 1
        while not self.publish(number, entry):
            number += 1
        self._known = number
        return number

    def remove(self, number: int) -> None:
        self._files.delete(self._hadoop.Path(self._folder, f"{number:0{WIDTH}d}"), False)
