"""Small records that appear whole or not at all, and once only.

A record is written under another name and renamed to its own without
overwriting (``FileContext.rename`` with ``NONE``): readers see the whole record
or none, and of two writers of one name the first wins.  HDFS checks and renames
in one step.  A local file system does not, so there the record gets its name by
a hard link, which fails when the name is taken.  On an object store the rename
is a copy of one small object, whole as well, and the single writer per stream
that Spark's checkpoint enforces makes the existence check safe.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Up to so many records are opened one by one; beyond, Spark reads them in parallel.
FEW = 64


class RecordFolder:
    """Records numbered from 0, at ``<folder>/<number>.json``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _hadoop(self):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        return jvm, conf, path, path(self.folder).getFileSystem(conf)

    def path(self, number: int) -> str:
        return f"{self.folder}/{number:020d}.json"

    def numbers(self) -> list[int]:
        _, _, path, fs = self._hadoop()
        if not fs.exists(path(self.folder)):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(path(self.folder))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def put(self, number: int, record: dict) -> bool:
        """Write the record unless there is one of this number; True when it was written."""
        jvm, conf, path, fs = self._hadoop()
        final, part = path(self.path(number)), path(f"{self.folder}/_{uuid.uuid4().hex}")
        out = fs.create(part, True)
        try:
            out.write(bytearray(json.dumps(record).encode()))
        finally:
            out.close()
        try:
            if fs.getUri().getScheme() == "file":
                name, own = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, part))
                jvm.java.nio.file.Files.createLink(name, own)
                fs.delete(part, False)
            else:
                rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
                how = self.spark.sparkContext._gateway.new_array(rename, 1)
                how[0] = rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(part, final, how)
        except Py4JJavaError as e:
            fs.delete(part, False)
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def get(self, number: int) -> dict | None:
        jvm, _, path, fs = self._hadoop()
        p = path(self.path(number))
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, numbers: list[int]) -> list[tuple[int, dict]]:
        """(number, record) of the given records, in order."""
        if len(numbers) <= FEW:
            return [(n, self.get(n)) for n in sorted(numbers)]
        rows = self.spark.read.text([self.path(n) for n in numbers], wholetext=True).select("value", "_metadata.file_name")
        return sorted((int(r.file_name[:-5]), json.loads(r.value)) for r in rows.collect())

    def drop(self, numbers: list[int]) -> None:
        _, _, path, fs = self._hadoop()
        for n in numbers:
            fs.delete(path(self.path(n)), False)
