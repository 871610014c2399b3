"""Small records beside the data, through Hadoop's file systems, so they lie wherever Spark's own files do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Records:
    """Named texts in a folder. A record appears whole (written aside, then renamed) and is never replaced.

    One driver writes to a folder at a time; it may stop at any point.
    """

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self._conf)

    def put(self, name: str, text: str) -> None:
        if self.get(name) is not None:
            raise FileExistsError(f"{self.root}/{name}")
        fs, aside, to = self._fs(), self._path(f"_aside/{uuid.uuid4().hex}"), self._path(name)
        out = fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        fs.mkdirs(to.getParent())
        if not fs.rename(aside, to):
            raise OSError(f"cannot write {self.root}/{name}")

    def get(self, name: str) -> str | None:
        fs, path = self._fs(), self._path(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []
