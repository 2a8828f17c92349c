"""The few file-system calls that Spark's readers and writers don't cover."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._path(path)
        return p.getFileSystem(self._conf), p

    def names(self, folder: str) -> list[str]:
        """Entries of a folder; none if it is missing."""
        fs, p = self._open(folder)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def remove(self, path: str) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)
