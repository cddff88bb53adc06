"""Folders of any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder by its path; nothing here reads data."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._path)

    def make(self) -> None:
        self._fs.mkdirs(self._path)

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path)) if self.exists() else []

    def files(self, suffix: str = ".parquet") -> list[str]:
        """Full names of all files below with that suffix; Spark lists them, their contents are not read."""
        if not self.exists():
            return []
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
        return sorted(r["path"] for r in found.load(self.path).select("path").collect())

    def remove(self) -> None:
        self._fs.delete(self._path, True)

    def rename(self, target: str) -> bool:
        """Atomic on file systems whose renames are; False if the target is there."""
        to = self.spark._jvm.org.apache.hadoop.fs.Path(target)
        return not self._fs.exists(to) and self._fs.rename(self._path, to)
