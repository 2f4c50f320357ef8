"""Small steps in whatever store a path is in: list, rename, copy, delete, an empty mark file. Only names and sizes reach the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    length: int
    directory: bool


class Store:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def entries(self, path: str) -> list[Entry]:
        """What lies directly in a directory, by name; nothing if there is none."""
        if not self.exists(path):
            return []
        found = self._fs.listStatus(self._path(path))
        return sorted((Entry(s.getPath().getName(), s.getLen(), s.isDirectory()) for s in found), key=lambda e: e.name)

    def mark(self, path: str) -> None:
        """An empty file; it is there or not, never half."""
        self._fs.create(self._path(path), True).close()

    def write_text(self, path: str, text: str) -> None:
        """A small text file, complete under its name or absent."""
        self._fs.mkdirs(self._path(path).getParent())
        stream = self._fs.create(self._path(path + ".part"), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.remove(path)
        self.rename(path + ".part", path)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def make_directory(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def copy(self, source: str, target: str) -> None:
        util = self._jvm.org.apache.hadoop.fs.FileUtil
        if not util.copy(self._fs, self._path(source), self._fs, self._path(target), False, True, self._conf):
            raise OSError(f"cannot copy {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
