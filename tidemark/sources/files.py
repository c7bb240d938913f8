"""Names of files: whether they are there, small texts, moves. Contents of data are for Spark to read."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that a path belongs to, whatever its kind."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def whole(self, path: str) -> str:
        """The path with its scheme and authority."""
        return self._system.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names within a folder, for folders with few of them."""
        return [f.getPath().getName() for f in self._system.listStatus(self._path(path))] if self.exists(path) else []

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new small file, there whole or not at all. Fails if it is there."""
        beside = f"{path}.part"
        stream = self._system.create(self._path(beside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.move(beside, path):
            raise FileExistsError(path)

    def move(self, source: str, target: str, replace: bool = False) -> bool:
        """Rename a file, making the folders above its new name. False if the file isn't there, or the name is taken."""
        if not self.exists(source):
            return False
        if self.exists(target):
            if not replace:
                return False
            self.delete(target)
        self._system.mkdirs(self._path(target).getParent())
        return self._system.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)
