"""Small files in the cluster's file system: records that are written once and read by the driver."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SharedFiles:
    """The file system that holds `root`."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._gateway = spark.sparkContext._gateway
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._modes = spark._jvm.java.util.EnumSet
        self._rights = spark._jvm.org.apache.hadoop.fs.permission.FsPermission
        self._context = self._fs.FileContext.getFileContext(self._path(root).toUri(), spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._fs.Path(path)

    def _one(self, kind, value):
        """An array of one value, for the calls that take any number of them."""
        out = self._gateway.new_array(kind, 1)
        out[0] = value
        return out

    def exists(self, path: str) -> bool:
        return self._context.util().exists(self._path(path))

    def glob(self, pattern: str) -> list[str]:
        return [status.getPath().toString() for status in self._context.util().globStatus(self._path(pattern)) or []]

    def write_new(self, path: str, text: str) -> None:
        """Write a file that must not exist, its folders with it."""
        options = self._fs.Options.CreateOpts
        create = self._modes.of(self._fs.CreateFlag.CREATE)
        out = self._context.create(self._path(path), create, self._one(options, options.createParent()))
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move_new(self, source: str, target: str) -> bool:
        """Move a file to a place where nothing lies; False where something does."""
        renames = self._fs.Options.Rename
        self._context.mkdir(self._path(target).getParent(), self._rights.getDirDefault(), True)
        try:
            self._context.rename(self._path(source), self._path(target), self._one(renames, renames.NONE))
        except Py4JJavaError:
            if self.exists(target):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        """Remove a file, or a folder with all in it."""
        self._context.delete(self._path(path), True)
