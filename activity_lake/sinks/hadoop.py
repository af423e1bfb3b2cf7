"""The few file operations a publication needs, on whatever Hadoop file system a path names.

They go through the driver's JVM, so a remote (Connect) session does not have them.
"""

from __future__ import annotations

import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class HadoopFiles:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_file(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isFile()

    def size(self, path: str) -> int:
        """Bytes of all files below a folder."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def names(self, path: str) -> list[str]:
        """Names directly below a folder, in order; nothing for a missing folder."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, source: str, target: str) -> None:
        """Rename to a target that does not exist."""
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def copy_file(self, source: str, target: str) -> None:
        """Copy a file as it is, in the place of another if there is one."""
        copied = self._jvm.org.apache.hadoop.fs.FileUtil.copy(
            self._fs, self._path(source), self._fs, self._path(target), False, True, self._conf
        )
        if not copied:
            raise OSError(f"could not copy {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """A small file, replaced if it is there."""
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> bool:
        """A small file that must be new; False if it is there already. Of several writers one succeeds.

        HDFS and object stores with conditional writes create files exclusively. The local file system's Hadoop client looks
        first and creates then, so that case goes through the driver's own.
        """
        if self._fs.getUri().getScheme() == "file":
            local = self._path(path).toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                with open(local, "x", encoding="utf-8") as out:
                    out.write(text)
            except FileExistsError:
                return False
            return True
        try:
            stream = self._fs.create(self._path(path), False)
        except Py4JJavaError:
            if self.exists(path):
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace_file(self, source: str, target: str) -> None:
        """Put a file in the place of another: in one step where the file system renames, copied where it is an object store."""
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(target).toUri(), self._conf)
        option = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        qualified = [self._fs.makeQualified(self._path(path)) for path in (source, target)]
        context.rename(qualified[0], qualified[1], options)
