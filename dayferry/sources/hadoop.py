"""Small files on any file system that Spark knows, by Spark's own Hadoop client on the driver."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """The file system of a path, as Spark's readers and writers have it."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def rename(self, path: str, to: str) -> bool:
        """Whether the path is now ``to``. Of several callers that move one path, one succeeds."""
        try:
            return self._fs.rename(self._path(path), self._path(to))
        except Py4JJavaError as e:
            if _kind(e) == "FileNotFoundException":
                return False
            raise

    def names(self, folder: str) -> list[str]:
        """Names of what lies in a folder, none if there is no such folder."""
        try:
            return [s.getPath().getName() for s in self._fs.listStatus(self._path(folder))]
        except Py4JJavaError as e:
            if _kind(e) == "FileNotFoundException":
                return []
            raise

    def modified(self, path: str) -> float | None:
        """Seconds since 1970 by the file system's clock, or None."""
        try:
            return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000
        except Py4JJavaError as e:
            if _kind(e) == "FileNotFoundException":
                return None
            raise

    def now(self, folder: str) -> float:
        """The file system's own time, which leases are judged by."""
        probe = f"{folder}/_now-{uuid.uuid4().hex}"
        self.write(probe, "")
        found = self.modified(probe)
        self.delete(probe)
        return found

    def read(self, path: str) -> str | None:
        try:
            stream = self._fs.open(self._path(path))
        except Py4JJavaError as e:
            if _kind(e) == "FileNotFoundException":
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str, overwrite: bool = True) -> None:
        stream = self._fs.create(self._path(path), overwrite)
        stream.write(bytearray(text.encode()))
        stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make a file unless there is one; of several callers one makes it. Whether this one did."""
        if self._fs.getScheme() == "file":
            # Hadoop's local file system looks first and creates then, which two processes can both do.
            local = self._fs.makeQualified(self._path(path)).toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                with open(local, "x") as f:
                    f.write(text)
            except FileExistsError:
                return False
            return True
        try:
            self.write(path, text, overwrite=False)
        except Py4JJavaError as e:
            if _kind(e) in ("FileAlreadyExistsException", "PathExistsException", "AlreadyBeingCreatedException"):
                return False
            raise
        return self.read(path) == text  # where two could create it after all, the later one has it


def _kind(error: Py4JJavaError) -> str:
    """The Java class of an error, also of one that came over the network."""
    java = error.java_exception
    name = java.getClass().getSimpleName()
    return java.getClassName().split(".")[-1] if name == "RemoteException" else name
