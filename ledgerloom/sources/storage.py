"""Small files of tables and landings on any file system Spark can reach."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession


def open_uri(uri: str):
    """A random-access file of a local path or of a URI that pyarrow knows."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(uri)
    filesystem, path = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(path)


class Storage:
    """The folder ``root``, through Hadoop's file systems; names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    @property
    def local(self) -> Path | None:
        """The folder as a local path, if that is what it is."""
        if self.root.startswith("file:"):
            return Path("/" + self.root[5:].lstrip("/"))
        return None if "://" in self.root or self._fs.getScheme() != "file" else Path(self.root)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """Names in a folder, sorted; none if it is not there."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name))) if self.exists(name) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def create(self, name: str, text: str) -> bool:
        """Create a file with all its text at once; False if it is there already, also if another writer comes first."""
        part = f"{os.path.dirname(name)}/.{os.path.basename(name)}.{uuid.uuid4().hex}"
        if folder := self.local:
            (folder / part).parent.mkdir(parents=True, exist_ok=True)
            (folder / part).write_text(text)
            try:
                os.link(folder / part, folder / name)
                return True
            except FileExistsError:
                return False
            finally:
                (folder / part).unlink()
        self._write(part, text)
        try:  # a rename that does not overwrite: the first writer wins
            none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf).rename(self._path(part), self._path(name), none)
            return True
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        finally:
            self.remove(part)

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def move(self, root: str) -> None:
        """Rename the whole folder; raises if the target is there."""
        target = self._jvm.org.apache.hadoop.fs.Path(root)
        if self._fs.exists(target) or not self._fs.rename(self._path(""), target):
            raise OSError(f"{self.root} cannot be renamed to {root}")
