"""A folder in any file system that Spark can open, through Hadoop's own client."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def as_uri(folder: str | Path) -> str:
    """A path object as a local URI; text is left to Spark's default file system, unless it names a local folder that exists."""
    if isinstance(folder, Path):
        return folder.absolute().as_uri()
    return Path(folder).absolute().as_uri() if "://" not in folder and os.path.isdir(folder) else folder


class Files:
    """Small files, whole files' digests and renames below one folder; contents of tables go through Spark."""

    def __init__(self, spark: SparkSession, folder: str | Path):
        self.uri = as_uri(folder).rstrip("/")
        self._jvm = spark.sparkContext._jvm
        fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # local files without checksum files beside them: others read and change these files too
        self._fs = fs.getRawFileSystem() if fs.getScheme() == "file" else fs

    def at(self, name: str) -> str:
        return f"{self.uri}/{name}" if name else self.uri

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.at(name))

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def is_dir(self, name: str = "") -> bool:
        return self.exists(name) and self._fs.getFileStatus(self._path(name)).isDirectory()

    def make(self) -> None:
        self._fs.mkdirs(self._path(""))

    def names(self, name: str = "") -> list[str]:
        """Names of the entries of a folder, ascending; none if it is missing."""
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._path(name))) if self.is_dir(name) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write a file beside its place, then put it there."""
        work = f".{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(work), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        self.move(work, name)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def move(self, old: str, new: str) -> None:
        """Rename a file or folder; what stands at the new place goes."""
        self.delete(new)
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"can't rename {self.at(old)} to {self.at(new)}")

    def sha256(self, name: str) -> str:
        """Digest of a file, or of the part files of a folder one after the other."""
        parts = [f"{name}/{p}" for p in self.names(name) if p.startswith("part-")] if self.is_dir(name) else [name]
        streams = self._jvm.java.util.Vector()
        for p in parts:
            streams.add(self._fs.open(self._path(p)))
        whole = self._jvm.java.io.SequenceInputStream(streams.elements())
        try:
            return self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(whole)
        finally:
            whole.close()
