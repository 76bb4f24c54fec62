"""Files of any store that Hadoop reaches, handled from the driver: listing, whole writes, renames.

Paths are URIs or plain paths as Spark takes them, so a landing zone may lie on
a local disk in tests and on an object store in production.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession

BLOCK = 1 << 20


class Reading:
    """An open file of the store, read as Python's own are."""

    def __init__(self, stream):
        self.stream = stream

    def read(self, size: int) -> bytes:
        return bytes(self.stream.readNBytes(size))

    def __enter__(self) -> Reading:
        return self

    def __exit__(self, *_) -> None:
        self.stream.close()


@dataclass(frozen=True)
class Store:
    """The file system of a root folder."""

    spark: SparkSession
    root: str

    def at(self, *parts: str) -> str:
        return "/".join([str(self.root).rstrip("/"), *parts])

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self):
        return self._path(str(self.root)).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def files(self, folder: str) -> Iterator[str]:
        """Paths below a folder relative to it; none where there is no such folder."""
        fs, base = self._system(), self._path(folder)
        if not fs.exists(base):
            return
        top = fs.makeQualified(base).toString().rstrip("/")
        found = fs.listFiles(base, True)
        while found.hasNext():
            yield found.next().getPath().toString().removeprefix(top).lstrip("/")

    def write(self, path: str, blocks: Iterator[bytes]) -> str:
        """Write a whole file and return its SHA-256; a failure leaves nothing."""
        fs, digest = self._system(), hashlib.sha256()
        out = fs.create(self._path(path), True)
        try:
            for block in blocks:
                digest.update(block)
                out.write(bytearray(block))
            out.close()
        except BaseException:
            out.close()
            fs.delete(self._path(path), False)
            raise
        return digest.hexdigest()

    def open(self, path: str) -> Reading:
        """A whole file to read in blocks."""
        return Reading(self._system().open(self._path(path)))

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder, after making the folder around its new name."""
        fs, end = self._system(), self._path(target)
        fs.mkdirs(end.getParent())
        if not fs.rename(self._path(source), end):
            raise OSError(f"cannot rename {source} to {target}")

    def exists(self, path: str) -> bool:
        return self._system().exists(self._path(path))

    def remove(self, path: str) -> None:
        self._system().delete(self._path(path), True)

    def fresh(self, name: str) -> str:
        """An unused hidden folder below the root, which scans of the root pass over."""
        return self.at(f"_{name}-{uuid.uuid4().hex}")
