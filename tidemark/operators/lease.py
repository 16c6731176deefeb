"""One writer at a time, without a lock server: leases in files.

A lease is a file ``<folder>/_leases/<fence>.json`` with its owner and when it ends. The fence is a
number that grows with every lease; the file of the next one is made by a rename that fails if the
file is there, so of two takers one wins. A lease that has ended, or was given back, may be
followed. A writer that slept through its end finds a higher fence and must stop; what it writes
anyway carries the lower fence, which readers of published versions pass over.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import urlparse

from pyspark.sql import SparkSession


class LeaseLost(RuntimeError):
    """Another writer has taken over, or the lease has ended."""


class _Files:
    """The few file operations that leases need, on whatever store Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(""))] if self.fs.exists(self._path("")) else []

    def read(self, name: str) -> dict:
        stream = self.fs.open(self._path(name))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write(self, name: str, content: dict, replace: bool) -> bool:
        """Whether the file was made: as a whole, and unless ``replace`` only if it is not there yet."""
        draft = f".{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(draft), True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        try:
            if not replace and self.fs.getUri().getScheme() == "file":  # its rename would replace; a link does not
                where = urlparse(str(self.fs.makeQualified(self._path("")).toUri())).path
                os.link(f"{where}/{draft}", f"{where}/{name}")
            else:
                rename = self.jvm.org.apache.hadoop.fs.Options.Rename
                options = self.jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
                options[0] = rename.OVERWRITE if replace else rename.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.conf).rename(self._path(draft), self._path(name), options)
            return True
        except FileExistsError:
            return False
        except Exception as why:
            if "FileAlreadyExists" in str(why):
                return False
            raise
        finally:
            self.fs.delete(self._path(draft), False)


@dataclass
class Lease:
    owner: str
    fence: int
    until: float
    files: _Files = field(repr=False)
    clock: Callable[[], float] = field(default=time.time, repr=False)

    def check(self) -> None:
        """Raises LeaseLost unless this is still the last lease and has not ended."""
        if _last(self.files) != self.fence or self.clock() >= self.until:
            raise LeaseLost(f"{self.owner} no longer holds the lease (fence {self.fence})")

    def renew(self, seconds: float) -> None:
        self.check()
        self.until = self.clock() + seconds
        self.files.write(_name(self.fence), {"owner": self.owner, "until": self.until}, replace=True)

    def release(self) -> None:
        """Give the lease back, if it is still this writer's."""
        if _last(self.files) == self.fence:
            self.files.write(_name(self.fence), {"owner": self.owner, "until": 0}, replace=True)


def _name(fence: int) -> str:
    return f"{fence:012d}.json"


def _last(files: _Files) -> int:
    return max((int(n[:-5]) for n in files.names() if n.endswith(".json") and n[0] != "."), default=0)


def take(spark: SparkSession, folder: str, owner: str, seconds: float = 3600, clock: Callable[[], float] = time.time) -> Lease | None:
    """The lease of a folder, or None while another writer holds it."""
    files = _Files(spark, f"{folder}/_leases")
    last = _last(files)
    if last and files.read(_name(last))["until"] > clock():
        return None
    lease = Lease(owner, last + 1, clock() + seconds, files, clock)
    return lease if files.write(_name(lease.fence), {"owner": owner, "until": lease.until}, replace=False) else None


@contextmanager
def held(spark: SparkSession, folder: str, owner: str, seconds: float = 3600) -> Iterator[Lease | None]:
    """The lease for the time of a block, None if it was refused."""
    lease = take(spark, folder, owner, seconds)
    try:
        yield lease
    finally:
        if lease is not None:
            lease.release()
