"""One writer at a time under a root: a log of numbered entries, each created only if it is absent.

A run begins by creating the entry behind the last one, adds one before it clears, writes or commits
anything, and ends with one.
Of two runs that begin at once only one can create the number, and a run that finds another's entry
last, without an end, is refused before it has touched anything. A driver that was killed leaves its
claim open; ``takeover`` begins behind it, and should that driver come back, its next number is taken and
it stops before it writes or commits. (Tasks of its that still run may finish files of the wave they were
in; ``verify_year`` finds shards with more rows than the manifest says.) Entries in front of a finished run's beginning are dropped, so the folder
keeps a few names however often a root is run.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

BEGIN, COMMIT, END = "begin", "commit", "end"


class ConcurrentRun(RuntimeError):
    """Another run writes under the same root."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark, self._folder = spark, f"{root}/_log"
        path = spark._jvm.org.apache.hadoop.fs.Path(self._folder)
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._local = self._files.makeQualified(path).toUri() if self._files.getScheme() == "file" else None
        self.writer = uuid.uuid4().hex
        self.first = self.last = 0

    def numbers(self) -> list[int]:
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(self._folder)
        if not self._files.exists(folder):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(folder))
        return sorted(int(found[1]) for name in names if (found := re.fullmatch(r"(\d{20})\.json", name)))

    def entry(self, number: int) -> dict:
        """An entry; one whose writer has not come to writing it is an open claim."""
        stream = self._files.open(self._path(number))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return json.loads(text) if text else {"kind": BEGIN, "writer": None, "at": None}

    def begin(self, takeover: bool = False) -> None:
        """Claim the root, or raise ``ConcurrentRun`` if a run that has not ended holds it."""
        self.last = max(self.numbers(), default=0)
        if self.last and not takeover:
            held = self.entry(self.last)
            if held["kind"] != END:
                raise ConcurrentRun(
                    f"{self._folder}: run {held['writer']} has not ended (last sign at {held['at']}); "
                    "pass takeover=True if it is known to be dead"
                )
        self._add(BEGIN)
        self.first = self.last

    def commit(self) -> None:
        """To be called before each step that must not happen if another run has taken over."""
        self._add(COMMIT)

    def end(self) -> None:
        self._add(END)
        for number in self.numbers():
            if number < self.first:
                self._files.delete(self._path(number), False)

    def _add(self, kind: str) -> None:
        text = json.dumps({"kind": kind, "writer": self.writer, "at": time.time()})
        if not self._create(self.last + 1, text.encode()):
            raise ConcurrentRun(f"{self._folder}: another run has taken over")
        self.last += 1

    def _create(self, number: int, data: bytes) -> bool:
        """Whether the entry was absent and now holds ``data``."""
        path = self._path(number)
        if self._local is not None:
            # Hadoop's local file system looks before it creates; the operating system does both at once.
            folder = self._local.getPath()
            os.makedirs(folder, exist_ok=True)
            try:
                handle = os.open(os.path.join(folder, path.getName()), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            except FileExistsError:
                return False
            with os.fdopen(handle, "wb") as file:
                file.write(data)
            return True
        try:
            stream = self._files.create(path, False)
        except Py4JJavaError as error:
            if self._files.exists(path):
                return False
            raise error
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        return True

    def _path(self, number: int):
        return self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{number:020d}.json")
