"""Streaming source that follows growing NDJSON files.

Spark's file source lists whole files, so lines appended to a known file never
show up.  This reader's offset is the number of bytes consumed per file.  It
stops at the last line break, so a half-written line waits for its end; it
starts a file over when the file became shorter, when it is another file under
the same name, or when its first line changed, which carries the time of its
first sample and so differs from one export to the next.
The files must be on storage that every executor mounts.
"""

from __future__ import annotations

import glob as _glob
import hashlib
import os
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 * 1024 * 1024
_TAIL_STEP = 64 * 1024


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    stop: int
    first: bool  # does `start` lie on a line start already?


def _complete_size(path: str) -> int:
    """Bytes up to and including the last line break."""
    with open(path, "rb") as f:
        pos = f.seek(0, os.SEEK_END)
        while pos > 0:
            step = min(_TAIL_STEP, pos)
            pos -= step
            f.seek(pos)
            cut = f.read(step).rfind(b"\n")
            if cut >= 0:
                return pos + cut + 1
    return 0


def _identity(path: str) -> list:
    """Device, inode and digest of the whole first line."""
    with open(path, "rb") as f:
        at = os.fstat(f.fileno())
        return [at.st_dev, at.st_ino, hashlib.sha1(f.readline()).hexdigest()]


class TailReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = options["path"]
        self.pattern = options.get("pattern", "history-*.ndjson")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        now = {}
        for path in sorted(_glob.glob(os.path.join(self.folder, self.pattern))):
            size = _complete_size(path)
            if size:
                now[path] = [size, *_identity(path)]
        return now

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        parts = []
        for path, (stop, *_) in end.items():
            begin = self._resume(path, start.get(path), stop)
            cuts = list(range(begin, stop, self.split)) + [stop]
            parts += [ByteRange(path, a, b, a == begin) for a, b in zip(cuts, cuts[1:])]
        return parts

    @staticmethod
    def _resume(path: str, known: list | None, stop: int) -> int:
        if known is None or known[0] > stop:
            return 0
        return known[0] if _identity(path) == known[1:] else 0

    def read(self, partition: ByteRange):
        """A line belongs to the range in which it starts."""
        with open(partition.path, "rb") as f:
            f.seek(partition.start if partition.first else partition.start - 1)
            if not partition.first:
                f.readline()
            name = os.path.basename(partition.path)
            while f.tell() < partition.stop:
                line = f.readline().strip()
                if line:
                    yield (line.decode("utf-8", "replace"), name)

    def commit(self, end: dict) -> None:
        pass


class TailSource(DataSource):
    """``spark.readStream.format("tail_ndjson").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "tail_ndjson"

    def schema(self) -> str:
        return "line string, file string"

    def streamReader(self, schema) -> TailReader:
        return TailReader(self.options)
