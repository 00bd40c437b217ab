"""A folder of logs that are still being written to, as a stream: every complete line once.

A position is kept for each file, not each name: a file is known by its inode and the checksum of its first line, so one
that is renamed by rotation goes on where it stood, and a new or emptied file under an old name starts anew. A line
counts when its end is written. Ranges between two positions are cut into splits, which tasks read on their own.

Files that are copied and then emptied are new files to this source; their lines come again, which a sink that
inserts by key does not mind. Stores without inodes know a file by its path instead.
"""

from __future__ import annotations

import fnmatch
import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The reader travels to the executors as code, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEAD = 4096  # bytes that the first line is known by
BLOCK = 1 << 20
SPLIT = 16 << 20  # about 40,000 events, a second or two of parsing


@dataclass
class Span(InputPartition):
    """The lines of one file that begin in [start, end); ``first`` if a line begins at ``start`` for sure."""

    ident: str
    name: str
    start: int
    end: int
    stop: int
    first: bool


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _ident(store: fs.FileSystem, path: str) -> str | None:
    """What the file is known by; None while its first line is incomplete."""
    with store.open_input_file(path) as file:
        head = file.read(HEAD)
    end = head.find(b"\n")
    if end < 0 and len(head) < HEAD:
        return None
    where = os.stat(path).st_ino if isinstance(store, fs.LocalFileSystem) else path
    return f"{where}-{zlib.crc32(head[: end + 1] if end >= 0 else head)}"


def _complete(store: fs.FileSystem, path: str, size: int) -> int:
    """The place behind the last line end before ``size``."""
    with store.open_input_file(path) as file:
        end = size
        while end > 0:
            begin = max(0, end - BLOCK)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return 0


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.pattern = options.get("pattern", "*")
        self.split = int(options.get("splitBytes", SPLIT))

    def _files(self) -> dict[str, tuple[str, int]]:
        """Path and size of the files by what they are known by."""
        store, root = _opened(self.path)
        found = {}
        for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type == fs.FileType.File and info.base_name[0] not in "._" and fnmatch.fnmatch(info.base_name, self.pattern):
                try:
                    ident = _ident(store, info.path)
                except FileNotFoundError:  # renamed or deleted meanwhile
                    continue
                if ident:
                    found[ident] = (info.path, info.size)
        return found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        store, _ = _opened(self.path)
        return {ident: _complete(store, path, size) for ident, (path, size) in self._files().items()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        files, spans = self._files(), []
        for ident, stop in end.items():
            begin = start.get(ident, 0)
            if stop <= begin:
                continue
            if ident not in files:
                raise FileNotFoundError(f"a log was deleted before it was read: {ident} in {self.path}")
            for at in range(begin, stop, self.split):
                spans.append(Span(ident, files[ident][0], at, min(at + self.split, stop), stop, at == begin))
        return spans

    def _place(self, span: Span) -> str:
        """The file's path now; it may have been renamed since the splits were made."""
        store, _ = _opened(self.path)
        try:
            if _ident(store, span.name) == span.ident:
                return span.name
        except FileNotFoundError:
            pass
        return self._files()[span.ident][0]

    def read(self, span: Span) -> Iterator[pa.RecordBatch]:
        store, _ = _opened(self.path)
        with store.open_input_file(self._place(span)) as file:
            at = span.start if span.first else span.start - 1
            file.seek(at)
            rest, skip = b"", not span.first  # the line that the split before has begun is not ours
            while at < span.stop:
                block = file.read(min(BLOCK, span.stop - at))
                if not block:
                    raise OSError(f"{span.name} is shorter than it was")
                at += len(block)
                *lines, rest = (rest + block).split(b"\n")
                begun = at - len(rest) - sum(len(x) + 1 for x in lines)
                kept = []
                for line in lines:
                    if not skip and begun < span.end and line:
                        kept.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                    begun, skip = begun + len(line) + 1, False
                if kept:
                    yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string())], names=["value"])
                if begun >= span.end and not skip:
                    return


class GrowingLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingLogReader:
        return GrowingLogReader(self.options)


def read_growing_log(spark: SparkSession, path: str, pattern: str = "*", split_bytes: int = SPLIT) -> DataFrame:
    """The complete lines of the files in folder ``path`` whose names match ``pattern``, as a stream with ``value``."""
    spark.dataSource.register(GrowingLog)
    stream = spark.readStream.format("growing_log").option("path", path).option("pattern", pattern)
    return stream.option("splitBytes", split_bytes).load()
