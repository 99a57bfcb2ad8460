"""A streaming source of new and changed files (D1, D4): ``spark.readStream.format("changed_files")``."""

from __future__ import annotations

import datetime as dt
import heapq
import os
import sys
import time
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ladderline.sources.text_reports import is_report

MAX_FILES, SETTLE_SECONDS = 10_000, 2.0


class ChangedFiles(DataSource):
    """Versions of the files below ``path``, ``(path, mtime, length)``, each time a file appears or changes.

    The offset is the last version handed out, as ``(time, path)``; a batch is the ``maxFiles`` versions after it, and
    the rest waits for the next one. The time is when the version came to be where it is: the modification time, and on
    a local file system the later of it and the change of the entry, so that a file moved in with an old modification
    time isn't missed. A version counts once it is ``settle`` seconds old, as its writer, or another with the same time,
    may not be done. A file that changes between listing and reading comes again with its new time."""

    @classmethod
    def name(cls) -> str:
        return "changed_files"

    def schema(self) -> str:
        return "path string, mtime timestamp, length bigint"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options.get("maxFiles", MAX_FILES)), float(self.options.get("settle", SETTLE_SECONDS)))


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, root: str, most: int, settle: float):
        self.root, self.most, self.settle = root, most, settle

    def initialOffset(self) -> dict:
        return {"micros": -(1 << 62), "path": ""}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        ripe = int((time.time() - self.settle) * 1_000_000)
        after = (start["micros"], start["path"])
        found = heapq.nsmallest(self.most, (v for v in versions(self.root) if after < v[:2] and v[0] <= ripe))
        end = {"micros": found[-1][0], "path": found[-1][1]} if found else start
        return map(_row, found), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        after, until = (start["micros"], start["path"]), (end["micros"], end["path"])
        return map(_row, sorted(v for v in versions(self.root) if after < v[:2] <= until))


def _row(version: tuple[int, str, int, int]) -> tuple:
    return version[1], dt.datetime.fromtimestamp(version[2] / 1_000_000, dt.timezone.utc), version[3]


def versions(root: str) -> Iterator[tuple[int, str, int, int]]:
    """``(time, path, mtime, length)`` of every file, times in microseconds, paths as Spark writes them."""
    parts = urlsplit(root)
    if parts.scheme in ("", "file"):
        yield from _local(os.path.abspath(parts.path if parts.scheme else root))
        return
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(root)
    base = f"{parts.scheme}://{parts.netloc}"
    for info in store.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True)):
        if info.type == fs.FileType.File:
            micros = info.mtime_ns // 1000
            yield micros, f"{base}{info.path[info.path.index(parts.path):] if parts.path in info.path else '/' + info.path}", micros, info.size


def _local(folder: str) -> Iterator[tuple[int, str, int, int]]:
    try:
        entries = list(os.scandir(folder))
    except FileNotFoundError:  # gone since it was listed
        return
    for entry in entries:
        try:
            if entry.is_dir():
                yield from _local(entry.path)
            elif entry.is_file():
                s = entry.stat()
                # Spark knows local modification times to the millisecond
                mtime = s.st_mtime_ns // 1_000_000 * 1000
                yield max(s.st_mtime_ns, s.st_ctime_ns) // 1000, f"file:{entry.path}", mtime, s.st_size
        except FileNotFoundError:
            continue


def changed_files(spark: SparkSession, directory: str, max_files: int = MAX_FILES, settle: float = SETTLE_SECONDS) -> DataFrame:
    """A stream of the report files ``(path, mtime)`` that are new or changed below a directory."""
    # the processes that list the files need not have this library
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangedFiles)
    stream = spark.readStream.format("changed_files").option("path", directory).option("maxFiles", max_files).option("settle", settle).load()
    return stream.filter(is_report(F.col("path"))).select("path", "mtime")
