"""Log files that grow (S1, S2): a streaming source that follows appends.

`spark.readStream.format("growing_lines").option("path", glob)`. An offset maps
each file to the place up to which its lines are complete, and to a fingerprint
of its first bytes. A batch is the byte ranges between two offsets; large ranges
are cut into partitions, and a line belongs to the partition in which it begins.

- Appended lines arrive once: the ranges follow from the two offsets alone, which
  the checkpoint keeps. An unfinished last line waits for its end.
- A rotated file keeps its fingerprint: under its new name, which the glob must
  match too, reading goes on where it was, and the new file starts at 0. So does
  a file that shrank (truncated in place).
- A line longer than `maxLineBytes` is skipped while it is read, in pieces of
  CHUNK bytes; also one that is not finished yet.

Files are reached through `pyarrow.fs`, on the driver and in tasks, so a path may
be a plain one or a URI of a store that Arrow knows.
"""

from __future__ import annotations

import fnmatch
import hashlib
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .logs import MAX_LINE_BYTES

FORMAT = "growing_lines"
SCHEMA = "value string, file_path string, at long, received timestamp"
HEAD = 1024              # bytes of a file's fingerprint
CHUNK = 1 << 20          # bytes read at once
RANGE = 64 << 20         # bytes of a partition
ROWS = 4 << 20           # bytes of text in one Arrow batch, about


def open_store(path: str):
    """(file system, path in it) of a plain path or a URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if urlsplit(path).scheme else (fs.LocalFileSystem(), path)


def fingerprint(store, path: str, n: int) -> str | None:
    """Hash of the first `n` bytes; None if the file is shorter or gone."""
    try:
        with store.open_input_file(path) as f:
            head = f.read(n)
    except FileNotFoundError:
        return None
    return hashlib.sha256(head).hexdigest()[:24] if len(head) == n else None


def list_files(store, pattern: str) -> list:
    """Files that match a glob; only the last part of the path may have wildcards."""
    from pyarrow import fs

    folder, name = posixpath.split(pattern)
    got = store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in got if f.is_file and fnmatch.fnmatchcase(f.base_name, name)), key=lambda f: f.path)


def complete(f, size: int, most: int) -> tuple[int, bool]:
    """The place after the last line end of the first `size` bytes, and whether
    a line is still open there that is longer than `most`, hence skipped."""
    high = size
    while high > 0 and size - high <= most:
        low = max(0, high - CHUNK)
        f.seek(low)
        hit = f.read(high - low).rfind(b"\n")
        if hit >= 0:
            end = low + hit + 1
            return (size, True) if size - end > most else (end, False)
        high = low
    return (size, True) if size - high > most else (0, False)


def lines(f, low: int, high: int, end: int, most: int, inside: bool) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in [low, high), read up to `end`.
    `inside`: `low` may be in the middle of a line, whose rest is passed over. At
    most `most` + CHUNK bytes are held."""
    f.seek(low)
    pos, start, held, skip = low, low, b"", inside
    while pos < end and (start < high or skip):
        chunk = f.read(min(CHUNK, end - pos))
        if not chunk:
            return
        base, at = pos, 0
        pos += len(chunk)
        while True:
            hit = chunk.find(b"\n", at)
            if hit < 0:
                break
            if skip:
                skip = False
            elif start < high and len(held) + hit - at <= most:
                yield start, held + chunk[at:hit]
            held, at = b"", hit + 1
            start = base + at
            if start >= high:
                return
        if not skip:
            held += chunk[at:]
            if len(held) > most:
                held, skip = b"", True


@dataclass
class FileRange(InputPartition):
    """Lines of a file that begin in [low, high); `end` closes the batch's range."""

    path: str
    head: int
    mark: str
    low: int
    high: int
    end: int
    inside: bool
    received: int


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingReader(self.options)


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.glob = options["path"]
        self.most = int(options.get("maxlinebytes") or options.get("maxLineBytes") or MAX_LINE_BYTES)
        self.range = int(options.get("rangebytes") or options.get("rangeBytes") or RANGE)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """{path: [place, open long line, head bytes, fingerprint, modified]}."""
        store, pattern = open_store(self.glob)
        out = {}
        for info in list_files(store, pattern):
            if not info.size:
                continue
            try:
                with store.open_input_file(info.path) as f:
                    at, skipping = complete(f, info.size, self.most)
            except FileNotFoundError:            # rotated away meanwhile: the next batch sees it
                continue
            head = min(info.size, HEAD)
            mark = fingerprint(store, info.path, head)
            if mark and at:
                out[info.path] = [at, skipping, head, mark, (info.mtime_ns or 0) // 1000]
        return out

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        store, _ = open_store(self.glob)
        known: dict[tuple[int, str], list] = {}
        for path, (at, skipping, head, mark, _) in start.items():
            known.setdefault((head, mark), []).append((path, at, skipping))
        heads = sorted({head for head, _ in known}, reverse=True)
        out, used = [], set()
        # files under their old name first, so that a copy of one does not take its place
        for path, (at, _, head, mark, received) in sorted(end.items(), key=lambda x: (x[0] not in start, x[0])):
            low, inside = 0, False
            for n in heads:
                if n > head:
                    continue
                now = mark if n == head else fingerprint(store, locate(store, self.glob, path, head, mark), n)
                old = [k for k in known.get((n, now), []) if k[0] not in used and k[1] <= at and (k[0] == path or k[0] not in end or not same(end[k[0]], n, now, head, mark))]
                if old:
                    was = min(old, key=lambda k: k[0] != path)
                    used.add(was[0])
                    low, inside = was[1], was[2]
                    break
            for x in range(low, at, self.range):
                out.append(FileRange(path, head, mark, x, min(at, x + self.range), at, inside if x == low else True, received))
        return out

    def read(self, part: FileRange) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.glob)
        path = locate(store, self.glob, part.path, part.head, part.mark)
        # a later partition starts one byte early: a line end there means that a line begins at its start
        first = part.inside and part.low > 0
        text, places, size = [], [], 0
        with store.open_input_file(path) as f:
            for at, line in lines(f, part.low - 1 if first else part.low, part.high, part.end, self.most, part.inside):
                if at < part.low:
                    continue
                text.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                places.append(at)
                size += len(line) + 64
                if size >= ROWS:
                    yield self._batch(part, text, places)
                    text, places, size = [], [], 0
        if text:
            yield self._batch(part, text, places)

    @staticmethod
    def _batch(part: FileRange, text: list[str], places: list[int]) -> pa.RecordBatch:
        n = len(text)
        return pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array([part.path] * n, pa.string()), pa.array(places, pa.int64()),
                                           pa.array([part.received] * n, pa.timestamp("us", tz="UTC"))], ["value", "file_path", "at", "received"])

    def commit(self, end: dict) -> None:
        pass


def same(entry: list, n: int, now: str, head: int, mark: str) -> bool:
    """Does a file of the later offset have the fingerprint (of `n` bytes) `now`?"""
    return (entry[2] == n and entry[3] == now) or (entry[2] == head and entry[3] == mark)


def locate(store, glob: str, path: str, head: int, mark: str) -> str:
    """Where the file with this fingerprint is now: rotation may rename it
    between planning and reading."""
    if fingerprint(store, path, head) == mark:
        return path
    for info in list_files(store, open_store(glob)[1]):
        if info.size >= head and fingerprint(store, info.path, head) == mark:
            return info.path
    raise FileNotFoundError(f"{path}: rotated out of {glob} before it was read")


def read_growing(spark: SparkSession, path_glob: str, max_line_bytes: int = MAX_LINE_BYTES, range_bytes: int = RANGE):
    """Stream of (value, file_path, at, received): every finished line of the
    matching files, once, with its place in the file."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("path", path_glob).option("maxLineBytes", max_line_bytes).option("rangeBytes", range_bytes).load()
