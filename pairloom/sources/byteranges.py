"""Files of lines cut by byte offset.

A data source plans ranges of bytes of each file; a task finds the first line that begins in its
range and reads on to the end of the last one that does, so any number of ranges gives each line once,
with the place of its first byte.  A file is never read whole: a task holds ``CHUNK`` bytes and a line.

    spark.dataSource.register(ByteRanges)
    spark.read.format("byte_ranges").option("parts", 2).load(path)  # file, part, offset, line

Lines end with a newline, with or without a carriage return before it; the last may lack it.
Undecodable bytes become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK = 1 << 20
#: Lines in an Arrow batch.
ROWS = 5000


def file_system(uri: str):
    """The file system of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def files_under(uri: str) -> list[tuple[str, int]]:
    """The files under a folder (or the file itself) and their sizes, by name; hidden ones are left out."""
    from pyarrow import fs

    system, path = file_system(uri)
    info = system.get_file_info(path)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(path, recursive=True))
    hidden = lambda f: any(x.startswith(("_", ".")) for x in f.path[len(path) :].split("/"))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and (f.path == path or not hidden(f)))


@dataclass
class ByteRange(InputPartition):
    path: str
    part: int
    start: int
    end: int


def lines_from(stream, start: int, end: int, chunk: int = CHUNK) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines of a seekable stream that begin at ``start`` or later and before ``end``."""
    at = max(0, start - 1)
    stream.seek(at)
    held, skip = b"", start > 0  # what comes before the first newline belongs to the range before
    while True:
        data = stream.read(chunk)
        held += data
        a = 0
        while (b := held.find(b"\n", a)) >= 0:
            if not skip:
                if at + a >= end:
                    return
                yield at + a, held[a : b - (b > a and held[b - 1] == 13)]
            skip, a = False, b + 1
        if skip:  # a line that goes on: only where it ends matters
            at, held = at + len(held), b""
        else:
            at, held = at + a, held[a:]
        if (at >= end and not skip) or (skip and at >= end and not data):
            return
        if not data:
            if held and not skip and at < end:
                yield at, held
            return


class ByteRangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.parts, self.bytes = int(options.get("parts", 0)), int(options.get("bytes", 128 << 20))

    def partitions(self) -> list[ByteRange]:
        out = []
        for path, size in files_under(self.path):
            n = self.parts or max(1, -(-size // self.bytes))
            cuts = [size * i // n for i in range(n + 1)]
            out += [ByteRange(path, i, a, b) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
        return out

    def read(self, part: ByteRange | None):
        if part is None:  # Spark's one partition of a source that has none
            return
        system, _ = file_system(self.path)
        rows: list[tuple[int, str]] = []

        def batch() -> pa.RecordBatch:
            offsets, lines = zip(*rows, strict=True)
            n = len(rows)
            return pa.RecordBatch.from_arrays([pa.array([part.path] * n), pa.array([part.part] * n, pa.int32()), pa.array(offsets, pa.int64()), pa.array(lines, pa.string())], names=["file", "part", "offset", "line"])

        with system.open_input_file(part.path) as stream:
            for offset, line in lines_from(stream, part.start, part.end):
                rows.append((offset, line.decode("utf-8", "replace")))
                if len(rows) == ROWS:
                    yield batch()
                    rows = []
        if rows:
            yield batch()


class ByteRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "byte_ranges"

    def schema(self) -> str:
        return "file string, part int, offset long, line string"

    def reader(self, schema) -> ByteRangeReader:
        return ByteRangeReader(self.options)
