"""K9: record files: each record its length, a checksum of that, its bytes, a checksum of these.

    uint64 length, uint32 masked CRC-32C of the length, bytes, uint32 masked CRC-32C of the bytes

little-endian.  A data source writes and reads them:

    spark.dataSource.register(RecordFiles)
    df.select("record").write.format("record_files").mode("append").save(path)
    spark.read.format("record_files").load(path)  # file, offset, record

A task writes to a hidden file of its own; the commit gives the files of those attempts that
count their names, and an abort deletes them, so a task that fails leaves nothing.
A reader that meets a wrong checksum or a cut record fails.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .byteranges import file_system, files_under

#: Fixed value: the Castagnoli polynomial, bits reversed.
POLYNOMIAL = 0x82F63B78
#: Fixed value: what a masked checksum is moved by.
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
#: Bytes of a lane, see ``crc32c``.
LANE = 32
#: Bytes of records in an Arrow batch.
BATCH = 8 << 20


@cache
def _table() -> np.ndarray:
    """The checksum of each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1).astype(np.uint32)
    return t


@cache
def _moved(doublings: int) -> np.ndarray:
    """Tables (by byte of a checksum) of what it becomes behind ``LANE * 2 ** doublings`` zero bytes."""
    if not doublings:
        c = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * 8)).astype(np.uint32)
        for _ in range(LANE):
            c = _table()[c & 255] ^ (c >> 8)
        return c
    return _move(_moved(doublings - 1), doublings - 1)


def _move(c: np.ndarray, doublings: int) -> np.ndarray:
    t = _moved(doublings)
    return t[0][c & 255] ^ t[1][c >> 8 & 255] ^ t[2][c >> 16 & 255] ^ t[3][c >> 24]


def crc32c(data: bytes) -> int:
    """CRC-32C.  Long data is cut into lanes whose checksums are taken side by side and then
    put together in pairs, for a checksum is linear in the bits."""
    table = _table()
    if len(data) < 4 * LANE:
        c = 0xFFFFFFFF
        for b in data:
            c = int(table[(c ^ b) & 255]) ^ (c >> 8)
        return c ^ 0xFFFFFFFF
    lanes = -(-len(data) // LANE)
    whole = 1 << (lanes - 1).bit_length()
    padded = np.zeros(whole * LANE, np.uint8)  # zeros before the data change nothing
    at = whole * LANE - len(data)
    padded[at:] = np.frombuffer(data, np.uint8)
    padded[at : at + 4] ^= 255
    columns = np.ascontiguousarray(padded.reshape(whole, LANE).T)
    c = np.zeros(whole, np.uint32)
    for column in columns:
        c = table[(c ^ column) & 255] ^ (c >> 8)
    doublings = 0
    while len(c) > 1:
        c = _move(c[::2], doublings) ^ c[1::2]
        doublings += 1
    return int(c[0]) ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    c = crc32c(data)
    return ((c >> 15 | c << 17) + MASK) & 0xFFFFFFFF


def framed(data: bytes) -> bytes:
    head = struct.pack("<Q", len(data))
    return b"".join((head, struct.pack("<I", masked(head)), data, struct.pack("<I", masked(data))))


def records(stream, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of a stream of ``size`` bytes."""
    at = 0
    while at < size:
        head = stream.read(HEAD.size)
        if len(head) < HEAD.size:
            raise ValueError(f"a record is cut short at byte {at}")
        n, check = HEAD.unpack(head)
        if check != masked(head[:8]):
            raise ValueError(f"a record's length is damaged at byte {at}")
        if at + n + HEAD.size + 4 > size:
            raise ValueError(f"a record is cut short at byte {at}")
        data = stream.read(n)
        if struct.unpack("<I", stream.read(4))[0] != masked(data):
            raise ValueError(f"a record is damaged at byte {at}")
        yield at, data
        at += n + HEAD.size + 4


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class RecordWriter(DataSourceArrowWriter):
    """Writes the only column, of binaries or strings; null records are left out."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        name = f"{folder}/.{self.job}-{uuid.uuid4().hex}"
        try:
            n = 0
            with system.open_output_stream(name) as out:
                for batch in iterator:
                    for x in batch.column(0):
                        if x.is_valid:
                            out.write(framed(x.as_buffer().to_pybytes()))
                            n += 1
        except BaseException:
            if system.get_file_info(name).is_file:
                system.delete_file(name)
            raise
        if not n:
            system.delete_file(name)
        return Written(name if n else None)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = file_system(self.path)
        old = [p for p, _ in files_under(self.path)] if self.overwrite and system.get_file_info(folder).type.name == "Directory" else []
        for i, m in enumerate(messages):
            if m is not None and m.path is not None:
                system.move(m.path, f"{folder}/part-{i:05d}-{self.job}")
        for p in old:
            system.delete_file(p)
        self._sweep()

    def abort(self, messages: list[Written | None]) -> None:
        self._sweep()

    def _sweep(self) -> None:
        """Delete what attempts of this job left that don't count."""
        from pyarrow import fs

        system, folder = file_system(self.path)
        if system.get_file_info(folder).type == fs.FileType.Directory:
            for f in system.get_file_info(fs.FileSelector(folder)):
                if f.base_name.startswith(f".{self.job}-"):
                    system.delete_file(f.path)


@dataclass
class RecordFile(InputPartition):
    path: str
    size: int


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[RecordFile]:
        return [RecordFile(p, n) for p, n in files_under(self.path) if n]

    def read(self, part: RecordFile | None):
        if part is None:  # Spark's one partition of a source that has none
            return
        system, _ = file_system(self.path)
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            offsets, data = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([part.path] * len(rows)), pa.array(offsets, pa.int64()), pa.array(data, pa.binary())], names=["file", "offset", "record"])

        with system.open_input_stream(part.path) as stream:
            for row in records(stream, part.size):
                rows.append(row)
                held += len(row[1])
                if held >= BATCH or len(rows) == 5000:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class RecordFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "record_files"

    def schema(self) -> str:
        return "file string, offset long, record binary"

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        if [f.dataType.simpleString() for f in schema.fields] not in (["binary"], ["string"]):
            raise ValueError("record files have one column, of binaries or strings")
        return RecordWriter(self.options, overwrite)
