"""What is in an image's bytes (P8, S15, F9): format, width, height, frames and what is wrong with them.

The containers of PNG, JPEG, GIF and WebP are walked: chunks, marker segments, blocks.  Pixels
are not decoded; of a PNG's, the stream is inflated in steps and counted, so that a picture
that its header lies about is told.  Nothing in a file is believed to be longer than the file, and
no step keeps more than ``STEP`` bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .image import MAX_PIXELS, status
from .text import col

#: What can be wrong.  An ``unknown`` file is of none of the formats; an ``empty`` one has no bytes.
EMPTY, UNKNOWN, TRUNCATED, CORRUPT = "empty", "unknown", "truncated", "corrupt"
STEP = 1 << 16

FACTS = "format string, width int, height int, frames int, problem string"


class Bad(Exception):
    """Carries what is known so far and what is wrong."""


# ------------------------------------------------------------------ PNG

_PNG = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel by colour type, and the depths that the type may have.
_PNG_KINDS = {0: (1, (1, 2, 4, 8, 16)), 2: (3, (8, 16)), 3: (1, (1, 2, 4, 8)), 4: (2, (8, 16)), 6: (4, (8, 16))}
#: The seven passes of interlacing: first column and row, steps between them.
_PASSES = ((0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2))


def _png_bytes(width: int, height: int, bits: int, interlaced: bool) -> int:
    """The bytes of all rows, with the byte before each."""
    passes = _PASSES if interlaced else ((0, 0, 1, 1),)
    total = 0
    for x, y, dx, dy in passes:
        w, h = -(-(width - x) // dx), -(-(height - y) // dy)
        if w > 0 and h > 0:
            total += h * (1 + (w * bits + 7) // 8)
    return total


def _png(data: bytes) -> tuple:
    at, facts, inflate, want, got, frames, last = 8, (None, None), None, 0, 0, 1, b""
    problem = None
    while True:
        if at + 12 > len(data):
            problem = problem or TRUNCATED
            break
        n, kind = struct.unpack_from(">I4s", data, at)
        if n > 0x7FFFFFFF or not kind.isalpha():
            problem = problem or CORRUPT
            break
        if at + 12 + n > len(data):
            problem = problem or TRUNCATED
            break
        body = memoryview(data)[at + 8 : at + 8 + n]
        if zlib.crc32(body, zlib.crc32(kind)) != struct.unpack_from(">I", data, at + 8 + n)[0]:
            problem = problem or CORRUPT
        if not last and (kind != b"IHDR" or n != 13):
            return None, None, None, CORRUPT
        if kind == b"IHDR":
            if last:
                problem = problem or CORRUPT
                break
            width, height, depth, colour, packing, filters, interlaced = struct.unpack(">IIBBBBB", body)
            if not (0 < width <= 0x7FFFFFFF and 0 < height <= 0x7FFFFFFF) or depth not in _PNG_KINDS.get(colour, (0, ()))[1] or packing or filters or interlaced > 1:
                return None, None, None, CORRUPT
            facts, inflate = (width, height), zlib.decompressobj()
            want = _png_bytes(width, height, depth * _PNG_KINDS[colour][0], bool(interlaced))
        elif kind == b"acTL" and n == 8:
            frames = max(1, struct.unpack_from(">I", body)[0])
        elif kind == b"IDAT" and width * height <= MAX_PIXELS and problem is None:
            try:
                rest = bytes(body)
                while rest and not inflate.eof and got <= want:
                    got += len(inflate.decompress(rest, STEP))
                    rest = inflate.unconsumed_tail
            except zlib.error:
                problem = CORRUPT
        elif kind == b"IEND":
            last = kind
            break
        last = kind
        at += 12 + n
    if problem is None and width * height <= MAX_PIXELS:
        while not inflate.eof and got <= want and (more := inflate.decompress(inflate.unconsumed_tail, STEP)):
            got += len(more)
        problem = TRUNCATED if got < want else CORRUPT if got > want else None
    return *facts, min(frames, 0x7FFFFFFF), problem


# ------------------------------------------------------------------ JPEG

#: Markers that begin a frame: all of C0 to CF but the tables C4, C8 and CC.
_FRAMES = {*range(0xC0, 0xD0)} - {0xC4, 0xC8, 0xCC}


def _jpeg(data: bytes) -> tuple:
    at, size, scans = 2, (None, None), 0
    while True:
        at = data.find(b"\xff", at)
        while 0 <= at < len(data) - 1 and data[at + 1] == 0xFF:  # fill bytes
            at += 1
        if at < 0 or at + 1 >= len(data):
            return *size, 1 if scans else None, TRUNCATED
        marker = data[at + 1]
        at += 2
        if marker == 0xD9:
            return *size, 1 if scans else None, None if scans and size[0] else CORRUPT
        if marker == 0 or marker == 1 or 0xD0 <= marker <= 0xD7:  # a stuffed byte, or a marker by itself
            if not scans:
                return *size, None, CORRUPT
            continue
        if marker == 0xD8:
            return *size, None, CORRUPT
        if at + 2 > len(data):
            return *size, 1 if scans else None, TRUNCATED
        (n,) = struct.unpack_from(">H", data, at)
        if n < 2:
            return *size, None, CORRUPT
        if at + n > len(data):
            return *size, 1 if scans else None, TRUNCATED
        if marker in _FRAMES and size[0] is None:
            if n < 8 or n != 8 + 3 * data[at + 7]:
                return None, None, None, CORRUPT
            height, width = struct.unpack_from(">HH", data, at + 3)
            if not width or not data[at + 7]:
                return None, None, None, CORRUPT
            size = (width, height or _lines(data, at))
            if not size[1]:
                return None, None, None, CORRUPT
        elif marker == 0xDA:
            if size[0] is None:
                return None, None, None, CORRUPT
            scans += 1
        at += n


def _lines(data: bytes, at: int) -> int | None:
    """The number of lines where the frame leaves it to a segment of its own."""
    found = data.find(b"\xff\xdc\x00\x04", at)
    return struct.unpack_from(">H", data, found + 4)[0] if 0 <= found <= len(data) - 6 else None


# ------------------------------------------------------------------ GIF


def _blocks(data: bytes, at: int) -> int:
    """Behind the sub-blocks at ``at``; -1 where the file ends first."""
    while at < len(data):
        n = data[at]
        at += 1 + n
        if not n:
            return at
    return -1


def _gif(data: bytes) -> tuple:
    if len(data) < 13:
        return None, None, None, TRUNCATED
    width, height, packed = struct.unpack_from("<HHB", data, 6)
    at, frames = 13 + (3 << (packed & 7) + 1 if packed & 0x80 else 0), 0
    if not width or not height:
        return None, None, None, CORRUPT
    while at < len(data):
        kind = data[at]
        if kind == 0x3B:
            return width, height, frames, None if frames else CORRUPT
        if kind == 0x2C:
            if at + 10 > len(data):
                break
            local = data[at + 9]
            at = _blocks(data, at + 11 + (3 << (local & 7) + 1 if local & 0x80 else 0))
            frames += at >= 0
        elif kind == 0x21:
            at = _blocks(data, at + 2)
        else:
            return width, height, frames, CORRUPT
        if at < 0:
            break
    return width, height, frames, TRUNCATED


# ------------------------------------------------------------------ WebP


def _webp_chunks(data: bytes, end: int) -> Iterator[tuple[bytes, int, int]]:
    at = 12
    while at + 8 <= end:
        kind, n = struct.unpack_from("<4sI", data, at)
        yield kind, at + 8, n
        at += 8 + n + (n & 1)


def _webp(data: bytes) -> tuple:
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    size, canvas, frames, problem = (None, None), None, 0, TRUNCATED if end > len(data) else None
    for kind, at, n in _webp_chunks(data, min(end, len(data))):
        room = min(n, len(data) - at)
        if kind == b"VP8X" and room >= 10:
            canvas = tuple(1 + int.from_bytes(data[i : i + 3], "little") for i in (at + 4, at + 7))
        elif kind == b"VP8 ":
            if room < 10:
                problem = problem or CORRUPT
                break
            if data[at] & 1 or data[at + 3 : at + 6] != b"\x9d\x01\x2a":
                return None, None, None, CORRUPT
            size = tuple(x & 0x3FFF for x in struct.unpack_from("<HH", data, at + 6))
            frames += 1
        elif kind == b"VP8L":
            if room < 5:
                problem = problem or CORRUPT
                break
            if data[at] != 0x2F:
                return None, None, None, CORRUPT
            bits = int.from_bytes(data[at + 1 : at + 5], "little")
            size = (1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF))
            frames += 1
        elif kind == b"ANMF":
            frames += 1
        if at + n > min(end, len(data)):
            problem = problem or CORRUPT
            break
    size = canvas or size
    if not size[0] or not size[1]:
        return None, None, None, problem or CORRUPT
    if not frames or (canvas and problem is None and size[0] * size[1] > 0xFFFFFFFF):
        problem = problem or CORRUPT
    return *size, frames or None, problem


# ------------------------------------------------------------------ all


def facts(data: bytes | None) -> tuple:
    """(format, width, height, frames, problem) of an image file; problem is null where it is sound.

    Width and height are null where they aren't known.  Null and empty data are ``empty``.
    """
    if not data:
        return None, None, None, None, EMPTY
    data = bytes(data)
    for name, heads, read in (("PNG", (_PNG,), _png), ("JPEG", (b"\xff\xd8\xff",), _jpeg), ("GIF", (b"GIF87a", b"GIF89a"), _gif)):
        if data.startswith(heads):
            return (name, *_safe(read, data))
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return ("WEBP", *_safe(_webp, data))
    heads = (_PNG, b"\xff\xd8\xff", b"GIF87a", b"GIF89a", b"RIFF")
    return None, None, None, None, TRUNCATED if any(h.startswith(data) for h in heads) else UNKNOWN


def _safe(read, data: bytes) -> tuple:
    try:
        return read(data)
    except (struct.error, IndexError, ValueError):
        return None, None, None, CORRUPT


def image_facts(content: str | Column) -> Column:
    """Struct of ``facts`` of a binary column, on Arrow batches."""

    @F.pandas_udf(FACTS)
    def run(content: pd.Series) -> pd.DataFrame:
        got = pd.DataFrame([facts(c) for c in content], columns=["format", "width", "height", "frames", "problem"])
        return got.astype({"width": "Int32", "height": "Int32", "frames": "Int32"})

    return run(col(content))


def with_status(df: DataFrame, content: str = "content") -> DataFrame:
    """``df`` with the image's facts and the status that follows from its bytes.

    What is truncated or corrupt can't be decoded; too big an image isn't decoded, so its
    size alone counts.
    """
    known = df.withColumn("__facts", image_facts(content))
    f = {c: F.col(f"__facts.{c}") for c in ("format", "width", "height", "frames", "problem")}
    failed = f["problem"].isNotNull() & ~F.coalesce(f["width"].cast("long") * f["height"] > MAX_PIXELS, F.lit(False))
    code = status(F.coalesce(F.octet_length(content), F.lit(0)), f["width"], f["height"], f["format"], failed)
    return known.select(*df.columns, *(f[c].alias(c) for c in f), code.alias("status"))
