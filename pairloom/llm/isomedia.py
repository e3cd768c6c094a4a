"""ISO media containers (ISO/IEC 14496-12): writing lossless 8-bit sound tracks, and
reading any file's tracks from its boxes.

``tracks`` walks the nested boxes and decodes the sample tables: codec, time scale,
duration, and the byte range of every key frame, without reading the payload.  Box sizes
of 32 and 64 bits and to the end of the file, sample sizes of stsz and stz2, chunk
offsets of stco and co64, and the fragments of a film (moof, with trex defaults) are
read.  A file whose boxes don't fit together, or whose tables claim more samples than
the file has bytes for, gives an error text and no tracks; boxes may be nested at any depth.

``from_texts`` stores a text's UTF-8, padded with zero bytes to a positive multiple of
``FRAME``, as one track of unsigned 8-bit samples ('raw '), a frame of ``FRAME`` bytes
per sample entry, every ``KEY``-th frame a sync sample and ``CHUNK`` frames a chunk.
Equal texts give equal bytes.

Edge cases: a null or empty text stores one frame of zeros and n_bytes 0; a null media
value gives null features; repeated rows repeat; no rows give no rows; a column that has
an output's name is ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, slices, written

FRAME = 64
KEY = 16
CHUNK = 256
RATE = 8000
#: Fixed values of the format: boxes that hold boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}


class Malformed(ValueError):
    """The bytes are not a media file that can be read."""


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def container(payload: bytes) -> bytes:
    """A media file with ``payload`` (a positive multiple of ``FRAME`` bytes) as its track."""
    frames, rest = divmod(len(payload), FRAME)
    if rest or not frames:
        raise ValueError("the payload is no positive multiple of a frame")
    length = frames * FRAME
    chunks = -(-frames // CHUNK)
    wide = length + 4096 + 8 * chunks + frames >= 1 << 31
    last = frames - (chunks - 1) * CHUNK
    runs = [(1, CHUNK), (chunks, last)] if chunks > 1 and last != CHUNK else [(1, min(frames, CHUNK))]
    keys = np.arange(1, frames + 1, KEY, dtype=">u4")
    entry = _box(b"raw ", struct.pack(">6xH8xHHHHI", 1, 1, 8, 0, 0, RATE << 16))

    def moov(first: int) -> bytes:
        offsets = first + np.arange(chunks, dtype=np.int64) * (CHUNK * FRAME)
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, frames, FRAME)),
            _full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", a, n, 1) for a, n in runs)),
            _full(b"stsz", struct.pack(">II", FRAME, frames)),
            _full(b"co64", struct.pack(">I", chunks), offsets.astype(">u8").tobytes()) if wide else _full(b"stco", struct.pack(">I", chunks), offsets.astype(">u4").tobytes()),
        )
        dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
        minf = _box(b"minf", _full(b"smhd", bytes(4)), dinf, stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, RATE, length, 0x55C4, 0), version=1), _full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"sound\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">QQIIQ8xHHHH", 0, 0, 1, 0, length, 0, 0, 0x100, 0), _MATRIX, bytes(8), version=1, flags=7)
        mvhd = _full(b"mvhd", struct.pack(">QQIQIH10x", 0, 0, RATE, length, 0x10000, 0x100), _MATRIX, bytes(24), struct.pack(">I", 2), version=1)
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    head = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    at = len(head) + len(moov(0)) + (16 if length + 8 >= 1 << 32 else 8)
    return head + moov(at) + _box(b"mdat", payload)


def boxes(data: bytes, start: int = 0, end: int | None = None):
    """(kind, first byte of the body, end, first byte) of each box; nested boxes aren't entered."""
    end = len(data) if end is None else end
    while start < end:
        if end - start < 8:
            raise Malformed("a box is cut short")
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if end - start < 16:
                raise Malformed("a box is cut short")
            (size,) = struct.unpack_from(">Q", data, start + 8)
            head = 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise Malformed("a box's size doesn't fit")
        yield kind, start + head, start + size, start
        start += size


def tree(data: bytes) -> list:
    """All boxes as (kind, first byte of the body, end, boxes within, first byte)."""
    out: list = []
    todo = [(0, len(data), out)]
    while todo:
        start, end, into = todo.pop()
        for kind, a, b, first in boxes(data, start, end):
            into.append((kind, a, b, [], first))
            if kind in CONTAINERS:
                todo.append((a, b, into[-1][3]))
    return out


def _find(nodes: list, *kinds: bytes):
    for kind in kinds:
        node = next((n for n in nodes if n[0] == kind), None)
        if node is None:
            return None
        nodes = node[3]
    return node


def _table(data: bytes, node, kind: str, columns: int = 1, skip: int = 8) -> np.ndarray:
    n = struct.unpack_from(">I", data, node[1] + skip - 4)[0]
    if node[1] + skip + n * columns * np.dtype(kind).itemsize > node[2]:
        raise Malformed("a table is cut short")
    return np.frombuffer(data, kind, n * columns, node[1] + skip).astype(np.int64).reshape(n, columns)


class Left:
    """Samples that a file may still have: as many as its bytes, over all its tracks and runs."""

    def __init__(self, data: bytes):
        self.n = len(data)

    def take(self, n: int) -> None:
        self.n -= n
        if self.n < 0:
            raise Malformed("more samples than the file has bytes for")


def _sizes(data: bytes, stbl, left: Left) -> np.ndarray:
    if node := _find(stbl, b"stsz"):
        uniform, n = struct.unpack_from(">II", data, node[1] + 4)
        if uniform and n > len(data) // uniform:
            raise Malformed("more samples than the file has bytes for")
        left.take(n)
        return np.full(n, uniform, np.int64) if uniform else _table(data, node, ">u4", skip=12)[:, 0]
    if node := _find(stbl, b"stz2"):
        bits, n = struct.unpack_from(">xxxBI", data, node[1] + 4)
        left.take(n)
        if bits == 4:
            raw = np.frombuffer(data, np.uint8, (n + 1) // 2, node[1] + 12)
            return np.stack((raw >> 4, raw & 15), axis=1).reshape(-1)[:n].astype(np.int64)
        return np.frombuffer(data, np.uint8 if bits == 8 else ">u2", n, node[1] + 12).astype(np.int64)
    raise Malformed("a track has no sample sizes")


def _in_chunks(data: bytes, stbl: list, left: Left) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The starts and sizes of the samples of a sample table, and the indexes of its key frames."""
    stsc, offsets = _find(stbl, b"stsc"), _find(stbl, b"stco") or _find(stbl, b"co64")
    if not (stsc and offsets):
        raise Malformed("a track lacks a table")
    sizes = _sizes(data, stbl, left)
    at = _table(data, offsets, ">u4" if offsets[0] == b"stco" else ">u8")[:, 0]
    runs = _table(data, stsc, ">u4", 3)
    if len(runs) and (runs[0, 0] != 1 or (np.diff(runs[:, 0]) <= 0).any() or runs[-1, 0] > max(len(at), 1)):
        raise Malformed("the runs of chunks don't fit")
    per = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0], max(len(at), 1) + 1)))[: len(at)] if len(runs) else np.zeros(0, np.int64)
    if len(per) != len(at) or (per > len(sizes)).any() or per.sum() != len(sizes):
        raise Malformed("the chunks don't hold the samples")
    chunk = np.repeat(np.arange(len(at)), per)
    before = np.cumsum(sizes) - sizes
    first = np.cumsum(per) - per
    starts = at[chunk] + before - before[first[chunk]] if len(sizes) else before
    sync = _find(stbl, b"stss")
    keys = _table(data, sync, ">u4")[:, 0] - 1 if sync else np.arange(len(sizes))
    if len(keys) and (keys.min() < 0 or keys.max() >= len(sizes)):
        raise Malformed("a key frame is no sample")
    return starts, sizes, keys


def _lasting(data: bytes, stbl: list) -> int:
    """The samples' time, by the table of times to sample."""
    node = _find(stbl, b"stts")
    return sum(n * d for n, d in _table(data, node, ">u4", 2).tolist()) if node else 0


#: Bit of a sample's flags: not a sync sample.
_NO_KEY = 0x10000


def _fragments(data: bytes, nodes: list, left: Left) -> dict[int, list]:
    """By track number: (starts, sizes, whether key frames, time) of each run of each fragment."""
    defaults = {}
    for mvex in (n for n in (_find(nodes, b"moov") or (0, 0, 0, []))[3] if n[0] == b"mvex"):
        for trex in (n for n in mvex[3] if n[0] == b"trex"):
            track, _, *rest = struct.unpack_from(">5I", data, trex[1] + 4)
            defaults[track] = rest
    out: dict[int, list] = {}
    for moof in (n for n in nodes if n[0] == b"moof"):
        at = moof[4]  # where the next run begins unless it says so
        for traf in (n for n in moof[3] if n[0] == b"traf"):
            tfhd = _find(traf[3], b"tfhd")
            if not tfhd:
                raise Malformed("a fragment lacks a box")
            flags, track = struct.unpack_from(">II", data, tfhd[1])
            place, duration, size, kind = tfhd[1] + 8, *defaults.get(track, (0, 0, 0))
            base = moof[4] if flags & 0x20000 else at
            if flags & 1:
                (base,) = struct.unpack_from(">Q", data, place)
                place += 8
            place += 4 * bool(flags & 2)
            held = []
            for bit, value in ((8, duration), (0x10, size), (0x20, kind)):
                if flags & bit:
                    (value,) = struct.unpack_from(">I", data, place)
                    place += 4
                held.append(value)
            at = base
            for trun in (n for n in traf[3] if n[0] == b"trun"):
                at = _run(data, trun, base, at, held, out.setdefault(track, []), left)
    return out


def _run(data: bytes, trun, base: int, at: int, held: list[int], into: list, left: Left) -> int:
    """Adds one run's samples; the byte behind them."""
    flags, n = struct.unpack_from(">II", data, trun[1])
    place = trun[1] + 8
    if flags & 1:
        at = base + struct.unpack_from(">i", data, place)[0]
        place += 4
    first = None
    if flags & 4:
        (first,) = struct.unpack_from(">I", data, place)
        place += 4
    fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
    if n > len(data) or place + 4 * n * len(fields) > trun[2]:
        raise Malformed("more samples than the file has bytes for")
    left.take(n)
    table = np.frombuffer(data, ">u4", n * len(fields), place).astype(np.int64).reshape(n, len(fields))
    times, sizes, kinds = (table[:, fields.index(bit)] if bit in fields else np.full(n, value, np.int64) for bit, value in zip((0x100, 0x200, 0x400), held, strict=True))
    keys = kinds & _NO_KEY == 0
    if first is not None and n:
        keys[0] = not first & _NO_KEY
    if not 0 <= at <= len(data):
        raise Malformed("a sample is outside the file")
    into.append((at + np.cumsum(sizes) - sizes, sizes, keys, int(times.sum())))
    return at + int(sizes.sum())


def tracks(data: bytes) -> list[dict]:
    """For each track: codec, handler, timescale, duration, n_samples, starts and sizes of
    its samples (arrays), and keyframes, the indexes of its sync samples.

    The duration is the track's own; where that is 0 or unknown (all ones), as it is in
    fragmented films, the time of its samples.
    """
    try:
        nodes = tree(data)
        out = []
        left = Left(data)
        fragments = _fragments(data, nodes, left)
        for trak in (n for n in (_find(nodes, b"moov") or (0, 0, 0, []))[3] if n[0] == b"trak"):
            mdia = _find(trak[3], b"mdia")
            mdhd, hdlr, stbl = (_find(mdia[3], *x) for x in ((b"mdhd",), (b"hdlr",), (b"minf", b"stbl"))) if mdia else (None,) * 3
            if not (mdhd and hdlr and stbl):
                raise Malformed("a track lacks a box")
            wide = bool(data[mdhd[1]])
            scale, duration = struct.unpack_from(">IQ" if wide else ">II", data, mdhd[1] + (20 if wide else 12))
            stsd, tkhd = _find(stbl[3], b"stsd"), _find(trak[3], b"tkhd")
            if not stsd:
                raise Malformed("a track lacks a table")
            codec = struct.unpack_from(">4s", data, stsd[1] + 12)[0]
            starts, sizes, keys = _in_chunks(data, stbl[3], left)
            parts = fragments.get(struct.unpack_from(">I", data, tkhd[1] + (20 if data[tkhd[1]] else 12))[0], []) if tkhd else []
            if duration in (0, (1 << (64 if wide else 32)) - 1):
                duration = _lasting(data, stbl[3]) + sum(p[3] for p in parts)
            keys = np.concatenate([keys, *(np.flatnonzero(p[2]) + n for p, n in zip(parts, np.cumsum([len(sizes), *(len(p[1]) for p in parts)]).tolist(), strict=False))])
            starts, sizes = np.concatenate([starts, *(p[0] for p in parts)]), np.concatenate([sizes, *(p[1] for p in parts)])
            if len(sizes) and (starts.min() < 0 or (starts + sizes).max() > len(data)):
                raise Malformed("a sample is outside the file")
            out.append({"codec": codec.decode("latin-1"), "handler": data[hdlr[1] + 8 : hdlr[1] + 12].decode("latin-1"), "timescale": scale, "duration": duration, "starts": starts, "sizes": sizes, "keyframes": keys})
        if not out:
            raise Malformed("no track")
        return out
    except (struct.error, ValueError, IndexError, OverflowError, MemoryError) as e:
        raise Malformed(str(e)) from e


def payload(data: bytes, track: dict) -> bytes:
    """The track's samples in order; adjoining samples are read at once."""
    starts, ends = track["starts"], track["starts"] + track["sizes"]
    cuts = np.flatnonzero(starts[1:] != ends[:-1]) + 1
    return b"".join(data[a:b] for a, b in zip(starts[np.append(0, cuts)].tolist(), ends[np.append(cuts - 1, len(ends) - 1)].tolist(), strict=True)) if len(starts) else b""


def key_ranges(track: dict) -> list[tuple[int, int]]:
    """First byte and end of each key frame."""
    keys = track["keyframes"]
    starts = track["starts"][keys]
    return list(zip(starts.tolist(), (starts + track["sizes"][keys]).tolist(), strict=True))


_RANGES = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_TRACKS = pa.list_(pa.struct([("handler", pa.string()), ("codec", pa.string()), ("duration_s", pa.float64()), ("n_samples", pa.int64()), ("keyframes", _RANGES)]))


def _told(track: dict) -> dict:
    ranges = [{"first": a, "end": e} for a, e in key_ranges(track)]
    return {"handler": track["handler"], "codec": track["codec"], "duration_s": track["duration"] / track["timescale"] if track["timescale"] else None, "n_samples": len(track["sizes"]), "keyframes": ranges}


def media_columns(df: DataFrame, media: str = "media", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: doc_id) and, of each media value's main track (the first
    of pictures, else the first): codec, duration_s, n_samples, keyframes (byte ranges);
    then tracks, the same of every track with its handler, and error where it can't be read."""
    keep = ["doc_id"] if keep is None else keep
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "codec string, duration_s double, n_samples long, keyframes array<struct<first: bigint, end: bigint>>, tracks array<struct<handler: string, codec: string, duration_s: double, n_samples: bigint, keyframes: array<struct<first: bigint, end: bigint>>>>, error string"])

    def run(batches):
        for b in slices(batches, 64):
            rows = []
            for x in b.column(len(keep)).to_pylist():
                try:
                    every = [_told(t) for t in tracks(x)] if x is not None else []
                    main = next((t for t in every if t["handler"] == "vide"), every[0] if every else {})
                    rows.append((*map(main.get, ("codec", "duration_s", "n_samples", "keyframes")), every or None, None))
                except Malformed as e:
                    rows.append((None,) * 5 + (str(e),))
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), (pa.string(), pa.float64(), pa.int64(), _RANGES, _TRACKS, pa.string()), strict=True)] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *arrays], names=[*keep, "codec", "duration_s", "n_samples", "keyframes", "tracks", "error"])

    return df.select(*keep, df[media].alias("__pl_media")).mapInArrow(run, schema)


def padded(text: str | None) -> tuple[int, bytes]:
    """Bytes of the text, and its payload."""
    raw = (text or "").encode("utf-8")
    return len(raw), raw + bytes(-len(raw) % FRAME if raw else FRAME)


def from_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each text stored as a media file."""

    def run(batches):
        for b in slices(batches, 64):
            got = [padded(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array([container(p) for _, p in got], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", docs[text].alias("__pl_text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def feature(track: dict) -> str:
    """A line of text: codec, duration, samples, key frames and a digest of their ranges."""
    ranges = key_ranges(track)
    digest = hashlib.sha256(",".join(f"{a}-{b}" for a, b in ranges).encode()).hexdigest()[:16]
    return f"codec={track['codec'].strip()};rate={track['timescale']};duration={track['duration']};samples={len(track['sizes'])};keyframes={len(ranges)};first_key={ranges[0][0]}-{ranges[0][1]};ranges={digest}"


def digests(stored: DataFrame) -> DataFrame:
    """What is read back of stored media: the payload's size and digests, the stored
    form's, and the feature line."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        for b in slices(batches, 64):
            rows = []
            for x in b.column(2).to_pylist():
                track = tracks(x)[0]
                p = payload(x, track)
                rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-FRAME:]), len(x), hashlib.sha256(x).hexdigest(), feature(track)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            if rows:
                yield pa.RecordBatch.from_arrays([*b.columns[:2], *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(written(from_texts(documents(spark, sf_dir)), "media"))
