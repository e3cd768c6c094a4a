"""Token ids in binary files of patched frame-of-reference blocks.

Documents are encoded where they are read; their ids, a third of the texts' size, are
dealt out by ranges of doc_id and sorted, and each range's ids are appended to one file.
The ranges' bounds come from a sample of doc_ids; documents of one doc_id that would fill
several ranges are dealt to them by a digest of their ids.  A block holds ``BLOCK`` ids: the
block's least id is subtracted, the differences are packed at the width that covers
``PERCENT`` of them, and the rest go to the block's exception list.  A file ends with an
index of block starts and a table of documents, so any stretch of ids is read from its
blocks alone.

File layout, little-endian:
    magic "PLTB0001"
    blocks: uint32 least, uint16 ids, uint16 exceptions, uint8 width, packed differences
        (``width`` bits each, most significant first, the last byte padded),
        uint16 places and uint32 differences of the exceptions
    uint64 start of each block and the end of the last; int64 doc_id, uint8 not-null and
        uint64 ids of each document
    uint64 blocks, uint64 documents, uint64 ids, uint32 ids a block, magic "PLTB0001"

A file's name is unique to the task attempt that wrote it; the manifest, a table written
once, names those of the attempts that count.  So a lost executor leaves only files that
no manifest names.

Special tokens in a text are what the library makes of them by default: their own ids.

Edge cases: a null or empty text holds only the end id; a null doc_id sorts first;
documents that share a doc_id are ordered by a digest of their ids; no rows give no
files and no rows; other columns are ignored; a text of any length is encoded whole.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, new_path, slices, spread, written

MAGIC = b"PLTB0001"
BLOCK = 1024
PERCENT = 95
END_ID = 1
HEAD = struct.Struct("<IHHB")
TAIL = struct.Struct("<QQQI8s")
#: Sampled rows for each range of doc_ids.
SAMPLED = 100
SEED = 11
#: Words that a worker knows at once.
KNOWN = 600_000


def split_pattern(path: str) -> str | None:
    """The pattern by which a tokenizers file splits texts; None where it has no such step."""
    steps = json.loads(Path(path).read_text("utf-8")).get("pre_tokenizer") or {}
    return next((x["pattern"]["Regex"] for x in [steps, *steps.get("pretokenizers", [])] if "Regex" in x.get("pattern", {})), None)


def _byte_chars() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next after 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


BYTE_CHARS = _byte_chars()
#: ASCII punctuation but the apostrophe, which some pieces begin with.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Ids that a reader holds at once.
READ = 1 << 20


class Known(dict):
    """Ids of words as bytes, made when first asked for.  Two generations: when the younger
    is full it becomes the older, and what is used again is carried over."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word):
        if len(self) >= KNOWN // 2:
            self.old = dict(self)
            self.clear()
        got = self[word] = self.old.get(word) or self.make(word)
        return got


class WordEncoder:
    """Ids of texts by a tokenizers file, each distinct word (as cut by ASCII white space)
    encoded once.

    The vocabulary's normalization and split work within words, so the ids of a text are
    those of its words in order; ``whole`` encodes without this.  For a word of printable
    Latin-1 without a special token's string they are plain (lower case and the file's split), so
    its pieces go straight to the library's model, where a probe shows that the file's own
    steps do the same.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or "(?!)", re.IGNORECASE)
        self.packed = [i.to_bytes(self.kind.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        pattern = split_pattern(path)
        self.find = regex.compile(pattern or "(?!)").findall
        self.known = Known(self._word)
        self.pieces = Known(self._piece)
        latin = [c for c in map(chr, range(33, 256)) if c.isprintable()]
        probe = [a + b + "Ab'S" + a + "1" for a in latin for b in latin[:: 1 if a < "\x7f" else 9]]
        self.plain = pattern is not None and not any(c.isspace() for t in special for c in t)
        self.plain = self.plain and all(self._pieces(p) == self._bytes(x) for p, x in zip(probe, self.whole(probe), strict=True))
        if self.plain:  # and so are letters with punctuation behind them
            probe = [c + "Zé" + m for c in latin[::3] if c.isalpha() for m in (*MARKS, ".,", '!)"')]
            self.plain = all(self._word(p.encode()) == self._bytes(x) for p, x in zip(probe, self.whole(probe), strict=True))

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.tokenizer.model.tokenize(piece if piece.isascii() else "".join(map(BYTE_CHARS.__getitem__, piece.encode())))])

    def _pieces(self, word: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(word.lower())))

    def _word(self, word: bytes) -> bytes:
        t = word.decode("utf-8")
        if self.plain and (word.isascii() or max(t) < "\u0100"):
            # Most words are letters, and punctuation behind them: two pieces.
            low = t.lower()
            letters = low.rstrip(MARKS)
            if letters.isalpha() and "<" not in low:
                marks = low[len(letters) :]
                return self.pieces[letters] + self.pieces[marks] if marks else self.pieces[letters]
        if self.plain and t.isprintable() and (word.isascii() or max(t) < "\u0100") and not self.special.search(t):
            return self._pieces(t)
        return self._bytes(self.whole([t])[0])

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, packed."""
        return b"".join(map(self.known.__getitem__, (text or "").encode("utf-8").split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizers file, made once."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pack(values: np.ndarray, width: int) -> list[bytes]:
    """Each row of ``values`` (under 2**width) packed."""
    if not width:
        return [b""] * len(values)
    kind, bits = (">u2", 16) if width <= 16 else (">u4", 32)
    as_bits = np.unpackbits(np.ascontiguousarray(values.astype(kind)).view(np.uint8), axis=1).reshape(*values.shape, bits)[:, :, bits - width :]
    return [row.tobytes() for row in np.packbits(as_bits.reshape(len(values), -1), axis=1)]


def _unpack(data: np.ndarray, width: int, n: int) -> np.ndarray:
    """Rows of ``n`` values from rows of packed bytes."""
    if not width:
        return np.zeros((len(data), n), np.uint32)
    kind, bits = (">u2", 16) if width <= 16 else (">u4", 32)
    as_bits = np.zeros((len(data), n, bits), np.uint8)
    as_bits[:, :, bits - width :] = np.unpackbits(data, axis=1)[:, : n * width].reshape(len(data), n, width)
    return np.packbits(as_bits.reshape(len(data), -1), axis=1).view(kind).reshape(len(data), n).astype(np.uint32)


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of equally many ids, given as rows."""
    ids = ids.astype(np.uint32)
    n = ids.shape[1]
    least = ids.min(axis=1)
    rest = ids - least[:, None]
    cover = np.partition(rest, min(n - 1, n * PERCENT // 100), axis=1)[:, min(n - 1, n * PERCENT // 100)]
    widths = np.array([int(x).bit_length() for x in cover])
    out: list[bytes] = [b""] * len(ids)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        mine = rest[rows]
        over = mine >> width != 0 if width < 32 else np.zeros(mine.shape, bool)
        for k, packed in zip(rows.tolist(), _pack(np.where(over, 0, mine), width), strict=True):
            places = np.flatnonzero(rest[k] >> width) if width < 32 else np.zeros(0, np.int64)
            out[k] = b"".join((HEAD.pack(int(least[k]), n, len(places), width), packed, places.astype("<u2").tobytes(), rest[k][places].astype("<u4").tobytes()))
    return out


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks in ``data`` that begin at ``starts``, in order."""
    heads = [HEAD.unpack_from(data, s) for s in starts]
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(heads)
    raw = np.frombuffer(data, np.uint8)
    for n, width in {(h[1], h[3]) for h in heads}:
        rows = [k for k, h in enumerate(heads) if (h[1], h[3]) == (n, width)]
        size = (n * width + 7) // 8
        packed = np.stack([raw[starts[k] + HEAD.size : starts[k] + HEAD.size + size] for k in rows])
        values = _unpack(packed, width, n)
        for row, k in zip(values, rows, strict=True):
            least, _, exceptions, _ = heads[k]
            if exceptions:
                at = int(starts[k]) + HEAD.size + size
                row[np.frombuffer(data, "<u2", exceptions, at)] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
            out[k] = row + np.uint32(least)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _files(uri: str):
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents' ids to one file."""

    def __init__(self, out):
        self.out, self.at = out, len(MAGIC)
        self.starts: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        self.held, self.n_held, self.n_ids = [], 0, 0
        out.write(MAGIC)

    def _blocks(self, ids: np.ndarray) -> None:
        blocks = pack_blocks(ids)
        for b in blocks:
            self.starts.append(self.at)
            self.at += len(b)
        self.out.write(b"".join(blocks))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= 256 * BLOCK:
            flat = np.concatenate(self.held)
            whole = len(flat) // BLOCK
            for i in range(0, whole, 256):
                self._blocks(flat[i * BLOCK : min(i + 256, whole) * BLOCK].reshape(-1, BLOCK))
            self.held, self.n_held = [flat[whole * BLOCK :]], len(flat) - whole * BLOCK

    def close(self) -> int:
        """Write what is held, the index and the table; the file's bytes."""
        if self.n_held:
            flat = np.concatenate(self.held)
            whole = len(flat) // BLOCK
            if whole:
                self._blocks(flat[: whole * BLOCK].reshape(-1, BLOCK))
            if len(flat) % BLOCK:
                self._blocks(flat[whole * BLOCK :][None, :])
        ids = np.array([d or 0 for d, _ in self.docs], "<i8")
        there = np.array([d is not None for d, _ in self.docs], np.uint8)
        counts = np.array([n for _, n in self.docs], "<u8")
        tail = b"".join((np.array([*self.starts, self.at], "<u8").tobytes(), ids.tobytes(), there.tobytes(), counts.tobytes(), TAIL.pack(len(self.starts), len(self.docs), self.n_ids, BLOCK, MAGIC)))
        self.out.write(tail)
        self.out.close()
        return self.at + len(tail)


class Reader:
    """Reads a file's documents, or any stretch of its ids through the block index."""

    def __init__(self, uri: str):
        system, path = _files(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        blocks, n_docs, self.n_ids, self.block, magic = TAIL.unpack(self._at(size - TAIL.size, TAIL.size))
        if magic != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        at = size - TAIL.size - 17 * n_docs - 8 * (blocks + 1)
        self.starts = np.frombuffer(self._at(at, 8 * (blocks + 1)), "<u8").astype(np.int64)
        at += 8 * (blocks + 1)
        there = np.frombuffer(self._at(at + 8 * n_docs, n_docs), np.uint8)
        self.doc_ids = [d if t else None for d, t in zip(np.frombuffer(self._at(at, 8 * n_docs), "<i8").tolist(), there.tolist(), strict=True)]
        self.counts = np.frombuffer(self._at(at + 9 * n_docs, 8 * n_docs), "<u8").astype(np.int64)

    def _at(self, start: int, n: int) -> bytes:
        return self.file.read_at(n, start)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last - 1``; only their blocks are read."""
        if last <= first:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, (last - 1) // self.block + 1
        start = int(self.starts[a])
        got = unpack_blocks(self._at(start, int(self.starts[b]) - start), self.starts[a:b] - start)
        return got[first - a * self.block : last - a * self.block]

    def documents(self):
        """(doc_id, first id, ids) of each document, in order."""
        ends = np.cumsum(self.counts)
        held, low, high = np.zeros(0, np.uint32), 0, 0
        for d, n, end in zip(self.doc_ids, self.counts.tolist(), ends.tolist(), strict=True):
            if end > high:
                low, high = end - n, min(self.n_ids, max(end, end - n + READ))
                held = self.ids(low, high)
            yield d, end - n, held[end - n - low : end - low]

    def close(self) -> None:
        self.file.close()


def write_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode and write all documents; the manifest, a written table: file (its place in
    order), path, first_id (the least doc_id), n_docs, n_ids, n_bytes of each file."""

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(range_bounds(docs))  # SAMPLED longs a range at most

    def encoded(batches):
        enc, bounds = encoder(tokenizer), shared.value
        end = np.array([end_id], enc.kind).tobytes()
        for b in slices(batches, 1024):
            ids = [enc.encode(t) + end for t in b.column(1).to_pylist()]
            digest = np.fromiter((zlib.crc32(x) for x in ids), np.int64, len(ids))
            place = _ordered(b.column(0))
            low, high = np.searchsorted(bounds, place, "left"), np.searchsorted(bounds, place, "right")
            file = low + (digest * (high - low + 1) >> 32)
            yield pa.RecordBatch.from_arrays([pa.array(file), b.column(0), pa.array(digest), pa.array(ids, pa.binary()), pa.array([enc.kind.itemsize] * len(ids), pa.int32())], names=["file", "doc_id", "digest", "ids", "width"])

    def run(batches):
        writer, now, name, first = None, None, "", None

        def done():
            row = [now, name, first, len(writer.docs), writer.n_ids, writer.close()]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.string() if i == 1 else pa.int64()) for i, x in enumerate(row)], names=["file", "path", "first_id", "n_docs", "n_ids", "n_bytes"])

        for b in slices(batches, 1024):
            for file, d, ids, width in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
                if file != now:
                    if writer is not None:
                        yield done()
                    now, name, first = file, f"{folder}/{uuid.uuid4().hex}.pltb", d
                    system, path = _files(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    writer = Writer(system.open_output_stream(path))
                writer.add(d, np.frombuffer(ids, f"<u{width}"))
        if writer is not None:
            yield done()

    ids = docs.select("doc_id", "text").mapInArrow(encoded, "file long, doc_id long, digest long, ids binary, width int")
    dealt = ids.repartition("file").sortWithinPartitions("file", "doc_id", "digest", "ids")
    return written(dealt.mapInArrow(run, "file long, path string, first_id long, n_docs long, n_ids long, n_bytes long"), "manifest")


def _ordered(doc_id: pa.Array) -> np.ndarray:
    """doc_ids as numbers; a null comes first."""
    return np.asarray(doc_id.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), np.int64)


def range_bounds(docs: DataFrame) -> np.ndarray:
    """The doc_ids that part ``docs`` in as many ranges as a shuffle has partitions, from a
    sample of some ``SAMPLED`` rows a range.  Files of any sizes would do: the sample decides
    how evenly they are filled, nothing else."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id")
    share = min(1.0, SAMPLED * n / max(1, rows.count()))
    found = np.sort(_ordered(rows.where(F.rand(SEED) < share).toArrow().column(0).combine_chunks()))
    return found[(np.arange(1, n) * len(found)) // n] if len(found) else found


def read_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of each document
    of the manifest's files.

    The manifest has a row a file, which the driver gathers for the files' first ids.
    """
    files, start = [], 0
    for r in manifest.orderBy("file").collect():
        files.append((r.path, start))
        start += r.n_ids
    if not files:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def run(batches):
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                reader, rows = Reader(path), []
                for d, at, ids in reader.documents():
                    rows.append((d, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=names)
                reader.close()

    dealt = spark.createDataFrame(spark.sparkContext.parallelize(files, len(files)), "path string, base long")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_path(spark, "tokens")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_files(spark, write_files(spread(documents(spark, sf_dir)), public_tokenizers.path("word_bpe_49k.json"), folder))
