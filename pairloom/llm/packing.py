"""Best-fit packing of token ids into sequences of a fixed length.

A document's ids and its end id are one piece; only a document longer than a sequence is
cut, into pieces of a sequence's length, of which the first may be shorter.  Pieces differ,
to packing, in their length alone, so bins are planned on the number of pieces of each
length (at most ``SEQUENCE`` numbers), whatever the number of pieces.

Best-two-fit.  A bin is filled greedily: the longest piece left, then the longest that fits
the gap, until none fits.  Then its smallest piece is put back for the two pieces left that
fit the gap and its place most tightly, if they make the gap smaller (once a bin: repeating
this took up to 3% more sequences).  The same bin
is made as often as the numbers of its pieces allow, which gives what making one bin
at a time gives; each kind of bin uses up some length, so there are a few thousand at most.

Spark does the rest by rows: a task that encodes numbers its pieces of each length from 0
as it writes them; the numbers of the tasks before it make that a number among all pieces
of the length; and a search in the broadcast plan turns (length, number) into a sequence
and a place there.  Nothing is gathered by a key, and no row but its length's number counts.

Token ids are those of the tokenizers library for whole texts, with special tokens in a text
as the library takes them.  Distinct pieces of the vocabulary's split are encoded once.  Where the library's
split and this module's pattern could differ (a character that a probe shows to be classed
differently), the library encodes the whole text.

Edge cases: a null or empty text is a piece of the end id alone; a null doc_id stays; rows
that share a doc_id, and repeated rows, are packed each for itself; no rows give no rows;
other columns are ignored; a text of any length is encoded whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, maybe_broadcast, slices, spread, written
from .tokenbin import BYTE_CHARS

SEQUENCE = 1024
END_ID = 2
#: Split pieces that a worker knows at once, and characters of the longest that is kept.
KNOWN, KEPT = 400_000, 40

Entry = tuple[int, int, int, int, int]


class Encoder:
    """Ids of texts by a byte-level tokenizers file, each distinct piece of its split encoded once."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.find = regex.compile(pattern).findall
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.same: set[str] = set()
        self.other: set[str] = set()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _probe(self, chars: set[str]) -> bool:
        """Whether the library splits around these characters as the pattern does."""
        for c in chars - self.same - self.other:
            texts = [f"a{c}1{c}!{c} {c}{c}a\n{c}"]
            split = [[t[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(t)] for t in texts]
            (self.same if split == [self.find(t) for t in texts] else self.other).add(c)
        return not chars & self.other

    def _make(self, piece: str) -> bytes:
        got = self.old.get(piece)
        if got is None:  # a piece of the split goes to the library's model
            letters = "".join([BYTE_CHARS[b] for b in piece.encode()])
            got = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(letters)])
        if len(piece) <= KEPT:
            if len(self.young) >= KNOWN // 2:
                self.old, self.young = self.young, {}
            self.young[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        chars = set(text)
        if not chars <= self.same and not self._probe(chars):
            return self.whole(text)
        if self.added.search(text):
            return self.whole(text)
        make, young = self._make, self.young
        return b"".join([young.get(p) or make(p) for p in self.find(text)])


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of a tokenizers file, made once."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def pieces(docs: DataFrame, path: str, pattern: str, length: int = SEQUENCE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece, with the task that made it and
    its number among that task's pieces of its length; with ``ids``, its ids too."""

    def run(batches):
        enc, end = encoder(path, pattern), np.array([end_id], "<u4").tobytes()
        task, made = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for b in slices(batches):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = enc.encode(text.as_py() or "") + end
                n = len(data) // 4
                cuts = [0, *range((n - 1) % length + 1, n + 1, length)]
                for i, (at, to) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    part = data[4 * at : 4 * to]
                    rows.append((doc_id, i, at, to - at, zlib.crc32(part), task, int(made[to - at]), part if ids else None))
                    made[to - at] += 1
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: 8 if ids else 7], names=names[: 8 if ids else 7])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long" + (", ids binary" if ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _bin(left: np.ndarray, length: int) -> dict[int, int]:
    """The next bin by best-two-fit: the number of its pieces of each length.  ``left`` (pieces
    of each length) loses them."""

    def largest(upto: int) -> int:
        found = np.flatnonzero(left[: upto + 1])
        return int(found[-1]) if len(found) else 0

    held: dict[int, int] = {}

    def take(size: int, n: int) -> None:
        left[size] -= n
        held[size] = held.get(size, 0) + n
        if not held[size]:
            del held[size]

    gap = length
    while gap and (size := largest(gap)):
        n = min(int(left[size]), gap // size)
        take(size, n)
        gap -= n * size
    if not gap:
        return held
    smallest = min(held)
    room = gap + smallest
    sizes = np.flatnonzero(left[: room + 1])
    if not len(sizes):
        return held
    # The best partner of each size: the largest that fits beside it, itself only if two are left.
    place = np.searchsorted(sizes, room - sizes, "right") - 1
    place -= (place >= 0) & (sizes[place] == sizes) & (left[sizes] < 2)
    pair = np.where(place >= 0, sizes + sizes[place], 0)
    if pair.max() > smallest:  # of equal pairs the most even, which leaves the small pieces
        best = int(np.lexsort((np.minimum(sizes, sizes[place]), pair))[-1])
        take(smallest, -1)
        take(int(sizes[best]), 1)
        take(int(sizes[place[best]]), 1)
    return held


def plan(counts: dict[int, int], length: int = SEQUENCE) -> tuple[dict[int, list[Entry]], int]:
    """Where the pieces of each length go: (first number, first sequence, pieces a sequence, place
    of the first there), by first number; and the number of sequences."""
    left = np.zeros(length + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    used = np.zeros(length + 1, np.int64)
    places: dict[int, list[Entry]] = {}
    sequences = 0
    while left.any():
        held = _bin(left, length)
        times = 1 + min(int(left[size]) // n for size, n in held.items())
        at = 0
        for size in sorted(held, reverse=True):
            n = held[size]
            places.setdefault(size, []).append((int(used[size]), sequences, n, at))
            left[size] -= n * (times - 1)
            used[size] += n * times
            at += n * size
        sequences += times
    return places, sequences


def pack(made: DataFrame, length: int = SEQUENCE) -> DataFrame:
    """Rows of ``pieces``, written, with sequence_id and offset in place of task and nth."""
    counts = made.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places, _ = plan(histogram, length)
    arrays = {size: np.array(rows, np.int64).T for size, rows in places.items()}
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = made.join(maybe_broadcast(before), ["length", "task"]).withColumn("number", F.col("nth") + F.col("before"))
    names = [c for c in made.columns if c not in ("task", "nth")]

    def run(batches):
        for b in batches:
            sizes, numbers = (b.column(i).to_numpy() for i in (b.num_columns - 2, b.num_columns - 1))
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                first, base, each, at = arrays[size]
                k = np.searchsorted(first, numbers[rows], "right") - 1
                nth = numbers[rows] - first[k]
                sequence[rows] = base[k] + nth // each[k]
                offset[rows] = at[k] + nth % each[k] * size
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {dict(made.dtypes)[c]}" for c in names) + ", sequence_id long, offset long"
    return numbered.select(*names, F.col("length").alias("__size"), F.col("number").alias("__number")).mapInArrow(run, schema)


def packed(docs: DataFrame, path: str, pattern: str, length: int = SEQUENCE, end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids_crc32, with ``ids`` its ids, sequence_id, offset."""
    return pack(written(pieces(docs, path, pattern, length, end_id, ids), "pieces"), length)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(spread(documents(spark, sf_dir)), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
