"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs are taken over all training texts.  An n-gram's count is
quantised to a level (exact to 4, then two levels an octave), and the n-gram is put in
the filter once for each level up to its own; probing level after level until one fails
gives the count back.  The smoothed probability of a word is

    p(w)     = (1 - u) c(w) / N, and u for a word that isn't found
    p(w | h) = (c(hw) + MU p(w)) / (c(h) + MU)

with c the probed counts, N the training tokens and u = (words seen once + 1/2) / (N + 1).
Every trained word and pair is in the filter, whatever its count.  Each token but a text's
end comes before just one other, so c(h) is also the count of the pairs after h; a
text's start has the count of the ends.

How the work is dealt.  Words and pairs are 64-bit numbers, the shard of a number is a
range of them, and a part is a few shards that follow one another, with a task of its own.
Workers count some ``HELD`` tokens at a time and send what each part gets as
one row of packed numbers and counts; the task that gathers a part adds these up,
keeps the words' exact counts, and fills the shards of the filter.  The numbers of shards and
parts follow the size of the texts, so what either holds is bounded at any size.

The filter is broadcast to workers if it has at most ``FILTER_BYTES``.  Beyond that, probes
are dealt instead: each lot of texts sends its distinct words and pairs to their parts and
gets the levels back, by the same shuffle that exact counts take (below), and every text
is read twice, at any size.  A part answers many lots' numbers at once.

base_score needs every word's exact count.  The most frequent words, at most ``TOP``, are
broadcast; each lot's other distinct words are sent to their parts as packed rows, and
the counts come back in the same way.

Words are told apart by 64-bit numbers (a polynomial of their bytes): of a billion words
one pair in 37 such corpora would share one.  A pair's number is mixed from both words'
whole numbers.

Edge cases: a null or empty text has one token, its end; a text longer than ``LOT`` bytes is
taken in pieces cut at white space, with the same result; a null doc_id is trained on;
repeated rows each count and get equal scores; without training texts every base term is
log10(1); no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, written

#: The end of a text as a token, and its start as a context: numbers, as words have.
END = np.uint64(0xA0761D6478BD642F)
START = np.uint64(0xE7037ED1A0B428DB)
#: The bytes between words.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
GAP = re.compile(rb"[\x20\x09-\x0d]")
#: Bytes of texts whose tokens are handled at once.
LOT = 1 << 19
#: Bytes whose lookups are dealt as one.
RECORD = 1 << 22
MU = 4.0
#: Bits set for an entry, all in one 64-bit word, and filter bits an entry of a pair: some
#: two probes in a hundred err.  Words, of which an unknown one taken for known costs
#: most, have twice the bits: some two probes in a thousand err.
PROBES = 6
BITS = 12.0
#: Bytes of a filter that goes to every worker.
FILTER_BYTES = 160 << 20
TOP = 100_000
#: Tokens that a worker counts before it passes the counts on.
HELD = 1 << 20
#: Bytes of texts a shard: some 400,000 tokens.
SHARD_TEXT = 2 << 20
#: Bytes of texts a part.
PART_TEXT = 8 << 20
#: Numbers that a part answers at once.
ANSWERED = 1 << 18
#: Numbers that are gathered before equal ones are added up.
GATHERED = 1 << 21

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LEVELS = 128


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit number of each (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def level(c: np.ndarray) -> np.ndarray:
    """The level of each count of 1 or more."""
    c = np.asarray(c, np.float64)
    return np.where(c < 4, c, 4 + np.floor(2 * np.log2(np.maximum(c, 4) / 4) + 1e-9)).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; 0 for level 0."""
    return _COUNTS[np.asarray(levels, np.int64)]


_at = np.arange(_LEVELS)
_COUNTS = np.where(_at < 4, _at, 4 * 2.0 ** ((_at - 4) / 2) * 2**0.25)


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Each number's shard of ``n``: ranges of equal width, so sorted numbers are sorted by shard."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_shard(keys: np.ndarray, n: int, parts: int | None = None):
    """(shard, first, last) of each shard that sorted ``keys`` fall in; with ``parts``, of each part of the shards."""
    if not len(keys):
        return
    shard = shard_of(keys, n) if parts is None else shard_of(keys, n) * parts // n
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    yield from zip(shard[first].tolist(), first.tolist(), np.append(first[1:], len(keys)).tolist(), strict=True)


def spots(keys: np.ndarray, at: int, words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """For each key's entry of level ``at``: its word in a shard of ``words`` words, and its bits there."""
    h = mixed(keys + np.array([at], np.uint64) * _GOLD)
    g = mixed(h ^ _M1)
    bits = np.zeros(len(h), np.uint64)
    for i in range(PROBES):
        bits |= np.uint64(1) << ((g >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.asarray(words, np.uint64) >> np.uint64(32)).astype(np.int64), bits


def fill(keys: np.ndarray, counts: np.ndarray, bits_each: float = BITS) -> np.ndarray:
    """The filter's shard that holds ``keys``, each up to the level of its count."""
    levels = level(counts)
    data = np.zeros(math.ceil(int(levels.sum()) * bits_each / 64) + 1, "<u8")
    at = 0
    while len(keys):
        at += 1
        for i in range(0, len(keys), GATHERED // 8):
            word, bits = spots(keys[i : i + GATHERED // 8], at, len(data))
            np.bitwise_or.at(data, word, bits)
        more = levels > at
        keys, levels = keys[more], levels[more]
    return data


class Filter:
    """A filter's shards, ready to be probed: ``sizes`` 64-bit words each, one after the other.
    They may be some of ``n`` shards, from ``first`` on."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, first: int = 0, n: int | None = None):
        self.data, self.sizes, self.first, self.n = data, sizes.astype(np.uint64), first, n or len(sizes)
        self.starts = np.cumsum(sizes, dtype=np.int64) - sizes.astype(np.int64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level that each key reaches; 0 for one that isn't found."""
        out = np.zeros(len(keys), np.uint8)
        left = np.arange(len(keys))
        shard = shard_of(keys, self.n) - self.first
        base, size = self.starts[shard], self.sizes[shard]
        at = 0
        while len(left) and at < _LEVELS - 1:
            at += 1
            word, bits = spots(keys, at, size)
            hit = self.data[base + word] & bits == bits
            left, keys, base, size = left[hit], keys[hit], base[hit], size[hit]
            out[left] = at
        return out


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for each word of the bytes, and where it begins: a polynomial in the
    word's bytes, mixed with its length.  Bytes are taken in lots, to bound memory."""
    solid = ~SPACE[data]
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.empty(len(starts), np.uint64)
    lengths = ends - starts
    total = np.cumsum(lengths)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + LOT, "right")))
        n = lengths[i:j]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        power = np.cumprod(np.full(int(n.max()), 0x5851F42D4C957F2D, np.uint64))
        term = (data[np.repeat(starts[i:j], n) + place].astype(np.uint64) + np.uint64(1)) * power[place]
        out[i:j] = mixed(np.add.reduceat(term, first) + n.astype(np.uint64) * _GOLD)
        i = j
    return out, starts


class Lot:
    """Some whole texts, or a piece of a long one, as tokens.

    ``of``: the index of each piece's text; ``lengths``: its tokens; ``before``: the number
    of the token before each token.
    """

    def __init__(self, pieces: list[tuple[int, bytes, bool, bool]], carried: np.uint64 = START):
        """``pieces``: (index, bytes, whether the text begins, whether it ends); ``carried``: the
        last token before a piece that doesn't begin its text."""
        raw = [p[1].lower() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        ends = np.array([p[3] for p in pieces])
        words, starts = word_hashes(np.frombuffer(b" ".join([*raw, b""]), np.uint8))
        piece = np.searchsorted(np.cumsum(sizes), starts, "right")
        self.of = np.array([p[0] for p in pieces])
        self.lengths = np.bincount(piece, minlength=len(raw)) + ends
        self.tokens = np.empty(len(words) + int(ends.sum()), np.uint64)
        last = np.cumsum(self.lengths) - 1
        self.tokens[last[ends]] = END
        self.tokens[np.arange(len(words)) + (np.cumsum(ends) - ends)[piece]] = words
        self.before = np.empty_like(self.tokens)
        if len(self.tokens):
            self.before[1:] = self.tokens[:-1]
            some = self.lengths > 0
            self.before[(last - self.lengths + 1)[some]] = np.where([p[2] for p in pieces], START, carried)[some]

    def pairs(self) -> np.ndarray:
        return pair_numbers(self.before, self.tokens)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Each piece's sum of its tokens' ``values``."""
        return np.bincount(np.repeat(np.arange(len(self.lengths)), self.lengths), values, len(self.lengths))


def pair_numbers(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """A 64-bit number for each token after the one before it."""
    return mixed(mixed(before ^ _M2) + tokens)


def lots(texts: list[str | None]):
    """The texts as ``Lot``s of some ``LOT`` bytes, in order."""
    held, size, carried = [], 0, START
    for k, t in enumerate(texts):
        raw = (t or "").encode("utf-8")
        i = 0
        while len(raw) - i > LOT and (gap := GAP.search(raw, i + LOT)):
            lot = Lot([*held, (k, raw[i : gap.end()], i == 0, False)], carried)
            carried = lot.tokens[-1] if lot.lengths[-1] else (START if i == 0 else carried)
            held, size = [], 0
            yield lot
            i = gap.end()
        held.append((k, raw[i:] if i else raw, i == 0, True))
        size += len(raw) - i + 1
        if size >= LOT:
            yield Lot(held, carried)
            held, size = [], 0
    if held:
        yield Lot(held, carried)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


def added_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``keys``, sorted, and the sum of each one's ``counts`` (1 each by default)."""
    if counts is None:
        keys.sort()
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(keys) else counts
    return keys[first], sums


_SHARDS = "shard int, n long, v long, ones long, levels array<bigint>, words binary, counts binary, word_bits binary, pair_bits binary"


def count(docs: DataFrame, n: int, bits: float = BITS, parts: int = 1) -> DataFrame:
    """The counts of the words and pairs of ``docs`` (text) in ``n`` shards, a written table;
    ``parts`` tasks gather them.

    Of each shard: tokens, distinct words, words seen once, and the number of words of each
    level; the words' numbers and exact counts; the filters of words and of pairs.  A
    shard without words or pairs has no row.
    """

    def counted(batches):
        held: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        size = 0

        def out():
            for pair, some in enumerate(held):
                keys, c = added_up(np.concatenate(some))
                some.clear()
                rows = [(p, pair == 1, keys[a:b].astype("<u8").tobytes(), c[a:b].astype("<u4").tobytes()) for p, a, b in by_shard(keys, n, parts)]
                for i in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + 4096], strict=True), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["part", "pair", "keys", "counts"])

        for b in slices(batches, 4096):
            for lot in lots(b.column(0).to_pylist()):
                held[0].append(lot.tokens)
                held[1].append(lot.pairs())
                size += len(lot.tokens)
                if size >= HELD:
                    yield from out()
                    size = 0
        if size:
            yield from out()

    def gathered(batches):
        held: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {False: [], True: []}
        size = {False: 0, True: 0}

        def add_up(pair):
            keys, c = added_up(np.concatenate([k for k, _ in held[pair]] or [np.zeros(0, np.uint64)]), np.concatenate([c for _, c in held[pair]] or [np.zeros(0, np.int64)]))
            held[pair], size[pair] = [(keys, c)], 0
            return keys, c

        for b in batches:
            for pair, keys, c in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                held[pair].append((np.frombuffer(keys.as_buffer(), "<u8").copy(), np.frombuffer(c.as_buffer(), "<u4").astype(np.int64)))
                size[pair] += len(held[pair][-1][0])
                if size[pair] >= GATHERED:
                    add_up(pair)
        every = [add_up(pair) for pair in (False, True)]
        held.clear()
        found = [{s: (first, last) for s, first, last in by_shard(keys, n)} for keys, _ in every]
        for s in sorted(found[0].keys() | found[1].keys()):
            (words, c), (pairs, of_pairs) = ([x[slice(*at.get(s, (0, 0)))] for x in both] for both, at in zip(every, found, strict=True))
            row = [s, int(c.sum()), len(c), int((c == 1).sum()), np.bincount(level(c), minlength=_LEVELS).tolist(), words.tobytes(), c.astype("<i8").tobytes(), fill(words, c, 2 * bits).tobytes(), fill(pairs, of_pairs, bits).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64()), *[pa.binary()] * 4), strict=True)], names=[x.split()[0] for x in _SHARDS.split(", ")])

    dealt = docs.select("text").mapInArrow(counted, "part int, pair boolean, keys binary, counts binary").repartitionById(parts, F.col("part"))
    return written(dealt.mapInArrow(gathered, _SHARDS), "counts", plain=True)


class Model:
    """Exact counts, and the filters of words and of pairs, in shards."""

    def __init__(self, docs: DataFrame, top: int = TOP, shard_text: int = SHARD_TEXT, bits: float = BITS):
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.n_shards = max(1, math.ceil(size / shard_text))
        # as many parts as cores, where the texts have so many shards
        self.parts = min(self.n_shards, max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(size / PART_TEXT)))
        self.shards = count(docs, self.n_shards, bits, self.parts)
        stats = self.shards.agg(F.sum("n"), F.sum("v"), F.sum("ones"), F.sum(F.octet_length("word_bits") + F.octet_length("pair_bits"))).first()
        self.n, self.v, ones, self.filter_bytes = (x or 0 for x in stats)
        self.unknown = (ones + 0.5) / (self.n + 1)
        #: 0.1 added to each count of the base model
        self.base_total = self.n + 0.1 * (self.v + 1)
        by_level = self.shards.select(F.posexplode("levels").alias("level", "n")).groupBy("level").agg(F.sum("n").alias("n")).where("n > 0").orderBy(F.desc("level")).collect()
        # The words of the highest levels, as many levels as hold at most ``top`` words.
        frequent, least = 0, None
        for r in by_level:
            frequent += r.n
            if frequent > top:
                break
            least = r.level
        rows = sorted((r.word & 0xFFFFFFFFFFFFFFFF, r.c) for r in self.words(least).collect()) if least else []
        self.top = np.array([w for w, _ in rows], np.uint64), np.array([c for _, c in rows], np.int64)

    def words(self, least: int = 1) -> DataFrame:
        """(word, c): the words of level ``least`` or more by number, with exact counts."""

        def run(batches):
            for b in batches:
                for words, counts in zip(b.column(0), b.column(1), strict=True):
                    w, c = np.frombuffer(words.as_buffer(), "<i8"), np.frombuffer(counts.as_buffer(), "<i8")
                    some = level(c) >= least
                    yield pa.RecordBatch.from_arrays([pa.array(w[some]), pa.array(c[some])], names=["word", "c"])

        return self.shards.select("words", "counts").mapInArrow(run, "word long, c long")

    def filter(self, bits: str) -> Filter:
        """The whole filter ``word_bits`` or ``pair_bits`` on the driver, gathered part by part."""
        sizes = np.ones(self.n_shards, np.int64)
        for r in self.shards.select("shard", (F.octet_length(bits) / 8).cast("int").alias("size")).collect():
            sizes[r.shard] = r.size
        out = Filter(np.zeros(int(sizes.sum()), "<u8"), sizes)
        for r in self.shards.select("shard", bits).toLocalIterator():
            out.data[out.starts[r.shard] : out.starts[r.shard] + sizes[r.shard]] = np.frombuffer(r[1], "<u8")
        return out


def log_chances(c: np.ndarray, before: np.ndarray, both: np.ndarray, n: int, unknown: float) -> np.ndarray:
    """The log10 probabilities of tokens with probed counts ``c`` after tokens with ``before``,
    where the pairs have ``both``."""
    p = np.where(c > 0, (1 - unknown) * c / max(n, 1), unknown)
    return np.log10((both + MU * p) / (np.maximum(before, both) + MU))


_RECORD = {"doc_id": pa.list_(pa.int64()), "held_out": pa.list_(pa.bool_()), "n_tokens": pa.binary(), "known": pa.binary(), "base": pa.binary(), "score": pa.binary(), "words": pa.binary(), "word_of": pa.binary(), "per_doc": pa.binary(), "pairs": pa.binary(), "pair_of": pa.binary()}
_RECORD_SCHEMA = "doc_id array<bigint>, held_out array<boolean>, " + ", ".join(f"{c} binary" for c in list(_RECORD)[2:])


class Record:
    """Texts whose lookups are dealt as one: what is known of them, and the numbers to look up."""

    def __init__(self):
        self.doc_id, self.held_out = [], []
        self.n_tokens, self.known, self.base, self.score, self.per_doc = ([] for _ in range(5))
        self.words, self.pairs, self.size = [], [], 0

    def add(self, lot: Lot, columns: pa.RecordBatch, known=None, base=None, score=None, words=None, per=None, pairs=None) -> None:
        """The pieces of ``lot``: texts of ``columns`` (doc_id, held_out); a piece whose text
        is here already adds to its values."""
        for at, k in enumerate(lot.of.tolist()):
            if k != self.last:
                self.last = k
                self.doc_id.append(columns.column(1)[k].as_py())
                self.held_out.append(columns.column(2)[k].as_py())
                for values in (self.n_tokens, self.known, self.base, self.score, self.per_doc):
                    values.append(0)
            for values, more in ((self.n_tokens, lot.lengths), (self.known, known), (self.base, base), (self.score, score), (self.per_doc, per)):
                if more is not None:
                    values[-1] += more[at].item()
        self.words.append(words)
        if pairs is not None:
            self.pairs.append(pairs)
        self.size += len(lot.tokens)

    last = None

    def out(self) -> pa.RecordBatch:
        packed = []
        for parts in (self.words, self.pairs):
            keys, of = np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_inverse=True)
            packed.append((keys.astype("<u8").tobytes(), of.astype("<u4").tobytes()))
        (words, word_of), (pairs, pair_of) = packed
        row = [self.doc_id, self.held_out, *(np.array(x, k).tobytes() for x, k in ((self.n_tokens, "<i8"), (self.known, "<i8"), (self.base, "<f8"), (self.score, "<f8"))), words, word_of, np.array(self.per_doc, "<i8").tobytes(), pairs, pair_of]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _RECORD.values(), strict=True)], names=list(_RECORD))


def looked_up(records: DataFrame, model: Model, dealt: bool) -> DataFrame:
    """(lot, pair, at, counts, levels) for the numbers of each record: the words' exact
    counts, and, where ``dealt``, the levels that words and pairs reach in the filters."""
    n, parts = model.n_shards, model.parts

    def probes(batches):
        rows = []

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()), strict=True)], names=["part", "lot", "pair", "at", "a"])
            rows.clear()
            return batch

        for b in batches:
            for i in range(b.num_rows):
                lot = b.column(0)[i].as_py()
                for pair in (False, True):
                    keys = np.frombuffer(b.column(1 + pair)[i].as_buffer(), "<u8")
                    for p, first, last in by_shard(keys, n, parts):
                        rows.append((p, lot, pair, first, keys[first:last].tobytes()))
                        if len(rows) >= 4096:
                            yield out()
        if rows:
            yield out()

    def answered(batches):
        now, shards, held = None, {}, None
        for b in batches:
            part, lot, pair, at = (b.column(i).to_pylist() for i in range(4))
            done, i = [], 0
            while i < b.num_rows:
                if part[i] != now:
                    now, shards, held = part[i], {}, None
                if lot[i] is None:  # a shard itself; a part's shards sort first
                    shards[at[i]] = [np.frombuffer(b.column(c)[i].as_buffer(), "<u8").copy() for c in range(4, 8)]
                    i += 1
                    continue
                if held is None:
                    held, shards = Part(now, n, parts, shards, dealt), {}
                first, size, keys = i, 0, []
                while i < b.num_rows and (part[i], pair[i]) == (now, pair[first]) and lot[i] is not None and size < ANSWERED:
                    keys.append(np.frombuffer(b.column(4)[i].as_buffer(), "<u8"))
                    size += len(keys[-1])
                    i += 1
                counts, levels = held.answers(np.concatenate(keys), pair[first])
                last = 0
                for k, x in zip(range(first, i), keys, strict=True):
                    here = slice(last, last := last + len(x))
                    done.append((lot[k], pair[k], at[k], counts[here].tobytes(), levels[here].tobytes()))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["lot", "pair", "at", "counts", "levels"])

    asked = records.select("lot", "words", "pairs").mapInArrow(probes, "part int, lot long, pair boolean, at long, a binary")
    none = F.lit(b"")
    bits = [F.col(c) if dealt else none for c in ("word_bits", "pair_bits")]
    part = F.expr(f"cast(shard * {parts}L div {n} as int)").alias("part")
    shards = model.shards.select(part, F.lit(None).cast("long").alias("lot"), F.lit(False).alias("pair"), F.col("shard").cast("long").alias("at"), F.col("words").alias("a"), F.col("counts").alias("b"), bits[0].alias("c"), bits[1].alias("d"))
    both = shards.unionByName(asked.withColumns({c: none for c in "bcd"}))
    return both.repartitionById(parts, F.col("part")).sortWithinPartitions("part", F.col("lot").isNotNull(), "pair").mapInArrow(answered, "lot long, pair boolean, at long, counts binary, levels binary")


def _probe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Levels in a shard's own bits."""
    return Filter(bits, np.array([len(bits)])).levels(keys)


class Part:
    """What numbers of a part are looked up in: its shards' words with their counts, and, where
    ``dealt``, their filters.  ``shards``: [words, counts, word_bits, pair_bits] by shard."""

    def __init__(self, part: int, n: int, parts: int, shards: dict[int, list[np.ndarray]], dealt: bool):
        first, after = (-(-p * n // parts) for p in (part, part + 1))
        none = np.zeros(0, "<u8")
        held = [shards.get(s, [none, none, none, none]) for s in range(first, after)]
        self.words, self.counts, *bits = (np.concatenate([x[i] for x in held]) for i in range(4))
        self.filters = []
        if dealt:
            for i in (2, 3):
                data = [x[i] if len(x[i]) else np.zeros(1, "<u8") for x in held]
                self.filters.append(Filter(np.concatenate(data), np.array([len(x) for x in data]), first, n))

    def answers(self, keys: np.ndarray, pair: bool) -> tuple[np.ndarray, np.ndarray]:
        """The words' exact counts (none for pairs), and the levels that ``keys`` reach."""
        counts = np.zeros(0 if pair else len(keys), "<i8")
        if not pair and len(self.words):
            where = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
            counts = np.where(self.words[where] == keys, self.counts[where], 0).astype("<i8")
        return counts, self.filters[pair].levels(keys) if self.filters else np.zeros(0, np.uint8)


def score(docs: DataFrame, model: Model, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``docs``' doc_id with held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    dealt = model.filter_bytes > filter_bytes
    n, unknown, base_total, top = model.n, model.unknown, model.base_total, model.top
    shared = spark.sparkContext.broadcast((*model.top, *((x.data, x.sizes) for x in (model.filter("word_bits"), model.filter("pair_bits"))))) if not dealt else None

    def first_pass(batches):
        filters = [Filter(*x) for x in shared.value[2:]] if shared else []
        top_words, top_counts = shared.value[:2] if shared else (None, None)
        start = count_of(filters[0].levels(np.array([END]))) if filters else None
        record = Record()
        each = 6 if filters else 24  # bytes of a record, some, for each token: all are in it where probes are dealt
        for b in slices(batches, 4096):
            record.last = None
            last = start  # the probed count of the token before the piece
            for lot in lots(b.column(0).to_pylist()):
                if record.size * each >= RECORD and record.last != lot.of[0]:
                    yield record.out()
                    record = Record()
                if not filters:
                    record.add(lot, b, words=lot.tokens, per=lot.lengths, pairs=lot.pairs())
                    continue
                hashes, ids = np.unique(lot.tokens, return_inverse=True)
                c = count_of(filters[0].levels(hashes))[ids]
                before = np.append(last, c[:-1])[: len(c)]
                before[lot.before == START] = start[0]
                if len(c):
                    last = c[-1:]
                both = count_of(filters[1].levels(lot.pairs()))
                exact = np.zeros(len(hashes), np.int64)
                if len(top_words):
                    at = np.minimum(np.searchsorted(top_words, hashes), len(top_words) - 1)
                    exact = np.where(top_words[at] == hashes, top_counts[at], 0)
                here = (exact > 0)[ids]
                base = np.where(here, np.log10((exact + 0.1) / base_total)[ids], 0)
                known = lot.sums(here).astype(np.int64)
                record.add(lot, b, known, lot.sums(base), lot.sums(log_chances(c, before, both, n, unknown)), lot.tokens[~here], lot.lengths - known)
        if record.size:
            yield record.out()

    plain = docs.select("text", "doc_id", held_out().alias("held_out"))
    records = written(plain.mapInArrow(first_pass, _RECORD_SCHEMA).withColumn("lot", F.monotonically_increasing_id()), "records", plain=True, large=True)
    answers = looked_up(records, model, dealt)
    # Some two records a task: what is sorted at once doesn't grow with the table.
    n_records = records.count()
    tasks = max(1, min(n_records, max(spark.sparkContext.defaultParallelism, math.ceil(n_records / 2))))

    def finished(batches):
        row, got = None, {}

        def out():
            doc_id, ids_out, n_tokens, known, base, scores, words, word_of, per_doc, pairs, pair_of = row
            n_tokens, known, per_doc = (np.frombuffer(x, "<i8") for x in (n_tokens, known, per_doc))
            base, scores, word_of, pair_of = np.frombuffer(base, "<f8"), np.frombuffer(scores, "<f8"), np.frombuffer(word_of, "<u4"), np.frombuffer(pair_of, "<u4")
            counts = np.frombuffer(b"".join(got[False][0]), "<i8")
            doc = np.repeat(np.arange(len(n_tokens)), per_doc)
            logs = np.log10((counts + 0.1) / base_total)
            base = base + np.bincount(doc, logs[word_of], len(n_tokens))
            known = known + np.bincount(doc, (counts > 0)[word_of], len(n_tokens)).astype(np.int64)
            if dealt:
                c = count_of(np.frombuffer(b"".join(got[False][1]), np.uint8))[word_of]
                both = count_of(np.frombuffer(b"".join(got[True][1]), np.uint8))[pair_of]
                before = np.append(0.0, c[:-1])
                ends = np.cumsum(n_tokens) - 1  # a text's start has the count of its end
                before[ends - n_tokens + 1] = c[ends]
                scores = scores + np.bincount(doc, log_chances(c, before, both, n, unknown), len(n_tokens))
            return pa.RecordBatch.from_arrays([pa.array(doc_id, pa.int64()), pa.array(ids_out, pa.bool_()), pa.array(n_tokens), pa.array(known), pa.array(base), pa.array(scores)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

        for b in batches:
            at = {c: i for i, c in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                if b.column(at["tag"])[i].as_py() == 0:
                    if row is not None:
                        yield out()
                    row, got = [b.column(at[c])[i].as_py() for c in _RECORD], {False: ([], []), True: ([], [])}
                else:
                    mine = got[b.column(at["pair"])[i].as_py()]
                    mine[0].append(b.column(at["counts"])[i].as_py())
                    mine[1].append(b.column(at["levels"])[i].as_py())
        if row is not None:
            yield out()

    # A record comes before its answers, which come in order.
    both = records.withColumn("tag", F.lit(0)).unionByName(answers.withColumn("tag", F.lit(1)), allowMissingColumns=True)
    done = both.repartition(tasks, "lot").sortWithinPartitions("lot", "tag", "pair", "at").mapInArrow(finished, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, Model(docs.where(~held_out())))
