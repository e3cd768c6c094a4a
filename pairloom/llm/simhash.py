"""SimHash near-duplicates by pigeonhole blocks.

A document's fingerprint has a bit set where over half of its shingles' 64-bit hashes
have it.  Fingerprints at Hamming distance 3 or less link, and documents in one linked
component are near copies.

Finding the links, for N distinct fingerprints (copies of a text share one):

1. The 64 bits are cut into six blocks.  Two fingerprints that differ in at most three
   bits agree in three whole blocks, so each fingerprint is keyed by the 20 choices of
   three blocks, and close pairs meet under a key of some 32 bits.
2. Each key's fingerprints, streamed in order, are verified by XOR and bit count; only
   a spanning forest of the group's links is emitted, never all pairs.
3. A key with more than ``GROUP`` fingerprints is passed on unread; those that a sample
   of the fingerprints shows to be so aren't even gathered.  Their fingerprints are keyed again by every choice of 13 of 16 four-bit blocks; at most
   2**12 = ``GROUP`` distinct fingerprints can share such a key, so this is exact and
   bounded.
4. Components come from alternating large-star and small-star steps on tables; nothing
   that grows is sent to the driver.

``dedup_stage`` also links texts whose sets of ``WORDS``-word shingles have a Jaccard similarity
of ``NEAR`` or more, which 3 bits mostly miss.  ``near_texts`` finds candidates by bands of least
hashes, beside the pigeonhole blocks, and verifies each on the whole sets.  Rows that share a
band are paired with the first and the few before them, so candidates grow with the
rows, not with the square of a group; a band's group is dealt to parts and only the parts'
first rows meet.  This links most of a group.  ``rest`` goes on with the bands that have rows which were not paired and
are not of one component yet: of their rows, it finds all pairs of different components, as ``similar`` does.  ``similar`` finds all
similar texts:

1. Shingles are put in one order for all texts.  Of two such sets of sizes m and n, each
   has a common shingle among its first size - ceil(NEAR size) + 1 (prefix filter).
2. Texts meet under these shingles; pairs whose sizes or places rule it out are dropped, and those of one component.  A shingle
   of over ``CELL`` texts is dealt to cells of two lots of them.
3. The rest are verified on the whole sets.
The order is by hash, with shingles that are frequent in a bounded sample of texts last.
The sample only saves work: any order finds the same links.

Edge cases: a null or blank text has fingerprint zero, which links like any other;
repeated rows share a component; a null doc_id keeps its row and is ignored as the
smallest id unless all are null; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, maybe_broadcast, slices, written

DISTANCE = 3
SHINGLE = 3
SEED = 42
#: Fingerprints that one key's group may hold in memory: 2 ** 12, see step 3.
GROUP = 4096
#: One fingerprint in so many tells which keys are crowded.
CROWD = 64
#: Bits of the six blocks.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: The stage's shingles, and the similarity that it links, as a fraction.
WORDS = 5
NEAR = (4, 5)
#: Expected texts of the sample that tells frequent shingles: those of over ``HOT`` texts,
#: and of over ``HOT_SAMPLED`` in the sample; at most ``HOTTEST`` of them are put last.
SAMPLE = 50_000
HOT = 50
HOT_SAMPLED = 8
HOTTEST = 1_000_000


def shingle_hashes(text: str | None, k: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each k-word shingle of the text, A-Z in lower case, in order, with repeats."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(line, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[s:e], seed) for s, e in zip(starts, ends[k - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint; 0 without words."""
    h = shingle_hashes(text, k, seed)
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[i : i + (1 << 16)], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << b for b in np.flatnonzero(2 * counts > len(h)).tolist())


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with a long column ``out``: the fingerprint's bits as a signed number."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    at = docs.columns.index(text)

    def run(batches):
        for b in slices(batches):
            fps = [fingerprint(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def _masks() -> list[int]:
    """For each choice of three blocks, the mask of their bits."""
    starts = np.cumsum((0, *BLOCKS[:-1])).tolist()
    block = [((1 << n) - 1) << s for s, n in zip(starts, BLOCKS, strict=True)]
    return [sum(block[i] for i in c) for c in combinations(range(len(BLOCKS)), len(BLOCKS) - DISTANCE)]


def _fine_masks() -> list[int]:
    """For each choice of 13 of 16 four-bit blocks, the mask of their bits."""
    return [~sum(0xF << (4 * i) for i in c) & ((1 << 64) - 1) for c in combinations(range(16), DISTANCE)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _forest(group: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Links (member, root) that connect what is connected in ``group``, sorted numbers."""
    left, members, roots = group, [], []
    while len(left):
        root, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= distance
            if near.any():
                found = left[near]
                members += found.tolist()
                roots += [int(root)] * len(found)
                front += list(found)
                left = left[~near]
    return members, roots


def _links(keyed: DataFrame, limit: int | None) -> DataFrame:
    """Rows (a, b, over): forest links of each key's group; where a group has over
    ``limit`` members, its members instead as (fp, fp, true).

    ``keyed`` has (k, m, fp): key number, masked bits and fingerprint.
    """

    def out(a, b, flag):
        return pa.RecordBatch.from_arrays([*(pa.array(np.asarray(x, np.uint64).view(np.int64)) for x in (a, b)), pa.array(np.full(len(a), flag))], names=["a", "b", "over"])

    def run(batches):
        last, size, open_group = None, 0, []  # the key that may go on: its members so far
        a, b = [], []

        def close():
            if 1 < size <= (limit or size):
                x, y = _forest(np.concatenate(open_group), DISTANCE)
                a.extend(x)
                b.extend(y)

        for batch in batches:
            k, m, fp = (batch.column(c).to_numpy() for c in ("k", "m", "fp"))
            if not len(k):
                continue
            fp = fp.view(np.uint64)
            starts = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (m[1:] != m[:-1])))
            ends = np.append(starts[1:], len(k))
            for i in np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(k))).tolist():  # single members link to none
                s, e = int(starts[i]), int(ends[i])
                if (k[s], m[s]) != last:
                    close()
                    last, size, open_group = (k[s], m[s]), 0, []
                size += e - s
                if limit is None or size <= limit:
                    open_group.append(fp[s:e].copy())
                else:  # passed on unread
                    for part in (*open_group, fp[s:e]):
                        yield out(part, part, True)
                    open_group = []
            if len(a) > 10_000:
                yield out(a, b, False)
                a, b = [], []
        close()
        if a:
            yield out(a, b, False)

    dealt = keyed.repartition("k", "m").sortWithinPartitions("k", "m", "fp")
    return dealt.mapInArrow(run, "a long, b long, over boolean")


def _keyed(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("m")) for i, m in enumerate(masks))))
    return fps.select("fp", keys.alias("x")).select("x.k", "x.m", "fp")


def link_forest(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b): links whose components are those of all pairs of distinct ``fps`` (column
    fp) within the distance; a and b differ."""
    keyed = _keyed(fps, _masks())
    # Keys that a sample shows to be crowded aren't gathered; any others are, up to the limit.
    some = _keyed(fps.where(F.pmod(F.xxhash64("fp"), F.lit(CROWD)) == 0), _masks())
    crowded = written(some.groupBy("k", "m").count().where(F.col("count") > group // CROWD).select("k", "m"), "crowded", plain=True)
    over = fps.limit(0)
    if not crowded.isEmpty():
        crowded = maybe_broadcast(crowded)
        over = written(keyed.join(crowded, ["k", "m"], "left_semi").select("fp").distinct(), "crowd", plain=True)
        keyed = keyed.join(crowded, ["k", "m"], "left_anti")
    first = written(_links(keyed, group), "links", plain=True)
    links = first.where(~F.col("over")).select("a", "b")
    over = over.union(first.where("over").select("a")).distinct()
    if not over.isEmpty():
        fine = _links(_keyed(over, _fine_masks()), None)
        links = links.union(fine.select("a", "b"))
    return links.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) for each node a that isn't the smallest of its component, b.

    Alternating large-star and small-star steps until nothing changes; each round is a
    written table.
    """

    def stamp(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1)))).first()

    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", plain=True)
    before = stamp(e)
    while before[0]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        star = large.join(lower, large.a == lower.u).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct()
        e = written(star, "star", plain=True)
        after = stamp(e)
        if after == before:
            break
        before = after
    return e


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct ``WORDS``-word shingles of a text, by hash."""
    return np.unique(shingle_hashes(text, WORDS))


def _hot(texts: DataFrame) -> np.ndarray:
    """Shingles that are frequent in a sample of ``texts`` (text, row), by hash."""
    total = texts.count()
    share = min(1.0, SAMPLE / max(total, 1))
    drawn = texts.where(F.pmod(F.xxhash64(F.lit(SEED), "row"), F.lit(1 << 30)) < share * (1 << 30))

    def run(batches):
        for b in slices(batches):
            sets = [shingle_set(t) for t in b.column(0).to_pylist()]
            key, c = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c, pa.int64())], names=["key", "c"])

    counts = drawn.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    rows = counts.where(F.col("c") > max(HOT * share, HOT_SAMPLED)).orderBy(F.desc("c"), "key").limit(HOTTEST).collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


#: Rows of a shingle that meet in one task; more are cut into lots, each two of which are a cell.
CELL = 8192


def _meeting(keyed: DataFrame, cell: int | None = None) -> DataFrame:
    """(a, b), a < b: rows of ``keyed`` (key, n, at, row, root) that meet under a key, whose roots differ and whose
    sizes and places allow the similarity; some twice."""
    p, q = NEAR
    cell = cell or CELL

    def run(batches):
        held = None
        for b in batches:
            part = [c.to_numpy() for c in b.columns]
            if not len(part[0]):
                continue
            if held is not None:
                part = [np.append(h, c) for h, c in zip(held, part, strict=True)]
            # The last group may go on in the next batch.
            new = np.flatnonzero(np.append(True, (part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])))
            held = [c[new[-1] :] for c in part]
            for s, e in zip(new[:-1].tolist(), new[1:].tolist(), strict=True):
                yield from pairs(*(c[s:e] for c in part[2:]))
        if held is not None:
            yield from pairs(*held[2:])

    def pairs(root, n, at, row):
        # Roots rise; each row meets those of the roots behind its own, the rows of the largest root none.
        _, of, size = np.unique(root, return_inverse=True, return_counts=True)
        order = np.lexsort((of, size[of]))
        of, n, at, row = of[order], n[order], at[order], row[order]
        ends = np.append(np.flatnonzero(of[1:] != of[:-1]) + 1, len(of))
        place = np.searchsorted(ends, np.arange(ends[-2] if len(ends) > 1 else 0), "right")
        found, total = [], 0
        for i, end in enumerate(ends[place].tolist()):
            m, most = n[end:], np.minimum(n[i] - at[i], n[end:] - at[end:])  # common from here on
            fine = (q * np.minimum(m, n[i]) >= p * np.maximum(m, n[i])) & ((p + q) * most >= p * (n[i] + m))
            other = row[end:][fine]
            if len(other):
                found.append((np.minimum(other, row[i]), np.maximum(other, row[i])))
                total += len(other)
            if total > 100_000:
                yield out(found)
                found, total = [], 0
        if found:
            yield out(found)

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["a", "b"])

    counts = keyed.groupBy("key").agg(F.count("*").alias("c"), (F.min("root") != F.max("root")).alias("differ")).where("differ").select(F.col("key").alias("of"), "c")
    due = keyed.join(counts, F.col("key") == F.col("of")).withColumn("lots", F.ceil(F.col("c") / cell).cast("int"))
    lot = F.pmod(F.xxhash64("row", F.lit(SEED)), F.col("lots")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("lots") - 1), lambda j: F.least(lot, j) * F.col("lots") + F.greatest(lot, j))
    dealt = due.select("key", F.explode(cells).alias("cell"), "root", "n", "at", "row").repartition("key", "cell").sortWithinPartitions("key", "cell", "root")
    return dealt.mapInArrow(run, "a long, b long")


def _unrepeated(texts: DataFrame) -> DataFrame:
    """One row of each text: equal texts have one fingerprint."""
    slim = texts.select("row", "fp", F.xxhash64("text").alias("same"))
    firsts = slim.groupBy("fp", "same").agg(F.min("row").alias("first"))
    repeats = written(slim.join(firsts, ["fp", "same"]).where(F.col("row") > F.col("first")).select(F.col("row").alias("again")), "repeats", plain=True)
    return texts.join(maybe_broadcast(repeats), F.col("row") == F.col("again"), "left_anti")


def similar(texts: DataFrame) -> DataFrame:
    """(a, b): the fingerprints of all pairs of ``texts`` (text, row, fp; row is unique)
    whose shingle sets have a similarity of ``NEAR`` or more, where they differ."""
    return _similar(_unrepeated(texts).select("text", "row", "fp", F.col("fp").alias("root")))


def _similar(texts: DataFrame) -> DataFrame:
    """(a, b): the fingerprints of all similar pairs of ``texts`` (text, row, fp, root) whose roots differ."""
    p, q = NEAR
    hot = texts.sparkSession.sparkContext.broadcast(_hot(texts))

    def prefixes(batches):
        last = hot.value
        for b in slices(batches):
            parts = []
            for t, row, root in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                h = shingle_set(t)
                if not len(h):
                    continue
                if len(last):
                    late = last[np.minimum(np.searchsorted(last, h), len(last) - 1)] == h
                    h = np.concatenate([h[~late], h[late]])
                n = len(h)
                k = n - (p * n + q - 1) // q + 1
                parts.append((h[:k], np.full(k, n), np.arange(k), np.full(k, row), np.full(k, root)))
            if parts:
                key, *more = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(pa.array(x, pa.int64()) for x in more)], names=["key", "n", "at", "row", "root"])

    keyed = written(texts.select("text", "row", "root").mapInArrow(prefixes, "key long, n long, at long, row long, root long"), "prefixes", plain=True)
    met = written(_meeting(keyed).distinct(), "met", plain=True)
    return _verified(texts, met)


#: Bands of the stage's candidates, and least hashes in each: of pairs at a similarity of 0.8
#: all but (1 - 0.8 ** 5) ** 24, one in 14,000, agree in a band; of those at 0.9 all but one in 10 ** 9.
BANDS, LEAST = 24, 5
#: Parts into which a band's group is dealt, and earlier rows that each row is paired with.
PARTS, BACK = 64, 8


@cache
def _multipliers() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 32, BANDS * LEAST, np.uint32) | np.uint32(1)


def _least(shingles: np.ndarray) -> np.ndarray:
    """The least of the shingles' hashes by each of the multiplicative hash functions."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    return np.array([(high * m).min() for m in _multipliers()], np.uint32)


def _banded(texts: DataFrame) -> DataFrame:
    """key, n, row, fp: a row for each band of each of ``texts`` (text, row, fp); the key is that of the
    band and of its least hashes of the text's shingles, n their number."""

    def run(batches):
        for b in slices(batches):
            keys, sizes, at = [], [], []
            for i, t in enumerate(b.column(0).to_pylist()):
                h = shingle_set(t)
                if len(h):
                    least = _least(h).tobytes()
                    keys += [xxhash.xxh64_intdigest(least[4 * LEAST * k : 4 * LEAST * (k + 1)], k) for k in range(BANDS)]
                    sizes.append(len(h))
                    at.append(i)
            each = pa.array(np.repeat(np.array(at, np.int64), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(np.repeat(np.array(sizes, np.int64), BANDS)), b.column(1).take(each), b.column(2).take(each)], names=["key", "n", "row", "fp"])

    return texts.select("text", "row", "fp").mapInArrow(run, "key long, n long, row long, fp long")


def _neighbours(rows: DataFrame, *by: str) -> DataFrame:
    """Of rows that agree in ``by`` (the columns of a key), in order: each with the first and the
    ``BACK`` before it, (a, b, fp_a, fp_b) where a link isn't ruled out by size or known by
    fingerprint, of kind 0; and the first of each key, as (a, its n as b, fp, 0), of kind 1, the second, of kind 2, and the first
    that isn't paired with all before it, of kind 3."""
    p, q = NEAR

    def run(batches):
        held, gone = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, n, row, fp = (batch.column(i).to_numpy() for i in range(4))
            part = batch.column(4).to_numpy() if batch.num_columns > 4 else np.zeros(len(key), np.int64)
            cols, fresh = [key, part, n, row, fp], 0
            if held is not None:
                fresh = len(held[0])
                cols = [np.append(h, c) for h, c in zip(held, cols, strict=True)]
            key, part, n, row, fp = cols
            new = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1]))
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            firsts = np.flatnonzero(new[fresh:]) + fresh
            out = [(row[firsts], n[firsts], fp[firsts], np.zeros(len(firsts), np.int64), np.ones(len(firsts), np.int8), key[firsts])]
            i = np.arange(fresh, len(key))
            since = i - first[fresh:] + np.where(first[fresh:] == 0, gone, 0)  # earlier rows of the key, those not held any more too
            for kind, place in ((2, 1), (3, BACK + 2)):
                x = i[since == place]
                out.append((row[x], n[x], fp[x], np.zeros(len(x), np.int64), np.full(len(x), kind, np.int8), key[x]))
            for back in range(BACK + 1):
                j = first[i] if not back else i - back
                good = (j >= first[i]) & (j < i)
                x, y = j[good], i[good]
                low, high = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                apart = np.bitwise_count(fp[x].view(np.uint64) ^ fp[y].view(np.uint64)) > DISTANCE
                fine = apart & (q * low >= p * high) & (row[x] != row[y])
                x, y = x[fine], y[fine]
                x, y = np.where(row[x] < row[y], x, y), np.where(row[x] < row[y], y, x)
                out.append((row[x], row[y], fp[x], fp[y], np.zeros(len(x), np.int8), key[x]))
            a, b, fa, fb, kind, k = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, fa, fb, kind, k)], names=["a", "b", "fp_a", "fp_b", "kind", "key"])
            # The last key may go on: its first row and its last rows are kept.
            begin = int(first[-1])
            keep = np.unique(np.append(begin, np.arange(max(begin, len(key) - BACK), len(key))))
            held = [c[keep] for c in cols]
            gone = len(key) - begin - len(keep) + (gone if begin == 0 else 0)

    dealt = rows.repartition(*by).sortWithinPartitions(*by, "row")
    columns = ["key", "n", "row", "fp", *(c for c in by if c != "key")]
    return dealt.select(*columns).mapInArrow(run, "a long, b long, fp_a long, fp_b long, kind tinyint, key long")


def near_texts(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b): fingerprints of ``texts`` (text, row, fp; row is unique) that link because their shingle
    sets have a similarity of ``NEAR`` or more; of candidates by bands, each verified on the whole sets.
    And (key, row, fp): the rows of the bands in which some were not paired, for ``rest``.

    A band's group, of any size, is dealt to ``PARTS`` parts; then the parts' first rows meet.
    """
    texts = _unrepeated(texts)
    bands = written(_banded(texts), "bands", plain=True)
    parts = bands.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(PARTS)))
    inner = written(_neighbours(parts, "key", "part"), "neighbours", plain=True)
    leads = inner.where("kind = 1").select("key", F.col("b").alias("n"), F.col("a").alias("row"), F.col("fp_a").alias("fp"))
    outer = written(_neighbours(leads, "key").where("kind in (0, 3)"), "leads", plain=True)
    pairs = inner.union(outer).where("kind = 0").select("a", "b").distinct()
    pairs = written(pairs, "candidates", plain=True)
    # Not all met: in a part, or of the parts' first rows, or some beside the first of a part in a group of several.
    left = inner.union(outer).where("kind = 3").select("key").union(inner.where("kind = 2").select("key").distinct().join(leads.groupBy("key").count().where("count > 1"), "key", "left_semi"))
    left = written(left.distinct(), "left", plain=True)
    return _verified(texts, pairs), bands.join(maybe_broadcast(left), "key", "left_semi").select("key", "row", "fp")


def rest(texts: DataFrame, crowd: DataFrame, rooted: DataFrame) -> DataFrame:
    """(a, b): the links of different components in ``crowd`` (key, row, fp), whose components ``rooted`` (fp, root) tells: of the
    rows of keys that have rows of several, all pairs, exactly."""
    known = rooted.select(F.col("fp").alias("of"), "root")
    crowd = written(crowd.join(known, F.col("fp") == F.col("of")).select("key", "row", "root"), "crowd-rows", plain=True)
    apart = crowd.groupBy("key").agg((F.min("root") != F.max("root")).alias("differ")).where("differ").select("key")
    due = written(crowd.join(apart, "key", "left_semi").select(F.col("row").alias("due"), "root").distinct(), "due", plain=True)
    return _similar(written(texts.join(due, F.col("row") == F.col("due")).select("text", "row", "fp", "root"), "due-texts"))


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): the fingerprints of those ``pairs`` (rows a, b) of ``texts`` whose whole shingle sets are similar."""
    p, q = NEAR
    of = written(pairs.select(F.explode(F.array("a", "b")).alias("of")).distinct(), "candidate-rows", plain=True)
    some = written(texts.join(maybe_broadcast(of), F.col("row") == F.col("of"), "left_semi").select("text", "row", "fp"), "candidate-texts")

    def verify(batches):
        last, known = None, None
        for b in slices(batches):
            keep = []
            for a, x, y in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if a != last:
                    last, known = a, shingle_set(x.as_py())
                other = shingle_set(y.as_py())
                common = len(np.intersect1d(known, other, assume_unique=True))
                keep.append((p + q) * common >= p * (len(known) + len(other)))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(3).filter(kept), b.column(4).filter(kept)], names=["a", "b"])

    one, two = (some.select(*(F.col(c).alias(f"{c}_{x}") for c in some.columns)) for x in "ab")
    both = pairs.join(one, pairs.a == F.col("row_a")).join(two, pairs.b == F.col("row_b"))
    linked = both.select("row_a", "text_a", "text_b", "fp_a", "fp_b").mapInArrow(verify, "a long, b long")
    return written(linked.where("a <> b"), "similar", plain=True)


def near_duplicates(marked: DataFrame, more: DataFrame | None = None, still: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(fp, component_id) for each distinct fingerprint of ``marked`` (doc_id, fp).

    ``more``: links (a, b) of fingerprints besides those of their distance; ``still``: gives those that
    are left from (fp, root), the components by all others.
    """
    fps = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints", plain=True)
    links = link_forest(fps.select("fp"))
    to = components(links if more is None else links.union(more))
    root = lambda to: written(fps.join(to, fps.fp == to.a, "left").select("fp", "least", F.coalesce("b", "fp").alias("root")), "rooted", plain=True)
    rooted = root(to)
    if still is not None:
        last = still(rooted.select("fp", "root"))
        if not last.isEmpty():
            rooted = root(components(to.union(last)))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "components", plain=True)


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marked = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "marked", plain=True)
    found = near_duplicates(marked).withColumnRenamed("fp", "of")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(found, marked.fp == found.of).select("doc_id", hexed.alias("fingerprint"), "component_id")


def dedup_stage(docs: DataFrame, link: str = "bands") -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's, and of repeated
    rows one.  All columns stay as they are.

    Near fingerprints link, and texts whose five-word shingles are similar, which
    fingerprints mostly miss: by ``near_texts`` (``bands``), by ``similar`` (``all``, which misses
    none, for several times the input in shuffles), or not (``fingerprints``).
    """
    columns = docs.columns
    at, text = "__pl_row", columns[[c.lower() for c in columns].index("text")]
    fp = with_fingerprint(docs, text, "__pl_fp").withColumn(at, F.monotonically_increasing_id())
    kept = written(fp, "fingerprinted")
    slim = kept.select("doc_id", F.col("__pl_fp").alias("fp"), F.col(at).alias("row"))
    texts, alike, still = kept.select(F.col(text).alias("text"), F.col(at).alias("row"), F.col("__pl_fp").alias("fp")), None, None
    if link == "bands":
        alike, crowd = near_texts(texts)
        still = lambda rooted: rest(texts, crowd, rooted)
    elif link == "all":
        alike = similar(texts)
    elif link != "fingerprints":
        raise ValueError(link)
    found = near_duplicates(slim.select("doc_id", "fp"), alike, still).withColumnRenamed("fp", "of")
    first = slim.join(found, slim.fp == found.of).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("x"))
    keep = written(first.select(F.col("x.row").alias("__pl_keep")), "keep", plain=True)
    return kept.join(keep, kept[at] == keep["__pl_keep"], "left_semi").select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(documents(spark, sf_dir))
