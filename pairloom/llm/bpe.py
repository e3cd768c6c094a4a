"""Byte-level BPE encoding and decoding by recursive queries.

Each partition's worker holds an in-memory DuckDB with the vocabulary and its merge
table: every token of two bytes or more, cut at each place into two tokens, gives a row
(left, right, rank).  A text is matched by the split pattern; each distinct piece that
isn't itself a token becomes token-position rows, and a recursive query contracts each
piece's leftmost pair of least rank until none is left.  Decoding joins (document,
position, id) rows with the vocabulary and aggregates the bytes in order.

Long pieces (``LONG`` bytes or more) are first cut where no token of the vocabulary that
occurs in the piece crosses: no merge crosses there either, so the parts merge apart.  A
part that is still long contracts many pairs a step: each whose rank is the least within
reach, which is twice the longest token that occurs, to both sides.  A merge that could
take one of such a pair's tokens first would need a pair of lower rank within reach, so
the result is that of one pair at a time.  Of a run of overlapping pairs of one rank every
second contracts, from the run's start.  The merge table marks tokens of which a merge
ranks below their own (``alone``); of those only the leftmost within three times the
longest token contracts.  The recursion is keyed by place, so it holds the last state
only; parts beyond ``BLOCK`` bytes are taken in blocks whose ends stay as they are, again
and again with other ends, until no pair is left.

Memory is bounded: pieces go to DuckDB in lots, pieces and ids are held in lots of
``IDS``, the worker knows at most two generations of ``KNOWN`` pieces of less than ``LONG``
bytes, and DuckDB doesn't spill: what exceeds its ``MEMORY`` is an error.

Edge cases: a null or empty text has no tokens; repeated rows and ties have equal
results; no rows give no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice
from pathlib import Path

import ahocorasick
import duckdb
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from .common import documents, slices

#: Bytes from which a piece counts as long (a short one's places fit six bits).
LONG = 64
#: Rows of all steps together that a query of short pieces may make (half a piece's length
#: squared, at most), and bytes of long ones in one query.
ROWS = 4 << 20
LOT = 1 << 19
#: Bytes of a long part that are taken at once.
BLOCK = 1 << 18
MEMORY = "512MB"
#: Pieces, or ids, held at once.
IDS = 1 << 19
#: Entries of each of the two generations of known pieces.
KNOWN = 500_000

#: Contract the leftmost pair of least rank of each piece that has one.  A token's key is
#: its piece's number and its first byte's place (under 64), n its length in bytes; the
#: least of (rank, place, left length, right length), packed in one number, is the pair.
_ONE = """
WITH RECURSIVE step(w, i, k, n, tok) AS (
    SELECT w, 0::TINYINT, (w::BIGINT << 6) + pos, 1, tok FROM start
    UNION ALL
    SELECT p.w, (p.i + 1)::TINYINT, p.k, CASE WHEN p.k = b.at THEN b.n ELSE p.n END, CASE WHEN p.k = b.at THEN b.r ELSE p.tok END
    FROM step p
    JOIN (
        SELECT w, v >> 18 AS r, (w::BIGINT << 6) + ((v >> 12) & 63) AS at, (w::BIGINT << 6) + ((v >> 12) & 63) + ((v >> 6) & 63) AS gone, ((v >> 6) & 63) + (v & 63) AS n
        FROM (
            SELECT p.w, min((m.r::BIGINT << 18) | ((p.k & 63) << 12) | (p.n << 6) | q.n) AS v
            FROM step p
            JOIN step q ON q.k = p.k + p.n
            JOIN merges m ON m.ab = ((p.tok::BIGINT << 20) | q.tok)
            WHERE q.w = p.w
            GROUP BY p.w
        )
    ) b ON b.w = p.w
    WHERE p.k <> b.gone
)
SELECT w, list(tok ORDER BY k) AS ids
FROM (SELECT s.w, s.tok, s.k FROM step s JOIN (SELECT w, max(i) AS last FROM step GROUP BY w) l ON l.w = s.w AND l.last = s.i)
GROUP BY w
"""

#: Contract, in each step, the pairs of a part that rank least within reach.  ``low`` and
#: ``high`` are the first and last places at which a part's pairs may contract.
_MANY = """
WITH RECURSIVE step(w, pos, tok) USING KEY (w, pos) AS (
    SELECT w, pos, tok FROM start
    UNION ALL
    SELECT w, pos, CASE WHEN gone THEN -1 WHEN hit THEN r ELSE tok END
    FROM (
        SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY pos), false) AS gone, bool_or(hit) OVER (PARTITION BY w) AS going
        FROM (
            SELECT *, coalesce(bool_and(fits) OVER (PARTITION BY w, run ORDER BY pos) AND (CASE WHEN alone THEN first OR (calm AND (n - run) % 2 = 0) ELSE (n - run) % 2 = 0 END), false) AS hit
            FROM (
                SELECT w, pos, tok, r, alone, n, max(CASE WHEN begins THEN n END) OVER (PARTITION BY w ORDER BY pos) AS run,
                    coalesce(r = min(r) OVER (PARTITION BY w ORDER BY pos RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING) AND pos BETWEEN low AND high, false) AS fits,
                    {first} AS first, {calm} AS calm
                FROM (
                    SELECT w, pos, tok, m.r, alone, n, low, high, m.r IS DISTINCT FROM lag(m.r) OVER (PARTITION BY w ORDER BY pos) AS begins, {wild} AS wild
                    FROM (
                        SELECT w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nexttok, row_number() OVER (PARTITION BY w ORDER BY pos) AS n,
                            lag(tok) OVER (PARTITION BY w ORDER BY pos) AS before, lead(tok, 2) OVER (PARTITION BY w ORDER BY pos) AS behind
                        FROM step
                        WHERE tok >= 0
                    ) q
                    LEFT JOIN merges m ON m.ab = ((q.tok::BIGINT << 20) | q.nexttok)
                    {falls}
                    JOIN bounds USING (w)
                )
            )
        )
    )
    WHERE going
)
SELECT w, pos, tok FROM step WHERE tok >= 0 ORDER BY w, pos
"""
_FIRST = "(r::BIGINT << 40 | pos) = min(r::BIGINT << 40 | pos) OVER (PARTITION BY w ORDER BY pos RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING)"
#: A pair is wild if its token would make, with a neighbour as it is or contracted likewise, a
#: pair of lower rank, which would come before the next of its own rank.  Pairs that
#: are not, and have no wild one of their rank before them within reach, contract together.
_FALLS = """LEFT JOIN falls f ON alone AND f.ab = ((q.before::BIGINT << 20) | m.r) AND f.r < m.r
                    LEFT JOIN falls g ON alone AND g.ab = ((m.r::BIGINT << 20) | q.behind) AND g.r < m.r"""
_WILD = "alone AND (twin OR f.r IS NOT NULL OR g.r IS NOT NULL)"
_CALM = """(NOT wild AND r = min(r) OVER (PARTITION BY w ORDER BY pos RANGE BETWEEN {reach} PRECEDING AND {reach} FOLLOWING)
                        AND coalesce(min(CASE WHEN wild THEN r END) OVER (PARTITION BY w ORDER BY pos RANGE BETWEEN {reach} PRECEDING AND CURRENT ROW) > r, true))"""

_DECODE = """
SELECT d, string_agg(v.hex, '' ORDER BY pos) AS hex FROM ids JOIN vocab v ON v.id = ids.id GROUP BY d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a rank file: a base64 token and its rank on each line."""
    lines = Path(path).read_bytes().split(b"\n")
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _as_tiktoken(pattern: str):
    """A pattern of the characters that this interpreter's Unicode tables class as letters
    or numbers but tiktoken's don't, or the reverse, and ``pattern`` with tiktoken's classes.

    (None, None) where there are none.  tiktoken tells its classes when it is given one as
    its split pattern: it keeps the characters that match.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    odd, exact = set(), pattern
    for name in (r"\p{L}", r"\p{N}"):
        if name not in pattern:
            continue
        theirs = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={})
        found = set(bytes(theirs.encode_ordinary(every)).decode())
        here = set(regex.findall(name, every))
        less, more = (_class(x) for x in (here - found, found - here))
        odd |= here ^ found
        if less:
            exact = exact.replace(name, f"[{name}--[{less}]]")
        if more:
            exact = exact.replace(name, f"[{name}||[{more}]]")
    return (regex.compile(f"[{_class(odd)}]"), regex.compile(f"(?V1){exact}")) if odd else (None, None)


def _latin(text: str) -> bool:
    """Whether all characters are under 256, where all tables agree."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _class(chars: set[str]) -> str:
    """The characters as ranges of a regular expression's set."""
    out, points = [], sorted(map(ord, chars))
    for p in points:
        if out and out[-1][1] == p - 1:
            out[-1][1] = p
        else:
            out.append([p, p])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


class Codec:
    """Encodes and decodes with one vocabulary, by queries of one DuckDB."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.fast = regex.compile(pattern)
        self.odd, self.exact = _as_tiktoken(pattern)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} of the 256 bytes")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        rows = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, r = (np.array(x, np.int32) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int32),) * 3
        alone = np.isin(r, np.concatenate([a[a > r], b[b > r]]))
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "preserve_insertion_order": False, "temp_directory": ""})
        self.alone = bool(alone.any())
        self.occurring: ahocorasick.Automaton | None = None
        merges = pa.table({"ab": (a.astype(np.int64) << 20) | b, "r": r, "alone": alone, "twin": np.isin(r, a[(a == b) & (a > r)])})  # noqa: F841  read by name
        vocab = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])})  # noqa: F841
        self.db.execute("CREATE TABLE merges AS SELECT * FROM merges ORDER BY ab")
        self.db.execute("CREATE TABLE falls AS SELECT ab, r FROM merges WHERE r < (ab >> 20) OR r < (ab & 1048575) ORDER BY ab")
        self.db.execute("CREATE TABLE vocab AS SELECT * FROM vocab")
        self.pairs = np.unique(merges.column("ab").to_numpy())
        self.known: list[dict[str, str]] = [{}, {}]

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each short piece, a lot at once."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        lengths = np.array([len(p) for p in pieces], np.int64)
        at = np.repeat(np.cumsum(lengths) - lengths, lengths)
        start = pa.table({"w": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths), "pos": (np.arange(len(data)) - at).astype(np.int32), "tok": self.byte_ids[data]})
        self.db.register("start", start)
        got = self.db.sql(_ONE).to_arrow_table()
        self.db.unregister("start")
        out: list[list[int]] = [[]] * len(pieces)
        for w, ids in zip(got.column("w").to_pylist(), got.column("ids").to_pylist(), strict=True):
            out[w] = ids
        return out

    def cut(self, piece: bytes) -> tuple[np.ndarray, int]:
        """The places in a piece that no token crosses, its ends included, and the length of
        the longest token that occurs."""
        if self.occurring is None:
            self.occurring = ahocorasick.Automaton()
            for t in self.ranks:
                if len(t) > 1:
                    self.occurring.add_word(t.decode("latin-1"), len(t))
            self.occurring.make_automaton()
            self.longest = max(map(len, self.ranks))
        text, n, longest = piece.decode("latin-1"), len(piece), 1
        change = np.zeros(n + 1, np.int32)
        for i in range(0, n, BLOCK):
            # Tokens that end in this block; as they come, the last of an end is the shortest.
            ends, lengths = np.fromiter((x for m in self.occurring.iter(text, max(0, i - self.longest), min(n, i + BLOCK)) for x in m), np.int64).reshape(-1, 2).T
            np.add.at(change, ends - lengths + 2, 1)
            np.add.at(change, ends + 1, -1)
            longest = max(longest, int(lengths.max(initial=1)))
        return np.append(np.flatnonzero(np.cumsum(change[:n]) == 0), n), longest

    def contract(self, parts: list[tuple[np.ndarray, np.ndarray, int, int]], longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Parts (places, tokens, first and last place that may contract) as far as they contract."""
        lengths = [len(p[0]) for p in parts]
        self.db.register("start", pa.table({"w": np.repeat(np.arange(len(parts), dtype=np.int32), lengths), "pos": np.concatenate([p[0] for p in parts]), "tok": np.concatenate([p[1] for p in parts])}))
        self.db.register("bounds", pa.table({"w": np.arange(len(parts), dtype=np.int32), "low": np.array([p[2] for p in parts], np.int64), "high": np.array([p[3] for p in parts], np.int64)}))
        parts_of = {"first": _FIRST, "calm": _CALM, "wild": _WILD, "falls": _FALLS} if self.alone else {"first": "false", "calm": "false", "wild": "false", "falls": ""}
        ask = _MANY.format(reach=2 * longest, **{k: v.format(reach=3 * longest) for k, v in parts_of.items()})
        w, pos, tok = (c.to_numpy() for c in self.db.sql(ask).to_arrow_table().columns)
        self.db.unregister("start")
        self.db.unregister("bounds")
        cuts = np.searchsorted(w, np.arange(1, len(parts)))
        return list(zip(np.split(pos, cuts), np.split(tok, cuts), strict=True))

    def merge_long(self, parts: list[bytes], longest: int) -> list[list[int]]:
        """The ids of each long part: whole parts in lots, longer ones by blocks."""
        out: list[list[int]] = [[] for _ in parts]
        lot, size = [], 0
        whole = [i for i, p in enumerate(parts) if len(p) <= BLOCK]
        for n, i in enumerate(whole):
            lot.append(i)
            size += len(parts[i])
            if size >= LOT or n == len(whole) - 1:
                for k, (_, tok) in zip(lot, self.contract([(*self._bytes(parts[k]), 0, len(parts[k])) for k in lot], longest), strict=True):
                    out[k] = tok.tolist()
                lot, size = [], 0
        for i, p in enumerate(parts):
            if len(p) > BLOCK:
                out[i] = self._by_blocks(p, longest).tolist()
        return out

    def _bytes(self, part: bytes) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(part), dtype=np.int32), self.byte_ids[np.frombuffer(part, np.uint8)]

    def _by_blocks(self, part: bytes, longest: int) -> np.ndarray:
        pos, tok = self._bytes(part)
        margin, turn, idle, block = 4 * longest + 1, 0, 0, BLOCK
        while self._contracts(tok):
            n = len(tok)
            edges = [0, *range(block // (1 + turn % 2), len(part), block), len(part)]
            rows = np.searchsorted(pos, edges)
            lots, done = [[]], []
            for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
                if sum(len(x[0]) for x in lots[-1]) >= LOT:
                    lots.append([])
                low = 0 if a == 0 else int(pos[min(a, n - 1)]) + margin
                high = len(part) if b == n else int(pos[b]) - margin
                if a < b:
                    lots[-1].append((pos[a:b], tok[a:b], low, high))
            for lot in filter(None, lots):
                done += self.contract(lot, longest)
            pos, tok = np.concatenate([p for p, _ in done]), np.concatenate([t for _, t in done])
            idle = idle + 1 if len(tok) == n else 0
            if idle == 2:  # no pair is free of some block's end
                block, idle = 2 * block, 0
            turn += 1
        return tok

    def _contracts(self, tok: np.ndarray) -> bool:
        """Whether some pair is still in the merge table."""
        return bool(np.isin((tok[:-1].astype(np.int64) << 20) | tok[1:], self.pairs).any())

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each distinct piece: a token's own id, else by merges."""
        parts: list[list[bytes]] = []
        longest = 1
        for p in pieces:
            if p in self.ranks or len(p) < LONG:
                parts.append([p])
                continue
            cuts, most = self.cut(p)
            longest = max(longest, most)
            parts.append([p[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)])
        # A whole piece that is a token is that token; of a cut piece's parts, only what their pairs make.
        known: dict[bytes, list[int]] = {p: [self.ranks[p]] for p in pieces if p in self.ranks}
        todo = list(dict.fromkeys(x for p in parts for x in p if x not in known))
        lot, size = [], 0
        short = [x for x in todo if len(x) < LONG]
        for n, x in enumerate(short):
            lot.append(x)
            size += len(x) * len(x) // 2
            if size >= ROWS or n == len(short) - 1:
                known.update(zip(lot, self.merge(lot), strict=True))
                lot, size = [], 0
        long = [x for x in todo if len(x) >= LONG]
        known.update(zip(long, self.merge_long(long, longest), strict=True))
        return [[i for x in p for i in known[x]] for p in parts]

    def learn(self, pieces: set[str]) -> dict[str, str]:
        """The pieces' ids as text: from the known pieces, else by queries.

        Known pieces are two generations: when the younger is full it becomes the
        older, and what is used again is carried over.
        """
        old, young = self.known
        got = {p: x for p in pieces if (x := young.get(p) or old.get(p)) is not None}
        new = [p for p in pieces if p not in got]
        if new:
            ids = self.encode_pieces([p.encode("utf-8") for p in new])
            got.update((p, " ".join(map(str, x))) for p, x in zip(new, ids, strict=True))
        if len(young) + len(new) > KNOWN:
            self.known = [young, {}]
        self.known[1].update((p, x) for p, x in got.items() if len(p) < LONG)
        return got

    def pieces(self, text: str):
        """The pieces of a text, in lists of bounded length."""
        find = self.exact if self.odd is not None and not _latin(text) and self.odd.search(text) else self.fast
        if len(text) <= IDS:
            yield find.findall(text)
            return
        at = find.finditer(text)
        while part := [m.group() for m in islice(at, IDS)]:
            yield part

    def encode(self, texts: list[str | None]) -> list[list[str]]:
        """For each text, its ids as lists of texts of decimal ids joined by spaces."""
        out: list[list[str]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush():
            known = self.learn({p for _, pieces in held for p in pieces})
            for k, pieces in held:
                out[k].append(" ".join([known[p] for p in pieces]))
            held.clear()

        for k, t in enumerate(texts):
            for pieces in self.pieces(t) if t else ():
                if pieces:
                    held.append((k, pieces))
                    size += len(pieces)
                    if size >= IDS:
                        flush()
                        size = 0
        if held:
            flush()
        return out

    def decode(self, ids: list[np.ndarray]) -> list[list[bytes]]:
        """For each array of ids, its bytes in parts."""
        out: list[list[bytes]] = [[] for _ in ids]
        lot: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush():
            lengths = np.array([len(x) for _, x in lot])
            at = np.repeat(np.cumsum(lengths) - lengths, lengths)
            flat = np.concatenate([x for _, x in lot])
            rows = pa.table({"d": np.repeat(np.arange(len(lot), dtype=np.int32), lengths), "pos": (np.arange(len(flat)) - at).astype(np.int32), "id": flat.astype(np.int32)})
            self.db.register("ids", rows)
            got = self.db.sql(_DECODE).to_arrow_table()
            self.db.unregister("ids")
            text = dict(zip(got.column("d").to_pylist(), got.column("hex").to_pylist(), strict=True))
            for k, (d, _) in enumerate(lot):
                out[d].append(bytes.fromhex(text[k]))
            lot.clear()

        for d, x in enumerate(ids):
            for i in range(0, len(x), IDS):
                lot.append((d, x[i : i + IDS]))
                size += len(lot[-1][1])
                if size >= IDS:
                    flush()
                    size = 0
        if lot:
            flush()
        return out


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec of a rank file, made once."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return _codecs[path, pattern]


def _ids(parts: list[str]) -> np.ndarray:
    return np.concatenate([np.fromstring(p, np.int32, sep=" ") for p in parts]) if parts else np.zeros(0, np.int32)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: doc_id) and token_ids, an array of ints."""
    keep = ["doc_id"] if keep is None else keep
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "token_ids array<int>"])

    def run(batches):
        c = codec(ranks, pattern)
        for b in slices(batches):
            got = [_ids(x) for x in c.encode(b.column(len(keep)).to_pylist())]
            offsets = np.cumsum([0, *map(len, got)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *got])))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], ids], names=[*keep, "token_ids"])

    return docs.select(*keep, docs[text].alias("__pl_text")).mapInArrow(run, schema)


def decode(docs: DataFrame, ranks: str, pattern: str, ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: doc_id) and decoded, the bytes of the ids' tokens in order."""
    keep = ["doc_id"] if keep is None else keep
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "decoded binary"])

    def run(batches):
        c = codec(ranks, pattern)
        for b in slices(batches):
            got = c.decode([np.asarray(x or [], np.int32) for x in b.column(len(keep)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array([b"".join(x) for x in got], pa.binary())], names=[*keep, "decoded"])

    return docs.select(*keep, docs[ids].alias("__pl_ids")).mapInArrow(run, schema)


def _digests(parts: list[list[str]], decoded: list[list[bytes]]) -> list[pa.Array]:
    """Number of ids, and the digests of the ids (decimal, joined by one space) and of the bytes."""
    texts = [" ".join(x) for x in parts]
    return [
        pa.array([t.count(" ") + bool(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
        pa.array([hashlib.sha256(b"".join(x)).hexdigest() for x in decoded]),
    ]


_DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]


def round_trip(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text's ids and the bytes
    decoded from them."""

    def run(batches):
        c = codec(ranks, pattern)
        for b in slices(batches, 1024):
            parts = c.encode(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *_digests(parts, c.decode([_ids(x) for x in parts]))], names=["doc_id", *_DIGESTS])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_checked(docs: DataFrame, ranks: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, token_ids and the columns of ``round_trip``, in one pass."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "token_ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"])

    def run(batches):
        c = codec(ranks, pattern)
        for b in slices(batches, 1024):
            parts = c.encode(b.column(len(keep)).to_pylist())
            ids = [_ids(x) for x in parts]
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            arrays = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], arrays, *_digests(parts, c.decode(ids))], names=[*keep, "token_ids", *_DIGESTS])

    return docs.select(*keep, docs[text].alias("__pl_text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
