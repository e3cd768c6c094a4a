import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm import packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_library_s(library):
    rng = random.Random(5)
    parts = ["the ", " The", "'s", "'S", "n't", "  ", "\n\n", "\t", "1234", "²", "½", "é", "é", "ß", "中文", "日本語", "ก", "\U0001f600", "‍", " ", "　", "\x00", "<|endoftext|>", "<|endo", "...", "?!", "a" * 50, "ᏸ", " ", "\U0001e900", "𝟙", "_", "ⅷ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4000)]
    texts += ["".join(chr(c) for c in rng.choices([*range(1, 0xD800), *range(0xE000, 0x30000)], k=30)) for _ in range(2000)]
    enc = packing.Encoder(PATH, PATTERN)
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def one_bin_at_a_time(lengths, size):
    """Best-two-fit by its words, on a list of pieces."""
    left = sorted(lengths, reverse=True)
    bins = []
    while left:
        held, gap = [], size
        while (fit := next((x for x in left if x <= gap), None)) is not None:
            left.remove(fit)
            held.append(fit)
            gap -= fit
        if gap:
            room = gap + min(held)
            pairs = [(x + y, min(x, y)) for i, x in enumerate(left) for y in left[i + 1 :] if min(held) < x + y <= room]
            if pairs:
                both, low = max(pairs)
                left.append(min(held))
                held.remove(min(held))
                for x in (low, both - low):
                    left.remove(x)
                    held.append(x)
                left.sort(reverse=True)
        bins.append(sorted(held))
    return bins


def planned(counts, size):
    """The bins of a plan, laid out; every number of every length must have one place."""
    places, n = packing.plan(counts, size)
    bins = defaultdict(list)
    for length, count in counts.items():
        entries = sorted(places[length])
        assert entries[0][0] == 0
        for k, (first, base, each, at) in enumerate(entries):
            last = entries[k + 1][0] if k + 1 < len(entries) else count
            assert (last - first) % each == 0
            for i in range(last - first):
                bins[base + i // each].append((at + i % each * length, length))
    for rows in bins.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(bins) == list(range(n))
    return [sorted(length for _, length in rows) for _, rows in sorted(bins.items())]


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_two_fit(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 24, 60])
    lengths = [rng.randint(1, size if seed % 2 else size // 2) for _ in range(rng.randrange(1, 90))]
    got, want = planned(dict(Counter(lengths)), size), one_bin_at_a_time(lengths, size)
    assert sorted(x for b in got for x in b) == sorted(lengths)
    assert [sum(b) for b in got] == [sum(b) for b in want]


def test_huge_numbers_of_pieces_need_few_kinds_of_bins():
    rng = np.random.default_rng(1)
    counts = {i: int(n) for i, n in enumerate(rng.integers(1, 10**9, 1025)) if i}
    places, n = packing.plan(counts)
    total = sum(k * v for k, v in counts.items())
    assert sum(map(len, places.values())) < 30_000
    assert n <= 1.005 * max(total / 1024, sum(v for k, v in counts.items() if k > 512))


def test_plan_beats_first_fit_decreasing_or_equals_it():
    rng = random.Random(9)
    for _ in range(5):
        lengths = [min(1024, int(rng.lognormvariate(5, 1)) + 1) for _ in range(2000)]
        gaps: list[int] = []
        for x in sorted(lengths, reverse=True):
            k = next((i for i, g in enumerate(gaps) if g >= x), None)
            if k is None:
                gaps.append(1024 - x)
            else:
                gaps[k] -= x
        assert packing.plan(dict(Counter(lengths)))[1] <= len(gaps)


def check(rows, docs, library, length=1024):
    """Each document's pieces as they must be, and sequences without gaps; their number."""
    want = []
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % length + 1
        cuts = [0, *range(first, len(ids) + 1, length)]
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            want.append((doc_id, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert Counter(tuple(r)[:5] for r in rows) == Counter(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences)


def test_odd_documents(spark, library):
    docs = [(1, None), (2, ""), (None, "no id"), (None, "no id"), (3, "one two " * 3000), (3, "same id"), (4, "<|endoftext|>x"), (5, "a" * 5000), (6, "word " * 1022), (7, "word " * 1023), (8, "word " * 1024)]
    df = spark.createDataFrame([(d, t, 9, 9) for d, t in docs] * 3, "doc_id long, text string, length int, task int").repartition(3)
    assert check(packing.packed(df, PATH, PATTERN).collect(), docs * 3, library) > 20
    assert packing.packed(df.limit(0), PATH, PATTERN).collect() == []


def test_ids_and_other_lengths(spark, library):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "Gamma", "delta,"]) for _ in range(rng.randrange(60)))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = packing.packed(df, PATH, PATTERN, length=50, ids=True).collect()
    check([r for r in rows], docs, library, 50) if rows[0].__fields__[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] else pytest.fail(str(rows[0]))
    texts = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        texts[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert {d: library.decode(ids[:-1]) for d, ids in texts.items()} == dict(docs)


def test_query(spark, sf, library):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = packing.query(spark, sf).collect()
    used = check(rows, docs, library)
    assert used <= -(-sum(r["length"] for r in rows) // 1024) * 1.01 + 1
