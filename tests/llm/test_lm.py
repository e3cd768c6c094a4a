import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import lm as L


def tokens(text):
    return [*(text or "").encode().lower().split(), b" end"]


def base(rows):
    """[(held_out, n_tokens, n_known, N, base_score)] by plain counting."""
    toks = [tokens(t) for _, t in rows]
    out = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    c = Counter(w for ws, o in zip(toks, out, strict=True) if not o for w in ws)
    n, v = sum(c.values()), len(c)
    return [(o, len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for ws, o in zip(toks, out, strict=True)]


def quantised(c):
    """The count that a level gives back, by search: levels begin at 1, 2, 3 and 4 * sqrt(2)**k."""
    if c < 4:
        return float(c)
    k = 0
    while 4 * 2 ** ((k + 1) / 2) <= c * (1 + 1e-9):
        k += 1
    return 4 * 2 ** (k / 2) * 2**0.25


def twin(rows):
    """The model's scores from exact counts in dictionaries, quantised; no filter."""
    toks = [tokens(t) for _, t in rows]
    train = [ws for (d, _), ws in zip(rows, toks, strict=True) if d is None or zlib.crc32(str(d).encode()) % 10]
    words, pairs = Counter(), Counter()
    for ws in train:
        words.update(ws)
        pairs.update(zip([b" start", *ws], ws, strict=False))
    n = sum(words.values())
    u = (sum(c == 1 for c in words.values()) + 0.5) / (n + 1)
    words[b" start"] = len(train)
    out = []
    for ws in toks:
        total = 0.0
        for h, w in zip([b" start", *ws], ws, strict=False):
            c, ch, both = (quantised(x) for x in (words[w], words[h], pairs[h, w]))
            p = (1 - u) * c / n if c else u
            total += math.log10((both + L.MU * p) / (max(ch, both) + L.MU))
        out.append(total)
    return out


def test_levels():
    c = np.array([1, 2, 3, 4, 5, 6, 7, 8, 12, 1000, 10**9])
    q = L.level(c)
    assert q[:4].tolist() == [1, 2, 3, 4] and (np.diff(q) >= 0).all()
    assert (np.abs(np.log(L.count_of(q) / c)) <= math.log(2) / 4 + 1e-6).all()
    assert L.count_of(np.array([0])).tolist() == [0]
    assert [quantised(x) for x in c.tolist()] == pytest.approx(L.count_of(q).tolist())


@pytest.mark.parametrize("n", [1, 7])
def test_filter_gives_levels_back(n):
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    counts = rng.integers(1, 30, 5000)
    parts = {s: L.fill(keys[a:b], counts[a:b]) for s, a, b in L.by_shard(keys, n)}
    assert set(parts) == set(range(n)) and (np.diff(L.shard_of(keys, n)) >= 0).all()
    f = L.Filter(np.concatenate([parts[s] for s in range(n)]), np.array([len(parts[s]) for s in range(n)]))
    got, q = f.levels(keys), L.level(counts)
    assert (got >= q).all() and (got > q).mean() < 0.05
    assert (f.levels(rng.integers(0, 2**64, 20000, dtype=np.uint64)) > 0).mean() < 0.04
    s, a, b = list(L.by_shard(keys, n))[-1]
    assert (L._probe(parts[s], keys[a:b]) == got[a:b]).all()
    assert list(L.by_shard(keys[:0], n)) == [] and len(f.levels(keys[:0])) == 0


def test_query_base_and_model(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: r for r in L.query(spark, sf).collect()}
    assert len(got) == len(rows)
    for (d, _), want, exact in zip(rows, base(rows), twin(rows), strict=True):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[:4]
        assert r.base_score == pytest.approx(want[4], rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
        assert r.score == pytest.approx(exact, rel=0.1, abs=1)  # some two probes in a hundred err
    assert sum(r.score for r in got.values()) == pytest.approx(sum(twin(rows)), rel=0.01)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("filter_bytes", [L.FILTER_BYTES, 0])
def test_scores_equal_exact_counts(spark, sf, filter_bytes):
    """With so many bits that no probe errs, scores are those of exact, quantised counts:
    whether the filter is broadcast or probes are dealt to its shards."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).repartition(3)
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (None, "the  THE the"), (-3, "é É never-seen")], "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = L.Model(docs.where(~L.held_out()), top=50, shard_text=20_000, bits=400.0)
    assert model.n_shards > 3
    got = {r.doc_id: r for r in L.score(docs, model, filter_bytes).collect()}
    assert len(got) == len(rows)
    for (d, _), want, exact in zip(rows, base(rows), twin(rows), strict=True):
        assert got[d].score == pytest.approx(exact, rel=1e-9)
        assert got[d].base_score == pytest.approx(want[4], rel=1e-9)
        assert (got[d].n_tokens, got[d].n_known) == (want[1], want[2])


def test_counts(spark):
    texts = ["a b a b", "A b c", None, "a b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = L.Model(df.repartition(3), shard_text=5)
    want = Counter(w for t in texts for w in L.Lot([(0, (t or "").encode(), True, True)]).tokens.tolist())
    assert model.n_shards > 1 and {r.word & (2**64 - 1): r.c for r in model.words().collect()} == want
    assert (model.n, model.v) == (sum(want.values()), len(want))
    assert {r.c for r in model.words(3).collect()} == {c for c in want.values() if c >= 3}
    pairs = Counter(p for lot in L.lots(texts) for p in lot.pairs().tolist())
    keys = np.array(list(pairs), np.uint64)
    assert (model.filter("pair_bits").levels(keys) >= L.level(list(pairs.values()))).all()


def test_numbers_of_words(monkeypatch):
    texts = ["The cat", None, "", " \n", "the  CAT the\tÉ é\x1cx", "x" * 3000 + " y", "a aa aaa b ab ba"]
    words = [tokens(t) for t in texts]

    def flat():
        found = list(L.lots(texts))
        lengths = np.zeros(len(texts), int)
        for lot in found:
            np.add.at(lengths, lot.of, lot.lengths)
        return [np.concatenate([getattr(lot, k) for lot in found]).tolist() for k in ("tokens", "before")], lengths.tolist()

    (ids, before), lengths = flat()
    assert lengths == [len(w) for w in words]
    every = [w for ws in words for w in ws]
    assert len({(w, i) for w, i in zip(every, ids, strict=True)}) == len(set(every)) == len(set(ids))
    starts = np.cumsum([0, *lengths[:-1]]).tolist()
    assert before == [int(L.START) if i in starts else ids[i - 1] for i in range(len(ids))]
    for size in (1, 2, 3, 7, 2999):
        monkeypatch.setattr(L, "LOT", size)
        assert flat() == ([ids, before], lengths)
    assert list(L.lots([])) == []


def test_a_very_long_text(spark):
    """One of four million characters, and one of white space only."""
    rows = [(1, "one two  three " * 280_000), (2, " \n" * 800_000 + "two"), (3, "two three"), (4, "w" * 1_500_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = L.Model(df, bits=100.0)
    for filter_bytes in (L.FILTER_BYTES, 0):
        got = {r.doc_id: r for r in L.score(df, model, filter_bytes).collect()}
        assert [got[i].n_tokens for i in (1, 2, 3, 4)] == [840_001, 2, 3, 2] and got[1].train_tokens == 840_008
        for (d, _), want, exact in zip(rows, base([(None, t) for _, t in rows]), twin([(None, t) for _, t in rows]), strict=True):
            assert got[d].score == pytest.approx(exact, rel=1e-6) and got[d].base_score == pytest.approx(want[4], rel=1e-9)


def test_dealt_probes_give_the_same_scores(spark):
    rows = [(i, f"the cat {i % 7} sat on the mat {i % 3} of house {i}" * (1 + i % 4)) for i in range(120)] + [(99, None), (None, "the cat")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = L.Model(df.where(~L.held_out()), top=5, shard_text=500)
    one = {r.doc_id: r for r in L.score(df, model).collect()}
    many = {r.doc_id: r for r in L.score(df, model, filter_bytes=0).collect()}
    assert one.keys() == many.keys()
    for d, r in one.items():
        assert many[d].score == pytest.approx(r.score) and many[d].base_score == pytest.approx(r.base_score)
        assert (many[d].n_known, many[d].n_tokens, many[d].held_out) == (r.n_known, r.n_tokens, r.held_out)


def test_probabilities_sum_to_about_one(spark):
    """Small counts are exact levels: after a context, the known words, the end and the
    unknown share 1."""
    df = spark.createDataFrame([(1, "a b a c a b a d b b"), (3, "a b c d")], "doc_id long, text string")
    model = L.Model(df, bits=400.0)
    words, pairs = model.filter("word_bits"), model.filter("pair_bits")
    of = lambda t: L.Lot([(0, t.encode(), True, True)])
    total = 0.0
    for t in ("a a", "a b", "a c", "a d", "a zzz", "a"):
        x = of(t)
        c = L.count_of(words.levels(x.tokens[1:2]))
        before = L.count_of(words.levels(x.before[1:2]))
        both = L.count_of(pairs.levels(x.pairs()[1:2]))
        total += 10 ** L.log_chances(c, before, both, model.n, model.unknown)[0]
    assert total == pytest.approx(1, abs=0.1)


def test_odd_rows(spark):
    rows = [(1, None, 5), (1, None, 5), (None, "", 1), (7, "x x", 2), (20, "y", 3), (8, "\x1c x", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int").withColumn("held_out", F.lit("?")).withColumn("lot", F.lit(1))
    got = L.score(df, L.Model(df.where(~L.held_out()))).collect()
    want = base([(d, t) for d, t, _ in rows])
    key = lambda x: (str(x[0]), x[2])
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 9)) for r in got], key=key) == sorted([(d, w[0], w[1], w[2], round(w[4], 9)) for (d, _, _), w in zip(rows, want, strict=True)], key=key)
    assert L.score(df.limit(0), L.Model(df.limit(0))).count() == 0
    for filter_bytes in (L.FILTER_BYTES, -1):
        none = L.score(df, L.Model(df.limit(0)), filter_bytes).collect()
        assert len(none) == 6 and all(r.base_score == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)


def test_pairs_seen_once_are_in_the_model(spark):
    df = spark.createDataFrame([(1, "a b c"), (3, "a d c")], "doc_id long, text string")
    model = L.Model(df)
    got = {r.doc_id: r.score for r in L.score(spark.createDataFrame([(5, "a b"), (6, "a c")], "doc_id long, text string"), model).collect()}
    assert got[5] != got[6]
    lot = L.Lot([(0, b"a b c", True, True)])
    assert (model.filter("pair_bits").levels(lot.pairs()) >= 1).all()


def test_dealt_probes_are_few_large_rows_and_small_row_groups(spark, monkeypatch):
    """A lot asks a part once for its words and once for its pairs, not every shard; and what a
    writer of lots holds is bounded by bytes, however few rows these are."""
    import pyarrow.parquet as pq

    from pairloom.llm import common

    seen = {}
    for name in ("written", "looked_up"):
        monkeypatch.setattr(L, name, lambda *a, f=getattr(L, name), **k: seen.setdefault((f.__name__, *(x for x in a if isinstance(x, str))), f(*a, **k)))
    monkeypatch.setattr(common, "LARGE_BYTES", 1 << 20, raising=False)
    monkeypatch.setattr(L, "RECORD", 1 << 20)
    rows = [(i, " ".join(f"w{(i * 7919 + j * j) % 50021}" for j in range(20_000))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    model = L.Model(df, shard_text=10_000)
    L.score(df, model, filter_bytes=0)
    records, answers = seen["written", "records"], seen["looked_up",]
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in records.inputFiles()]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) > 3
    assert max(g.total_byte_size for g in groups) <= 4 << 20
    assert answers.count() < records.count() * model.n_shards / 4
