import random

import numpy as np
import pytest
import xxhash

from pairloom.llm import simhash as S


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """rows: (doc_id, fp) -> {fp: smallest doc_id reachable}, by all pairs."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                up[top(b)] = top(a)
    least = {}
    for d, f in rows:
        if d is not None:
            least[top(f)] = min(d, least.get(top(f), d))
    return {f: least.get(top(f)) for f in fps}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "É a b É c d e", "x y z " * 50, "a b c\x1cd e f"])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    got = spark.sql("select xxhash64('is and ré')").first()[0] & (2**64 - 1)
    assert got == int(S.shingle_hashes("is and ré")[0])


def test_query_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = S.simhash_dedup(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    want = plain_components(list(fps.items()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{f:016x}", want[f]) for d, f in fps.items()}
    assert len(got) == len(texts)


@pytest.mark.parametrize("group", [4096, 6])
def test_links_of_close_numbers(spark, group):
    """Chains, dense balls and strangers; with a small group limit the fine keys do the work."""
    rnd = random.Random(3)
    fps = {0, 1, 3, 2**63, 2**64 - 1}
    for _ in range(6):
        x = rnd.getrandbits(64)
        for _ in range(40):
            fps.add(x)
            for _ in range(rnd.randint(1, 3)):
                x ^= 1 << rnd.randrange(64)
    ball = rnd.getrandbits(64)
    fps |= {ball ^ (1 << i) for i in range(40)}
    rows = list(enumerate(sorted(fps)))
    rnd.shuffle(rows)
    rows = [(d, f) for d, (_, f) in enumerate(rows)]
    df = spark.createDataFrame([(S._signed(f),) for _, f in rows], "fp long")
    to = {r.a: r.b for r in S.components(S.link_forest(df, group)).collect()}
    want = plain_components(rows)
    mine = {}
    for d, f in rows:
        root = to.get(S._signed(f), S._signed(f))
        mine.setdefault(root, []).append((d, f))
    assert {f: min(d for d, _ in g) for g in mine.values() for _, f in g} == want


def test_long_chain_of_edges(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.a: r.b for r in S.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_odd_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (5, None), (3, ""), (None, "only me here now")]
    df = spark.createDataFrame([(d, t, 9, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    got = [(r.doc_id, r.component_id) for r in S.simhash_dedup(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (1, 1), (None, 1), (5, 3), (3, 3), (None, None)], key=str)
    empty = S.simhash_dedup(df.limit(0))
    assert empty.columns == ["doc_id", "fingerprint", "component_id"] and empty.count() == 0
    stage = S.dedup_stage(df)
    assert stage.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in stage.collect()) == [(0, "only me here now"), (1, "a b c d"), (3, "")]


def test_forest_matches_bit_counts():
    g = np.array(sorted({0, 7, 8, 15, 1 << 40, 0xFFFF}), np.uint64)
    a, b = S._forest(g, 3)
    assert len(a) == len(b) == 4


def test_whole_stage_links_all_similar_texts(spark, monkeypatch):
    """Components by brute force over shingle sets and fingerprints, with and without
    frequent shingles put last."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(words[:30])  # in most texts
    texts = []
    for i in range(60):
        base = [words[j] for j in rng.integers(0, 400, 60 + i)]
        for edits in (0, 1, 2, 3):
            x = list(base)
            for j in rng.integers(0, len(x), edits):
                x[j] = "changed"
            texts.append(" ".join(x) + (" " + line if i % 3 else ""))
    texts += [texts[0], texts[5], "one two", "ONE two", "", None]
    grams = [set(S.shingle_set(t).tolist()) for t in texts]
    fps = [plain_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    missed = 0
    for i in range(len(texts)):
        for j in range(i):
            common, near = len(grams[i] & grams[j]), (fps[i] ^ fps[j]).bit_count() <= 3
            alike = common and 9 * common >= 4 * (len(grams[i]) + len(grams[j]))
            missed += bool(alike and not near)
            if alike or near:
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    assert missed > 20
    want = {i for i in range(len(texts)) if top(i) == i}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in S.dedup_stage(df).collect()} == want
    assert len({r.doc_id for r in S.dedup_stage(df, "fingerprints").collect()}) > len(want)
    for hot in (10, 10**9):
        monkeypatch.setattr(S, "HOT", hot)
        assert {r.doc_id for r in S.dedup_stage(df, "all").collect()} == want


def test_bands_agree_as_often_as_they_should():
    """The share of pairs at a similarity that have a band in common, against 1 - (1 - s^5)^24."""
    rng = np.random.default_rng(5)
    for s in (0.5, 0.8):
        hits = 0
        for _ in range(200):
            common, own = round(300 * 2 * s / (1 + s)), 300 - round(300 * 2 * s / (1 + s))
            x, y, z = (rng.integers(0, 1 << 64, n, np.uint64) for n in (common, own, own))
            a, b = (S._least(np.append(x, v)).reshape(S.BANDS, S.LEAST) for v in (y, z))
            hits += bool((a == b).all(1).any())
        want = 1 - (1 - s**S.LEAST) ** S.BANDS
        assert abs(hits / 200 - want) < 0.11
        assert s < 0.8 or hits == 200


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Candidates grow with the rows of a group, and all of it is one component."""
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in rng.integers(0, 900, 300)]
    texts = []
    for _ in range(700):
        x = list(base)
        for j in rng.integers(0, 300, 2):
            x[j] = f"own{rng.integers(0, 10**6)}"
        texts.append(" ".join(x))
    rows = []
    written = S.written
    monkeypatch.setattr(S, "written", lambda df, name, plain=False: (got := written(df, name, plain), rows.append((name, got.count())) if name == "candidates" else None)[0])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    assert [r.doc_id for r in S.dedup_stage(df).collect()] == [0]
    assert 0 < rows[0][1] < 700 * 2 * (S.BACK + 1) * 4


@pytest.mark.parametrize("cell", [S.CELL, 7])
def test_crowded_bands_lose_no_link(spark, monkeypatch, cell):
    """All texts agree in all bands, so that most similar ones are neither first nor neighbours in a part."""
    monkeypatch.setattr(S, "_least", lambda h: np.zeros(S.BANDS * S.LEAST, np.uint32))
    monkeypatch.setattr(S, "CELL", cell)
    rng = np.random.default_rng(8)
    common = " ".join(f"c{i}" for i in range(60))
    texts = []
    for i in range(150):
        x = [f"w{j}" for j in rng.integers(0, 10**6, 90)]
        texts += [f"{common} {' '.join(x)}", f"{common} {' '.join(x[:-1])} other{i} last{i}"]
    order = rng.permutation(len(texts)).tolist()
    df = spark.createDataFrame([(int(d), t) for d, t in zip(order, texts, strict=True)], "doc_id long, text string").repartition(5)
    want = {min(order[i], order[i + 1]) for i in range(0, len(texts), 2)}
    assert {r.doc_id for r in S.dedup_stage(df).collect()} == want
    assert {r.doc_id for r in S.dedup_stage(df, "all").collect()} == want
