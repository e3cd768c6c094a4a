import hashlib
import random
import re

import public_tokenizers
import tiktoken

import corpus_pipeline as C
from pairloom.llm import bpe, mixture, pii, simhash

from .test_quality import plain
from .test_simhash import plain_components, plain_fingerprint


def stage(name):
    return dict(C.STAGES)[name]


def key(r):
    return tuple(map(str, r))


def firsts_of_groups(texts):
    """The least id of each group of texts that are linked by near fingerprints, or by sets of
    five-word shingles with a similarity of 0.8 or more; by all pairs."""
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t)) for d, t in texts.items()}
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for d, w in words.items()}
    fps = {d: plain_fingerprint(t) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if (fps[a] ^ fps[b]).bit_count() <= 3 or (common and 10 * common >= 8 * (len(sets[a]) + len(sets[b]) - common)):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d for d in ids if top(d) == d}


def test_near_copies_that_fingerprints_miss(spark, sf):
    rng = random.Random(4)
    texts = {}
    for i in range(0, 400, 4):
        base = [f"word{rng.randrange(2000)}" for _ in range(rng.randint(60, 200))]
        for k in range(4):  # a text, and copies with one, two and three places changed
            texts[i + k] = " ".join("changed" if j % 60 == 59 and j // 60 < k else w for j, w in enumerate(base))
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = {r.doc_id for r in C.near_duplicates(spark, docs, sf).collect()}
    assert got == firsts_of_groups(texts)
    near = plain_components([(d, plain_fingerprint(t)) for d, t in texts.items()])
    assert len(got) < len(set(near.values())) - 50


def test_stages_against_plain_versions(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = {}
    for name, f in C.STAGES:
        f(spark, docs, sf).write.parquet(str(tmp_path / name))
        after[name] = spark.read.parquet(str(tmp_path / name))
        if name != "encode_tokens":
            assert after[name].columns == docs.columns and after[name].schema == docs.schema
        docs = after[name]
    start = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}

    kept = {r.doc_id: r for r in after["quality_rules"].collect()}
    for d, r in start.items():
        n, chars, symbols, lines, dup, repeat = plain(r.text)
        base = n < 50 or 100 * repeat > 50 * n
        minor = 10 * symbols > n or chars < 3 * n or chars > 10 * n or 10 * dup > 3 * lines
        assert not (base and d in kept)
        assert base or minor or d in kept
    assert all(start[d] == r for d, r in kept.items())

    first = {r.doc_id: r for r in after["near_duplicates"].collect()}
    assert first.keys() == firsts_of_groups({d: r.text for d, r in kept.items()})
    assert all(kept[d] == r for d, r in first.items())

    private = {r.doc_id: r for r in after["personal_data"].collect()}
    assert private.keys() == first.keys()
    for d, r in private.items():
        found = pii.find(first[d].text)
        assert (r.text == first[d].text) == (not found)
        assert (r.source, r.lang) == (first[d].source, first[d].lang)
        assert r.n_chars == (len(r.text) if found else first[d].n_chars)

    mixed = sorted(map(key, after["mix_sources"].collect()))
    got, _ = mixture.mix(after["personal_data"])
    copies = {r.doc_id: r.copies for r in got.collect()}
    assert mixed == sorted(key(r) for d, r in private.items() for _ in range(copies[d]))

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = after["encode_tokens"].collect()
    assert len(last) == len(mixed)
    for r in last:
        ids = enc.encode_ordinary(private[r.doc_id].text)
        assert list(r.token_ids) == ids and r.decoded_sha256 == hashlib.sha256(private[r.doc_id].text.encode()).hexdigest()


def test_run_is_the_stages(spark, sf):
    a = C.run(spark, sf)
    assert a.columns == ["doc_id", "source", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256"]
    rows = a.select("doc_id", "ids_sha256").collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}


def test_odd_rows(spark, sf):
    long = " ".join(f"word{i}" for i in range(70))
    rows = [(1, long, "en", "s", 5, "x"), (1, long, "en", "s", 5, "x"), (None, None, None, None, None, None), (2, "", "", "", 0, ""), (3, long + " a@b.co", None, None, 7, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp string")
    for name, f in C.STAGES:
        docs = spark.createDataFrame(f(spark, docs, sf).collect(), f(spark, docs, sf).schema)
        if name == "near_duplicates":
            assert docs.count() in (1, 2)
    assert docs.count() >= 1
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, f in C.STAGES:
        out = f(spark, empty, sf)
        assert out.count() == 0
