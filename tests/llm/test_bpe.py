import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken

from pairloom.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def hard():
    rnd = random.Random(1)
    return [
        None,
        "",
        " ",
        "a" * 5001,
        " " * 3000 + "x",
        "=-" * 800,
        "".join(rnd.choice("abcdefgh") for _ in range(3000)),
        "\n" * 777,
        "é" * 999,
        "日本語" * 200,
        "́" * 300,
        "<|endoftext|> it's I'll  x\t\n y  z",
        # letters and numbers of the newest Unicode tables only
        "՘ a՘bc \U0003fc3b\U0003fc3b x\U0003fc3b",
        "\U00011de012\U00011de1 ࢏!\U00016ff4",
        "x" * 63 + " " + "y" * 62 + " " + "ab" * 32,
    ]


def test_encodes_as_tiktoken(own, theirs):
    for t, got in zip(hard(), own.encode(hard()), strict=True):
        ids = bpe._ids(got).tolist()
        assert ids == theirs.encode_ordinary(t or ""), (t or "")[:20]
        assert b"".join(own.decode([bpe._ids(got)])[0]).decode() == (t or "")


def test_random_bytes_of_words(own, theirs):
    rnd = random.Random(7)
    texts = ["".join(chr(rnd.choice((rnd.randrange(32, 127), rnd.randrange(160, 0x2FF), rnd.randrange(0x4E00, 0x4F00)))) for _ in range(rnd.randrange(200))) for _ in range(200)]
    for t, got in zip(texts, own.encode(texts), strict=True):
        assert bpe._ids(got).tolist() == theirs.encode_ordinary(t)


def test_lots_do_not_change_results(own, monkeypatch):
    texts = [t * 3 if t else t for t in hard()]
    want = [bpe._ids(x).tolist() for x in own.encode(texts)]
    for name, value in (("IDS", 5), ("LOT", 100), ("ROWS", 100), ("KNOWN", 2)):
        monkeypatch.setattr(bpe, name, value)
    fresh = bpe.Codec(own.ranks, public_tokenizers.PATTERN)
    fresh_texts = [t[:300] if t else t for t in texts]
    assert [bpe._ids(x).tolist() for x in fresh.encode(fresh_texts)] == [bpe._ids(x).tolist() for x in own.encode(fresh_texts)]
    ids = bpe._ids(own.encode([texts[-1]])[0])
    assert b"".join(fresh.decode([ids])[0]).decode() == texts[-1]
    assert want[-1] == bpe._ids(own.encode([texts[-1]])[0]).tolist()


def test_simultaneous_contraction_equals_one_by_one(own):
    """The long-piece query on short pieces gives what the short-piece query gives."""
    rnd = random.Random(2)
    pieces = list({bytes(rnd.choice(b"aabbe tion=") for _ in range(rnd.randrange(2, 40))) for _ in range(300)})
    longest = max(own.cut(p)[1] for p in pieces)
    assert own.merge_long(pieces, longest) == own.merge(pieces)


def test_cuts_are_where_no_token_crosses(own):
    rnd = random.Random(3)
    for _ in range(30):
        p = bytes(rnd.choice(b"abcdefgqxzj") for _ in range(rnd.randrange(64, 200)))
        cuts, longest = own.cut(p)
        tokens = [(a, b) for a in range(len(p)) for b in range(a + 2, min(len(p), a + 128) + 1) if p[a:b] in own.ranks]
        assert longest == max((b - a for a, b in tokens), default=1)
        assert cuts.tolist() == [i for i in range(len(p) + 1) if not any(a < i < b for a, b in tokens)]


def runs():
    """Long unbroken runs: few cuts (a DNA line, words without spaces), many (random letters,
    base 64), one rank only."""
    rnd = random.Random(5)
    words = "the of and to in is you that it he was for on are as with his they at be this have from or one had by word but not what all were we when your can said".split()
    base = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    return {
        "letters": "".join(rnd.choice(base[26:]) for _ in range(100_000)),
        "base 64": "".join(rnd.choice(base) for _ in range(50_000)),
        "DNA": "".join(rnd.choice("ACGT") for _ in range(30_000)),
        "words": "".join(rnd.choice(words) for _ in range(12_000)),
        "spaces": " " * 100_000,
        "same": "a" * 70_000,
        "Chinese": "".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(20_000)),
    }


@pytest.mark.parametrize("kind", list(runs()))
def test_very_long_runs(own, theirs, kind):
    text = "x " + runs()[kind] + "!"
    (got,) = own.encode([text])
    assert bpe._ids(got).tolist() == theirs.encode_ordinary(text)
    assert b"".join(own.decode([bpe._ids(got)])[0]).decode() == text


@pytest.mark.parametrize("block", [70, 500])
def test_blocks_of_long_parts(own, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK", block)
    rnd = random.Random(6)
    words = ["the", "ing", "tion", "aa", "international", "er", "ation", "s"]
    pieces = ["".join(rnd.choice(words) for _ in range(400)).encode(), b"ab" * 600, b"a" * 1500, bytes(rnd.choice(b"ACGT") for _ in range(1500))]
    theirs = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=own.ranks, special_tokens={})
    assert own.encode_pieces(pieces) == [theirs.encode_ordinary(p.decode()) for p in pieces]


def test_query_over_documents(spark, sf, theirs):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bpe.query(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = theirs.encode_ordinary(rows[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()


def test_operators_keep_columns_and_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, "", None), (None, "x y", "b"), (1, None, "a")], "doc_id long, text string, token_ids string")
    enc = bpe.encode(df.drop("token_ids"), RANKS, public_tokenizers.PATTERN)
    dec = bpe.decode(enc, RANKS, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in dec.collect()) == [("1", b""), ("1", b""), ("1", b""), ("None", b"x y")]
    assert bpe.round_trip(df, RANKS, public_tokenizers.PATTERN).count() == 4
    assert bpe.round_trip(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_periodic_runs(own, theirs):
    """Runs of one word without spaces: equal to the library, in time in proportion to their length."""
    codec, library = own, theirs
    rng = random.Random(6)
    words = ["the", "ing", "that", "haha", "http", "www.", "lol", "e", "naïve", "привет"]
    for n in range(150):
        size = rng.randint(1, 12)
        word = words[n] if n < len(words) else "".join(rng.choice("abcdefghijklmnopqrstuvwxyz" if n % 2 else "etaoinshr") for _ in range(size))
        text = word * (rng.choice([300, 3000]) // len(word))
        assert codec.encode_pieces([text.encode()]) == [library.encode_ordinary(text)] or not word.isalpha(), (word, len(text))
    for word in ("the", "abcab", "statistic"):
        text = word * (200_000 // len(word))
        began = time.monotonic()
        assert codec.encode_pieces([text.encode()]) == [library.encode_ordinary(text)]
        assert time.monotonic() - began < 30


def test_vocabularies_whose_tokens_are_ranked_before_their_parts():
    """Random vocabularies, in which contracting one pair can make a pair of lower rank."""
    rng = random.Random(8)
    for _ in range(40):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 256 + 25:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))))
        grown = sorted(t for t in tokens if len(t) > 1)
        rng.shuffle(grown)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(grown)}
        library = tiktoken.Encoding("odd", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
        codec = bpe.Codec(ranks, r"[a-z]+")
        for _ in range(12):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) * rng.randint(20, 60) + "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
            assert codec.encode_pieces([text.encode()]) == [library.encode_ordinary(text)], (text, ranks)
